"""Hash, bit and signature expressions and the seeded parameters they use."""

from __future__ import annotations

import hashlib
import math
import random
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from echofind.functions.text import as_column

# Fixed value: modulus of the MinHash family, the Mersenne prime 2^31 - 1.
# Multipliers, offsets and hashes stay below it, so a*h+b fits a bigint.
MINHASH_PRIME = 2**31 - 1
MAX_HASH_BITS = 64
HASH_METHODS = ("md5", "xxhash64")
# Fixed values of MD5: the constant and the rotation of each step, and the start.
MD5_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
MD5_TURNS = [t for turns in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for t in turns * 4]
MD5_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
MD5_SHORT = 55


def check_hash_bits(hash_bits: int) -> None:
    if not 1 <= hash_bits <= MAX_HASH_BITS:
        raise ValueError(f"hash_bits must be between 1 and {MAX_HASH_BITS}")


def signed(value: int) -> int:
    """The bigint that has the same 64 bits as an unsigned integer."""
    return value - (1 << 64) if value >= 1 << 63 else value


def _md5_word(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")


def feature_hash(feature: Column | str, bits: int = 32, method: str = "md5") -> Column:
    """The low ``bits`` bits of a stable string hash, as bigint.

    ``md5`` can be reproduced by any SQL engine; ``xxhash64`` is cheaper.
    """
    check_hash_bits(bits)
    source = as_column(feature)
    if method == "xxhash64":
        value = F.xxhash64(source)
        # xxhash64 of null is its seed; a missing feature must stay missing.
        value = F.when(source.isNotNull(), value)
    elif method == "md5":
        digest = F.md5(source.cast("binary"))
        value = _md5_word(digest, 1)
        if bits > 32:
            value = value.bitwiseOR(F.shiftleft(_md5_word(digest, 9), 32))
    else:
        raise ValueError(f"Unknown hash method {method!r}; use one of {HASH_METHODS}")
    if bits == MAX_HASH_BITS or (method == "md5" and bits == 32):
        return value
    return value.bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))


def _md5_short(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``md5_words`` of strings that fit one block, all at once."""
    place = np.arange(int(sizes.max()))
    block = np.zeros((len(starts), 64), np.uint8)
    taken = data[np.minimum(starts[:, None] + place, len(data) - 1)]
    block[:, : len(place)] = np.where(place < sizes[:, None], taken, 0)
    block[np.arange(len(starts)), sizes] = 0x80
    block[:, 56:60] = (sizes * 8).astype("<u4").view(np.uint8).reshape(-1, 4)
    words = np.ascontiguousarray(block.view("<u4").T).astype(np.uint32)
    a, b, c, d = (np.full(len(starts), v, np.uint32) for v in MD5_START)
    mixed, turned = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 16:
            at = i
            np.bitwise_xor(c, d, out=mixed)
            np.bitwise_and(mixed, b, out=mixed)
            np.bitwise_xor(mixed, d, out=mixed)
        elif i < 32:
            at = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=mixed)
            np.bitwise_and(mixed, d, out=mixed)
            np.bitwise_xor(mixed, c, out=mixed)
        elif i < 48:
            at = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=mixed)
            np.bitwise_xor(mixed, d, out=mixed)
        else:
            at = 7 * i % 16
            np.bitwise_not(d, out=mixed)
            np.bitwise_or(mixed, b, out=mixed)
            np.bitwise_xor(mixed, c, out=mixed)
        np.add(mixed, a, out=mixed)
        np.add(mixed, words[at], out=mixed)
        np.add(mixed, np.uint32(MD5_SINES[i]), out=mixed)
        np.left_shift(mixed, np.uint32(MD5_TURNS[i]), out=turned)
        np.right_shift(mixed, np.uint32(32 - MD5_TURNS[i]), out=mixed)
        np.bitwise_or(mixed, turned, out=mixed)
        np.add(mixed, b, out=mixed)
        a, b, c, d, mixed = d, mixed, b, c, a
    low, high = ((v + np.uint32(start)).byteswap().astype(np.uint64) for v, start in zip((a, b), MD5_START))
    return low | high << np.uint64(32)


def md5_words(data: bytes, starts: np.ndarray, sizes: np.ndarray, piece: int = 16_384) -> np.ndarray:
    """``feature_hash`` with 64 bits and ``md5`` of many slices of ``data``, as unsigned numbers.

    Short strings are hashed ``piece`` at a time, longer ones one by one.
    """
    result = np.zeros(len(starts), np.uint64)
    bytes_, short = np.frombuffer(data + b"\0", np.uint8), sizes <= MD5_SHORT
    chosen = np.flatnonzero(short)
    for k in range(0, len(chosen), piece):
        at = chosen[k : k + piece]
        result[at] = _md5_short(bytes_, starts[at], sizes[at])
    for i in np.flatnonzero(~short).tolist():
        digest = hashlib.md5(data[starts[i] : starts[i] + sizes[i]], usedforsecurity=False).digest()
        result[i] = int.from_bytes(digest[:4]) | int.from_bytes(digest[4:8]) << 32
    return result


def minhash_params(num_hashes: int, seed: int | None = None) -> list[tuple[int, int]]:
    """Seeded multipliers and offsets of the family (a*h + b) mod p."""
    if num_hashes < 1:
        raise ValueError("num_hashes must be at least 1")
    draw = random.Random(seed)
    return [
        (draw.randint(1, MINHASH_PRIME - 1), draw.randint(0, MINHASH_PRIME - 1))
        for _ in range(num_hashes)
    ]


def sample_bit_indices(hash_bits: int, sample_size: int, seed: int | None = None) -> list[int]:
    """Distinct bit positions drawn without replacement."""
    check_hash_bits(hash_bits)
    if sample_size > hash_bits:
        raise ValueError("sample_size cannot exceed hash_bits")
    return random.Random(seed).sample(range(hash_bits), sample_size)


def bit_tables(
    hash_bits: int, num_tables: int, bits_per_table: int, seed: int | None = None
) -> list[list[int]]:
    """Sampled bit positions of every hash table."""
    check_hash_bits(hash_bits)
    if bits_per_table > hash_bits:
        raise ValueError("bits_per_table cannot exceed hash_bits")
    draw = random.Random(seed)
    return [draw.sample(range(hash_bits), bits_per_table) for _ in range(num_tables)]


def bits_mask(indices: list[int]) -> int:
    """One bigint with the given bit positions set."""
    return signed(sum(1 << i for i in indices))


def flip_masks(hash_bits: int, radius: int) -> list[int]:
    """All XOR masks of one to ``radius`` set bits."""
    check_hash_bits(hash_bits)
    return [
        bits_mask(list(chosen))
        for flipped in range(1, radius + 1)
        for chosen in combinations(range(hash_bits), flipped)
    ]


def bit(value: Column, index: int) -> Column:
    return F.shiftrightunsigned(value, index).bitwiseAND(F.lit(1).cast("bigint"))


def assemble_bits(flags: list[Column]) -> Column:
    """A bigint whose bit i is set where ``flags[i]`` is true."""
    zero = F.lit(0).cast("bigint")
    placed = [F.when(flag, F.lit(bits_mask([i])).cast("bigint")).otherwise(zero) for i, flag in enumerate(flags)]
    return reduce(lambda left, right: left.bitwiseOR(right), placed)


def bit_sample(vector: Column | str, indices: list[int]) -> Column:
    """Output bit i is bit ``indices[i]`` of the vector."""
    source = as_column(vector)
    sampled = [F.shiftleft(bit(source, index), i) for i, index in enumerate(indices)]
    return reduce(lambda left, right: left.bitwiseOR(right), sampled)


def signature_to_binary(signature: Column | str, hash_bits: int) -> Column:
    """Zero-padded binary string, most significant bit first."""
    check_hash_bits(hash_bits)
    return F.lpad(F.bin(as_column(signature)), hash_bits, "0")


def signature_from_binary(text: Column | str) -> Column:
    """The bigint behind a binary string of up to 64 digits."""
    return F.conv(as_column(text), 2, -10).cast("bigint")


def hamming_distance(left: Column | str, right: Column | str) -> Column:
    """Number of differing bits."""
    return F.bit_count(as_column(left).bitwiseXOR(as_column(right))).cast("bigint")


def bit_similarity(left: Column | str, right: Column | str, bits: int) -> Column:
    """One minus the share of differing bits."""
    return F.lit(1.0) - hamming_distance(left, right) / F.lit(float(bits))


def minhash_similarity(left: Column | str, right: Column | str) -> Column:
    """Share of equal positions; signatures of different length are an error."""
    a, b = as_column(left), as_column(right)
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    return F.when(
        F.size(a) != F.size(b),
        F.raise_error("signatures have to be of one length to be compared").cast("double"),
    ).otherwise(equal / F.size(a).cast("double"))
