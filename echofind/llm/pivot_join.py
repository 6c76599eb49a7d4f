"""SimHash fingerprints and their links, found by tables of distances to reference fingerprints.

A fingerprint has 64 bits; two link when at most ``RADIUS`` differ. The bits are cut into
``GROUPS`` groups, and each group has references that agree outside it, so the distances to
them, less the distance to the group's first reference, depend on the bits of that
group alone. A bit that differs moves no distance by more than one:

- A link leaves all but ``RADIUS`` groups untouched. Fingerprints therefore meet under the table
  entries of every choice of ``GROUPS - RADIUS`` groups.
- Of those that meet, a pair goes as soon as one of its distances differs by more than
  ``RADIUS``; the maximum coordinate difference is a lower bound of the distance.
- What is left is verified bit by bit.

Copies are one fingerprint from the start, so a bucket holds different fingerprints only. One of
more than ``BUCKET`` is not compared pair by pair: its members meet under themselves and their
64 neighbours at distance one, where any two that meet are links (``RADIUS`` 2).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echofind.llm.common import mix, slices, written
from echofind.llm.components import components

WORDS = 3
SEED = 42
RADIUS = 2
GROUPS = 5
#: References for each group of bits, the first of them common to all groups.
REFERENCES = 16
#: Fingerprints of a bucket that are compared with one another.
BUCKET = 512
#: Shingles whose bits are counted at a time: 64 bytes each.
CHUNK = 1 << 16
#: Pairs whose coordinates are compared at a time.
PAIRS = 1 << 19

FINGERPRINTS = "doc_id long, fp long"


def shingle_hashes(text: bytes) -> list[int]:
    """XXH64 of every word shingle, repeats included; fewer words are one shingle, no words none."""
    words = text.lower().split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) < WORDS:
        return [xxhash.xxh64_intdigest(line, SEED)]
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[: len(words) - WORDS + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(start, end[WORDS - 1 :].tolist(), strict=True)]


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits (the least significant first)."""
    total = np.zeros(64, np.int64)
    for a in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[a : a + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None) -> int:
    """The SimHash of a text, unsigned: a bit is 1 if more than half of the hashes have it."""
    hashes = np.array(shingle_hashes((text or "").encode()), np.uint64)
    ones = 2 * set_bits(hashes) > len(hashes)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        encoded = [(t or "").encode() for t in batch["text"]]
        fps = np.zeros(len(encoded), np.uint64)
        # Short texts share one pass over their bits.
        for a, b in slices(encoded, CHUNK * 4):
            hashes = [shingle_hashes(e) for e in encoded[a:b]]
            if b - a == 1:
                fps[a] = np.packbits(2 * set_bits(np.array(hashes[0], np.uint64)) > len(hashes[0]), bitorder="little").view("<u8")[0]
                continue
            size = np.array([len(h) for h in hashes])
            some = np.flatnonzero(size)
            if not len(some):
                continue
            flat = np.array([x for h in hashes for x in h], np.uint64)
            bits = np.unpackbits(flat.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, (np.cumsum(size) - size)[some], axis=0, dtype=np.int32)
            fps[a + some] = np.packbits(2 * ones > size[some, None], axis=1, bitorder="little").view("<u8").ravel()
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fp": fps.view(np.int64)})


def references() -> tuple[np.ndarray, list[slice]]:
    """The reference fingerprints, and where those of each group stand; all agree with the first outside their group."""
    base = mix(np.array([SEED], np.uint64))[0]
    edges = np.linspace(0, 64, GROUPS + 1).astype(int)
    out, spans = [base], []
    for g, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        mask = np.uint64((1 << int(high)) - (1 << int(low)))
        noise = mix(np.arange(1, REFERENCES, dtype=np.uint64) + np.uint64(1000 * (g + 1)))
        spans.append(slice(len(out), len(out) + REFERENCES - 1))
        out += (base ^ (noise & mask)).tolist()
    return np.array(out, np.uint64), spans


PIVOTS, SPANS = references()


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of every fingerprint to every reference, one row for each reference."""
    table = np.empty((len(PIVOTS), len(fps)), np.uint8)
    for row, pivot in zip(table, PIVOTS, strict=True):
        np.bitwise_count(fps ^ pivot, out=row)
    return table


def _emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        fps = batch["fp"].to_numpy(np.int64).view(np.uint64)
        table = pivot_table(fps).astype(np.int64)
        names = []
        for span in SPANS:
            own = (table[span] - table[0] + 64).astype(np.uint64)
            weight = mix(np.arange(1, len(own) + 1, dtype=np.uint64)) | np.uint64(1)
            names.append(mix((own * weight[:, None]).sum(axis=0, dtype=np.uint64)))
        for i, choice in enumerate(combinations(range(GROUPS), GROUPS - RADIUS)):
            key = np.full(len(fps), i + 1, np.uint64)
            for g in choice:
                key = mix(key ^ names[g])
            yield pd.DataFrame({"key": key.view(np.int64), "fp": fps.view(np.int64)})


def near_pairs(fps: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the pairs (x, y) of places in ``fps`` link: the pivot table discards, the bits decide."""
    table = pivot_table(fps).astype(np.int8)
    live = np.arange(len(x))
    for row in table:
        live = live[np.abs(row[x[live]] - row[y[live]]) <= RADIUS]
    return live[np.bitwise_count(fps[x[live]] ^ fps[y[live]]) <= RADIUS]


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """The links (a, b) that a spanning forest of them needs."""
    lead: dict[int, int] = {}

    def root(node: int) -> int:
        while (up := lead.setdefault(node, node)) != node:
            lead[node] = node = lead[up]
        return node

    out = []
    for s, t in zip(a.tolist(), b.tolist(), strict=True):
        u, v = root(s), root(t)
        if u != v:
            lead[u] = v
            out.append((s, t))
    return out


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A spanning forest (a, b) of the links in some buckets."""
    for batch in batches:
        buckets = [np.asarray(b, np.int64) for b in batch["fps"]]
        while buckets:
            part, room = [], PAIRS
            while buckets and (room > 0 or not part):
                part.append(buckets.pop())
                room -= len(part[-1]) ** 2 // 2
            fps = np.concatenate(part)
            base = np.cumsum([0, *map(len, part)])
            corner = [np.triu_indices(len(p), 1) for p in part]
            x = np.concatenate([c[0] + o for c, o in zip(corner, base, strict=False)])
            y = np.concatenate([c[1] + o for c, o in zip(corner, base, strict=False)])
            at = near_pairs(fps.view(np.uint64), x, y)
            if len(at):
                yield pd.DataFrame(forest(fps[x[at]], fps[y[at]]), columns=["a", "b"])


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each fingerprint under itself and under all that differ in one bit."""
    flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
    for batch in batches:
        fps = batch["fp"].to_numpy(np.int64).view(np.uint64)
        for a in range(0, len(fps), 4096):
            part = fps[a : a + 4096]
            yield pd.DataFrame({"key": (part[:, None] ^ flips).ravel().view(np.int64), "fp": np.repeat(part, len(flips)).view(np.int64)})


def fingerprint_links(fps: DataFrame, most: int = BUCKET) -> DataFrame:
    """(a, b): links that connect whatever of the distinct ``fps`` (fp) is connected. Written to the shared folder."""
    keys = written(fps.mapInPandas(_emit, "key long, fp long"))
    sizes = written(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    met = keys.join(sizes.filter(F.col("n") <= most).select("key"), "key")
    buckets = met.groupBy("key").agg(F.collect_list("fp").alias("fps"))
    links = buckets.select("fps").mapInPandas(_compare, "a long, b long").distinct()
    hot = sizes.filter(F.col("n") > most).select("key")
    if not hot.isEmpty():
        crowd = keys.join(hot, "key", "left_semi").select("fp").distinct()
        # At most 65 fingerprints have a key here, and any two of them differ in two bits at most.
        around = crowd.mapInPandas(_neighbours, "key long, fp long").groupBy("key").agg(F.collect_list("fp").alias("fps"), F.min("fp").alias("a"))
        links = links.unionByName(around.select("a", F.explode("fps").alias("b")).filter("a <> b").distinct())
    return written(links)


def near_duplicates(docs: DataFrame, most: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs`` (doc_id, text).

    ``component_id`` is the least doc_id that links reach, the row's own included. A null text is an
    empty one; texts without words have fingerprint zero and link like any other. Texts of
    any length are read whole. Rows of one doc_id are rows of their own with their own
    fingerprints. A row without doc_id keeps its place and gets the component of its
    fingerprint, null if no row of that component has a doc_id. An empty table gives an empty result; other
    columns of ``docs`` are left out.
    """
    members = written(docs.select("doc_id", "text").mapInPandas(_fingerprints, FINGERPRINTS))
    nodes = members.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    nodes = written(nodes)
    labels = components(fingerprint_links(nodes.select("fp"), most)).select(F.col("node").alias("fp"), "label")
    placed = nodes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = placed.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = placed.join(least, "label").select("fp", "component_id")
    return members.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
