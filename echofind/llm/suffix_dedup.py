"""Repeated byte strings by a depth-limited most-significant-digit sort of suffixes.

Suffixes are ordered only through their first ``DEPTH`` bytes; groups that are still
equal then are exactly the repeated windows. The passes:

1. The first digit of a window is its anchor, the least of its 24-byte grams under a
   fixed hash (leftmost on ties). Equal windows have equal anchors. Anchors found in
   one document only hold no repeated window; all their suffixes are dropped here.
2. The windows of an anchor lie in one context, the bytes around it. Contexts travel as names. One whose name
   an earlier document has is repeated as a whole. Of the others, a window has 13 bytes or more beside
   its anchor on one side: that is its second digit, and a context that shares neither side's
   13 bytes with another context of its anchor is dropped.
3. What is left, one context for each name, meets by anchor as bytes. Windows are sorted by the anchor's place, then four bytes at a time;
   singletons are dropped after every pass. An anchor of very many contexts is dealt
   out by whole windows instead.
4. Each block of documents removes the bytes that its repeated windows cover.

Documents travel once, in compressed blocks that stay where they are for all passes; verdicts come to them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echofind.llm.common import BASE, byte_codes, co_located, mix, powers, slices, written

DEPTH = 50
GRAM = 24
#: Grams in a window.
SPAN = DEPTH - GRAM + 1
#: Widest context: all windows that hold an anchor.
WIDE = DEPTH + SPAN - 1
#: Bytes that every window has on one side of its anchor at least.
SIDE = (DEPTH - GRAM + 1) // 2
BLOCK_BYTES = 2 << 20
#: Bytes of text in the blocks of one task.
TASK_BYTES = 16 << 20
#: Anchors of more open contexts than this are dealt out by window. The result is the same either way.
HOT_CONTEXTS = 1024
#: Anchors that one task of the first pass sorts.
ANCHORS_PER_TASK = 2_000_000

BLOCK = "block long, ids binary, sizes binary, data binary"
WHOLE, OPEN, HOT = np.uint8(1), np.uint8(2), np.uint8(4)
_INVERSE = pow(BASE, -1, 1 << 64)


def to_blocks(block_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Named by partition and place, so that a task that runs again gives the same blocks.
        name = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            for a, b in slices(texts, block_bytes):
                encoded = [t.encode() for t in texts[a:b]]
                ids, sizes = batch["doc_id"].to_numpy(np.int64)[a:b], np.array([len(e) for e in encoded], np.int64)
                data = zstandard.ZstdCompressor(level=3).compress(b"".join(encoded))
                yield pd.DataFrame([(name, ids.tobytes(), sizes.tobytes(), data)], columns=["block", "ids", "sizes", "data"])
                name += 1

    return run


def _rolled(codes: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hashes of ``width`` codes from each place on, by doubling."""
    out, size, power = None, 0, codes
    step = 1  # ``power`` holds hashes of ``step`` codes
    while True:
        if width & step:
            if out is None:
                out, size = power, step
            else:  # the wider part first
                n = len(codes) - size - step + 1
                out = power[:n] * _power(size) + out[step : step + n]
                size += step
        if size == width:
            return out
        n = len(power) - step
        power = power[:n] * _power(step) + power[step : step + n]
        step *= 2


def _power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 1 << 64))


class Block:
    """A block of documents with its anchors: for each, its place and the windows (first start, count) that it leads."""

    def __init__(self, ids: bytes, sizes: bytes, data: bytes) -> None:
        self.ids, self.sizes = np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.codes = byte_codes()[self.data]
        n = len(self.data)
        self.place = self.start = self.count = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.uint64)
        if n >= DEPTH:
            grams = _rolled(self.codes, GRAM)
            # The upper half of the hash decides, then the place.
            least = grams & ~np.uint64(0xFFFFFFFF) | np.arange(len(grams), dtype=np.uint64)
            for step in (1, 2, 4, 8, SPAN - 16):
                least = np.minimum(least[:-step], least[step:])
            valid = np.ones(n - DEPTH + 1, bool)
            for end in self.ends[:-1]:
                valid[max(0, end - DEPTH + 1) : end] = False
            starts = np.flatnonzero(valid)
            if len(starts):
                lead = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
                new = np.concatenate([[True], (lead[1:] != lead[:-1]) | (starts[1:] != starts[:-1] + 1)])
                cut = np.flatnonzero(new)
                self.start, self.count = starts[cut], np.diff(np.append(cut, len(starts)))
                self.place = lead[cut]
                self.key = mix(grams[self.place])
        self.doc = np.searchsorted(self.ends, self.place, "right")

    def contexts(self, keep: np.ndarray) -> "Contexts":
        return Contexts(self, keep)


class Contexts:
    """The contexts of the anchors in ``keep``, each distinct one once, in the order of their names.

    ``of`` maps each anchor kept to its context, ``first`` each context to an anchor kept; ``low`` is the least document of a context.
    """

    def __init__(self, block: Block, keep: np.ndarray) -> None:
        self.block = block
        self.start, self.count, self.place, key, self.doc = (x[keep] for x in (block.start, block.count, block.place, block.key, block.doc))
        n = len(block.data)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(block.codes * powers(n))]) if n else np.zeros(1, np.uint64)
        self.back = powers(n + 1, _INVERSE)
        offset = self.place - self.start
        stop = self.start + self.count + DEPTH - 1
        shape = mix((offset * 64 + self.count).astype(np.uint64))
        # Equal names are equal bytes around an anchor at the same place but for a chance of 2**-64.
        name = mix(self.hashes(self.start, stop) + shape)
        self.name, self.first, self.of = np.unique(name, return_index=True, return_inverse=True)
        self.key = key[self.first]
        self.low = np.full(len(self.first), np.iinfo(np.int64).max)
        np.minimum.at(self.low, self.of, block.ids[self.doc])
        place, offset, stop = self.place[self.first], offset[self.first], stop[self.first]
        left = mix(self.hashes(np.maximum(place - SIDE, 0), place)) >> np.uint64(48) | np.uint64(1)
        right = mix(self.hashes(np.minimum(place + GRAM, n), np.minimum(place + GRAM + SIDE, n))) >> np.uint64(48) | np.uint64(1)
        # Zero where a context has fewer bytes on a side.
        left[offset < SIDE] = 0
        right[stop - place - GRAM < SIDE] = 0
        self.sides = (left << np.uint64(16) | right).astype(np.uint32)

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.back[start]

    def cells(self, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The bytes of some windows that follow each other, one row for each start, zeros behind them."""
        padded = np.concatenate([self.block.data, np.zeros(WIDE, np.uint8)])
        out = np.empty((len(start), WIDE), np.uint8)
        for a in range(0, len(start), 1 << 16):
            out[a : a + (1 << 16)] = padded[start[a : a + (1 << 16), None] + np.arange(WIDE)]
        out[~_used(count)] = 0
        return out


def _by_bucket(names: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    bucket = (mix(names) >> np.uint64(33)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for i in np.flatnonzero(np.diff(cut)):
        yield int(i), order[cut[i] : cut[i + 1]]


def anchor_names(buckets: int):
    """Each block's distinct anchors by bucket: (block, bucket, 32 further bits of each)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, ids, sizes, data in batch[["block", "ids", "sizes", "data"]].itertuples(index=False):
                key = np.unique(Block(ids, sizes, data).key)
                rows = [(block, i, np.unique(key[at].astype(np.uint32)).tobytes()) for i, at in _by_bucket(key, buckets)]
                if rows:
                    yield pd.DataFrame(rows, columns=["block", "bucket", "names"])

    return run


def shared_names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each block and bucket, the anchors that other blocks have too."""
    held: dict[int, list] = {}
    for batch in batches:
        for block, bucket, names in batch[["block", "bucket", "names"]].itertuples(index=False):
            held.setdefault(bucket, []).append((block, np.frombuffer(names, np.uint32)))
    while held:
        bucket, parts = held.popitem()
        names = np.concatenate([p[1] for p in parts])
        owner = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
        order = np.argsort(names, kind="stable")
        names, owner = names[order], owner[order]
        same = names[1:] == names[:-1]
        keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        names, owner = names[keep], owner[keep]
        order = np.argsort(owner, kind="stable")
        names, owner = names[order], owner[order]
        cut = np.searchsorted(owner, np.arange(len(parts) + 1))
        rows = [(parts[i][0], bucket, names[cut[i] : cut[i + 1]].tobytes()) for i in np.flatnonzero(np.diff(cut))]
        if rows:
            yield pd.DataFrame(rows, columns=["block", "bucket", "names"])


def _contexts(row, buckets: int) -> Contexts:
    """The contexts of a block's shared anchors. ``row.shared`` lists those it shares with other blocks."""
    block = Block(row.ids, row.sizes, row.data)
    n = len(block.key)
    keep = np.zeros(n, bool)
    if n:
        # Anchors of several documents of this block.
        order = np.argsort(block.key, kind="stable")
        key, doc = block.key[order], block.doc[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, n))
        keep[order] = np.repeat(np.maximum.reduceat(doc, start) != np.minimum.reduceat(doc, start), size)
        if row.shared is not None and len(row.shared):
            bucket = (mix(block.key) >> np.uint64(33)).astype(np.int64) % buckets
            name = bucket.astype(np.uint64) << np.uint64(32) | (block.key & np.uint64(0xFFFFFFFF))
            keep |= np.isin(name, np.concatenate([np.frombuffer(p["names"], np.uint32).astype(np.uint64) | np.uint64(p["bucket"] << 32) for p in row.shared]))
    return block.contexts(keep)


def _zipped(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unzipped(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _used(counts: np.ndarray) -> np.ndarray:
    """The cells of each context that its windows reach."""
    return np.arange(WIDE) < (counts.astype(np.int64) + DEPTH - 1)[:, None]


def name_rows(buckets: int):
    """The names of each block's contexts by the bucket of their anchor: 32 further bits of the anchor, name, sides, least document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                c = _contexts(row, buckets)
                rows = [(row.block, i, c.key[at].astype(np.uint32).tobytes(), c.name[at].tobytes(), c.sides[at].tobytes(), _zipped(c.low[at])) for i, at in _by_bucket(c.key, buckets)]
                if rows:
                    yield pd.DataFrame(rows, columns=["block", "bucket", "keys", "names", "sides", "lows"])

    return run


def _repeats(values: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    _, of, count = np.unique(values, return_inverse=True, return_counts=True)
    return count[of] > 1


def judge_names(hot_contexts: int):
    """For each block and bucket, a byte for each context in the order in which they came: WHOLE, or OPEN (and HOT), or 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                held.setdefault(row.bucket, []).append(row)
        while held:
            bucket, parts = held.popitem()
            read = lambda column, kind: np.concatenate([np.frombuffer(getattr(p, column), kind) for p in parts])  # noqa: B023, E731
            key, name, side = read("keys", np.uint32), read("names", np.uint64), read("sides", np.uint32)
            low = np.concatenate([_unzipped(p.lows, np.int64) for p in parts])
            order = np.lexsort((name, key))
            key, name = key[order], name[order]
            start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (name[1:] != name[:-1])]))
            group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(key))))
            whole = low[order] > np.minimum.reduceat(low[order], start)[group]
            key, side = key[start].astype(np.uint64), side[order][start].astype(np.uint64)
            left, right = side >> np.uint64(16), side & np.uint64(0xFFFF)
            again = (left > 0) & _repeats(key << np.uint64(16) | left) | (right > 0) & _repeats(key << np.uint64(16) | right)
            _, of = np.unique(key, return_inverse=True)
            many = np.bincount(of, weights=again)[of] > hot_contexts
            flags = np.zeros(len(low), np.uint8)
            flags[order] = np.where(whole, WHOLE, np.where(again, OPEN | np.where(many, HOT, np.uint8(0)), np.uint8(0))[group])
            cut = np.cumsum([0, *(len(p.keys) // 4 for p in parts)])
            rows = [(p.block, bucket, flags[a:b].tobytes()) for p, a, b in zip(parts, cut[:-1], cut[1:], strict=True) if flags[a:b].any()]
            if rows:
                yield pd.DataFrame(rows, columns=["block", "bucket", "flags"])

    return run


def _flags(row, c: Contexts, buckets: int) -> np.ndarray:
    out = np.zeros(len(c.name), np.uint8)
    if row.flags is not None and len(row.flags):
        given = {p["bucket"]: p["flags"] for p in row.flags}
        for i, at in _by_bucket(c.key, buckets):
            if i in given:
                out[at] = np.frombuffer(given[i], np.uint8)
    return out


def emit_contexts(buckets: int, parts: int):
    """The bytes of each block's open contexts; those of hot anchors as single windows, dealt out by what they hold."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                c = _contexts(row, buckets)
                flags = _flags(row, c, buckets)
                refs = np.flatnonzero(flags & OPEN)
                hot, count = flags[refs] & HOT > 0, c.count[c.first[refs]]
                each = np.where(hot, count, 1)
                shift = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                refs, hot = np.repeat(refs, each), np.repeat(hot, each)
                count = np.where(hot, 1, np.repeat(count, each))
                start, place = c.start[c.first[refs]] + shift, c.place[c.first[refs]]
                route = c.key[refs]
                route[hot] ^= mix(c.hashes(start[hot], start[hot] + DEPTH))
                cells, places = c.cells(start, count), np.stack([place - start, count, shift]).astype(np.uint8)
                rows = []
                for i, at in _by_bucket(route, parts):
                    rows.append((row.block, i, _zipped(cells[at][_used(count[at])]), _zipped(places[:, at]), _zipped(c.low[refs[at]]), _zipped(refs[at].astype(np.int32))))
                if rows:
                    yield pd.DataFrame(rows, columns=["block", "bucket", "texts", "places", "lows", "refs"])

    return run


def equal_windows(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of equal windows among contexts: (context, window in it, group) of every window that has an equal."""
    count = rows[:, WIDE + 1].astype(np.int64)
    context = np.repeat(np.arange(len(rows)), count)
    window = np.arange(len(context)) - np.repeat(np.cumsum(count) - count, count)
    flat = np.ascontiguousarray(rows[:, :WIDE]).reshape(-1)
    digits = np.ndarray((len(flat) - 3,), ">u4", flat, strides=(1,))
    # Equal windows have their anchor at the same place.
    group = (rows[context, WIDE].astype(np.int64) - window).astype(np.uint64)
    base = context * WIDE + window
    live = np.arange(len(context))
    for byte in (*range(0, DEPTH - 4, 4), DEPTH - 4):
        if not len(live):
            return
        # A group has a dense number below 2**32, so one sort orders by group, then digit.
        key = group << np.uint64(32) | digits[base[live] + byte].astype(np.uint64)
        order = np.argsort(key)
        key = key[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        alive = np.repeat(size > 1, size)
        live = live[order][alive]
        group = np.repeat(np.arange(int((size > 1).sum()), dtype=np.uint64), size[size > 1])
    if len(live):
        yield context[live], window[live], group


def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each block, the contexts (by their number there) with windows that start in an earlier document, as bits."""
    held: dict[int, list] = {}
    for batch in batches:
        for row in batch.itertuples(index=False):
            held.setdefault(row.bucket, []).append(row)
    while held:
        _, parts = held.popitem()
        lows, refs = (np.concatenate([_unzipped(getattr(p, c), t) for p in parts]) for c, t in (("lows", np.int64), ("refs", np.int32)))
        places = [_unzipped(p.places, np.uint8).reshape(3, -1).T for p in parts]
        sizes = [len(p) for p in places]
        shift = np.concatenate(places)[:, 2].astype(np.uint32)
        rows = np.zeros((len(lows), WIDE + 2), np.uint8)
        rows[:, WIDE:] = np.concatenate(places)[:, :2]
        cells = np.zeros((len(lows), WIDE), np.uint8)
        cells[_used(rows[:, WIDE + 1])] = np.concatenate([_unzipped(p.texts, np.uint8) for p in parts])
        rows[:, :WIDE] = cells
        bits = np.zeros(len(rows), np.uint32)
        for context, window, group in equal_windows(rows):
            start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            low = np.minimum.reduceat(lows[context], start)
            later = lows[context] > np.repeat(low, np.diff(np.append(start, len(group))))
            np.bitwise_or.at(bits, context[later], (np.uint32(1) << window[later].astype(np.uint32)))
        cut = np.cumsum([0, *sizes])
        out = []
        for p, a, b in zip(parts, cut[:-1], cut[1:], strict=True):
            at = np.flatnonzero(bits[a:b])
            if len(at):
                out.append((p.block, refs[a:b][at].tobytes(), (bits[a:b] << shift[a:b])[at].tobytes()))
        if out:
            yield pd.DataFrame(out, columns=["block", "refs", "bits"])


def remove(buckets: int, keep_text: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                c = _contexts(row, buckets)
                block, flags = c.block, _flags(row, c, buckets)
                bits = np.zeros(len(c.low), np.uint32)
                for part in row.judged if row.judged is not None else ():
                    np.bitwise_or.at(bits, np.frombuffer(part["refs"], np.int32), np.frombuffer(part["bits"], np.uint32))
                # All windows of a context go where an earlier document has the whole of it, some where it has those.
                whole = (flags[c.of] == WHOLE) | (block.ids[c.doc] > c.low[c.of])
                mask = np.where(whole, np.uint32(0xFFFFFFFF), bits[c.of])
                edge = np.zeros(len(block.data) + 1, np.int32)
                for j in range(int(c.count.max()) if len(c.count) else 0):
                    at = c.start[(c.count > j) & (mask >> np.uint32(j) & np.uint32(1) != 0)] + j
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + DEPTH, -1)
                gone = np.cumsum(edge)[:-1] > 0
                out = []
                for i, (end, size) in enumerate(zip(block.ends, block.sizes, strict=True)):
                    g = gone[end - size : end]
                    kept = block.data[end - size : end][~g].tobytes()
                    spans = int((g[1:] & ~g[:-1]).sum()) + int(size > 0 and g[0])
                    out.append((int(block.ids[i]), int(size), int(g.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
                yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def deduplicate(docs: DataFrame, keep_text: bool = True, block_bytes: int = BLOCK_BYTES, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and (with ``keep_text``) the kept bytes of every document.

    A byte goes if a ``DEPTH``-byte string that covers it also starts in a document of a
    smaller doc_id. A null text is empty; texts under ``DEPTH`` bytes lose nothing, texts of any length are read whole (one longer than
    a block is a block by itself); rows of one
    doc_id never remove from each other; rows without doc_id take no part; an empty
    table gives an empty result.
    """
    docs = docs.select("doc_id", "text").filter("doc_id is not null")
    total = docs.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # Every later pass joins its verdicts to the blocks by this partitioning; the blocks move once.
    blocks = co_located(docs.mapInPandas(to_blocks(block_bytes), BLOCK), max(16, -(-total // TASK_BYTES)), "block")
    buckets = max(16, -(-total // (ANCHORS_PER_TASK * SPAN // 2)))
    names = blocks.mapInPandas(anchor_names(buckets), "block long, bucket int, names binary")
    shared = names.repartition(buckets, "bucket").mapInPandas(shared_names, "block long, bucket int, names binary")
    known = blocks.join(written(shared.groupBy("block").agg(F.collect_list(F.struct("bucket", "names")).alias("shared"))), "block", "left")
    named = known.mapInPandas(name_rows(buckets), "block long, bucket int, keys binary, names binary, sides binary, lows binary")
    flags = named.repartition(buckets, "bucket").mapInPandas(judge_names(hot_contexts), "block long, bucket int, flags binary")
    rated = known.join(written(flags.groupBy("block").agg(F.collect_list(F.struct("bucket", "flags")).alias("flags"))), "block", "left")
    contexts = rated.mapInPandas(emit_contexts(buckets, buckets), "block long, bucket int, texts binary, places binary, lows binary, refs binary")
    judged = contexts.repartition(buckets, "bucket").mapInPandas(judge, "block long, refs binary, bits binary")
    verdicts = judged.groupBy("block").agg(F.collect_list(F.struct("refs", "bits")).alias("judged"))
    done = rated.join(verdicts, "block", "left").mapInPandas(remove(buckets, keep_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return done if keep_text else done.drop("kept")
