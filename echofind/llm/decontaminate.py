"""Benchmark decontamination by q-gram lemma filtering.

If a benchmark text of m characters lies in a document within k edits, the two share
at least m - q + 1 - k*q character q-grams, all of them on diagonals (place in the
document minus place in the benchmark text) at most k apart from one another's
start. An item's rarest q-grams, one more than it may lose, name the documents that
are looked at: one of them must be shared. For those, shared q-grams are counted in overlapping diagonal bands; bands that reach
the bound are regions, and a banded alignment decides each region exactly. Benchmark texts
shorter than a q-gram are searched for exactly, on word bounds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echofind.llm.common import BASE, byte_codes, lean, powers, slices, written

Q = 12
#: Edits allowed for each character of a benchmark text, fewer where the lemma would ask for no shared q-gram.
EDIT_RATE = 0.05
#: Bytes of benchmark text that are searched for in one pass over the documents; more go in further passes.
BLOCK_BYTES = 8 << 20
#: Pairs of a place in a document and one in an item that are listed at a time; beyond it they are counted by diagonal.
MOST_PAIRS = 1 << 21
#: Rows of which a task holds the texts apart from their Arrow batch, and characters whose q-grams it lists at a time.
SLICE_ROWS, SLICE_CHARS = 256, 1 << 18
_SPACES = re.compile(r"[\x20\x09-\x0d]+")
MATCHES = "doc_id long, item_id long, start long, end long, edits int"
_MATCHES = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])


def normal(text: str | None) -> str:
    """Lower case, runs of white space as one space, none at the ends."""
    return _SPACES.sub(" ", text or "").strip(" ").lower()


def budget(text: str, q: int = Q, rate: float = EDIT_RATE) -> tuple[int, int]:
    """Edits allowed for a normalised text and the q-grams of bytes that must then be shared (at least one).

    An edit takes at most q grams with it, and more by the further bytes of the character that it changes.
    """
    size = len(text.encode())
    each = q + max((len(c.encode()) - 1 for c in text), default=0)
    k = int(len(text) * rate)
    while k and size - q + 1 - k * each < 1:
        k -= 1
    return k, max(1, size - q + 1 - k * each)


def grams(data: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash of the q bytes that start at each place."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    codes = byte_codes()[data]
    out = np.zeros(n, np.uint64)
    for weight, i in zip(powers(q), range(q), strict=True):
        out += codes[i : i + n] * weight
    return out


def _within(pattern: str, letters: np.ndarray, k: int, first: int, last: int) -> tuple[int, int, int] | None:
    """``banded`` for exactly this ``k``: only cells of at most k edits are kept from row to row."""
    n, far = len(letters), np.int32(1 << 29)
    low = first
    row, origin = np.zeros(last - first + 1, np.int32), np.arange(first, last + 1, dtype=np.int32)
    steps = np.arange(len(row) + 2 * (k + 2) + 2, dtype=np.int32)
    for i, c in enumerate(pattern.encode("utf-32-le", "surrogatepass")[j : j + 4] for j in range(0, 4 * len(pattern), 4)):
        width = min(n, low + len(row) + k, last + i + 1 + k) - low + 1
        if width > len(steps):
            steps = np.arange(2 * width, dtype=np.int32)
        held = min(len(row), width)
        now, start = np.full(width, far, np.int32), np.zeros(width, np.int32)
        now[:held], start[:held] = row[:held] + 1, origin[:held]
        m = min(len(row), width - 1)
        diagonal = row[:m] + (letters[low : low + m] != int.from_bytes(c, "little"))
        take = diagonal <= now[1 : m + 1]
        now[1 : m + 1] = np.where(take, diagonal, now[1 : m + 1])
        start[1 : m + 1] = np.where(take, origin[:m], start[1 : m + 1])
        # Insertions run along the row: a running minimum of value minus place.
        shifted = now - steps[:width]
        least = np.minimum.accumulate(shifted)
        at = np.maximum.accumulate(np.where(shifted == least, steps[:width], 0))
        now = least + steps[:width]
        live = np.flatnonzero(now <= k)
        if not len(live):
            return None
        a, b = live[0], live[-1] + 1
        row, origin, low = now[a:b], start[at[a:b]], low + int(a)
    end = int(np.argmin(row))
    return int(row[end]), int(origin[end]), low + end


def banded(pattern: str, text: str, k: int, first: int = 0, last: int | None = None, expected: int = 0) -> tuple[int, int, int] | None:
    """Fewest edits (at most k) that make ``pattern`` of a stretch of ``text``, with its start and end.

    The stretch starts at ``first`` to ``last``; the leftmost of the best ends is taken. Cells
    lie in the band of those diagonals and k more on each side. A few more edits than ``expected`` are tried first,
    with a narrower band.
    """
    first, last = max(0, first), len(text) if last is None else min(last, len(text))
    if first > last:
        return None
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    tried = expected * 5 // 4 + 4
    while tried < k:
        found = _within(pattern, letters, tried, first, last)
        if found:
            return found
        tried *= 2
    return _within(pattern, letters, k, first, last)


class Items:
    """The q-grams of a block of benchmark texts behind a bit table that turns most lookups away."""

    def __init__(self, rows: list[tuple[int, str]], q: int, rate: float) -> None:
        self.ids, self.texts = [r[0] for r in rows], [normal(r[1]) for r in rows]
        self.budgets = [budget(t, q, rate) for t in self.texts]
        # Offsets count bytes here.
        parts = [grams(np.frombuffer(t.encode(), np.uint8), q) for t in self.texts]
        self.own = []
        for h in parts:
            order = np.argsort(h, kind="stable")
            self.own.append((h[order], order))
        values, seen = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        leads, items = [], []
        for i, (h, (_, least)) in enumerate(zip(parts, self.budgets, strict=True)):
            # Of these one must be shared where ``least`` are; repeated ones of a text count once each.
            rarest = np.argsort(seen[np.searchsorted(values, h)], kind="stable")[: max(0, len(h) - least + 1)]
            leads.append(np.unique(h[rarest]))
            items.append(np.full(len(leads[-1]), i))
        h = np.concatenate(leads) if parts else values
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.items = np.concatenate(items)[order] if parts else np.zeros(0, np.int64)
        self.bits = max(16, min(24, int(np.log2(len(values) + 1)) + 5))
        self.lead, self.any = np.zeros(1 << self.bits, bool), np.zeros(1 << self.bits, bool)
        self.lead[h >> np.uint64(64 - self.bits)] = True
        self.any[values >> np.uint64(64 - self.bits)] = True
        self.short = ahocorasick.Automaton()
        for i, t in enumerate(self.texts):
            if t and not len(parts[i]):
                self.short.add_word(t, (*self.short.get(t, ()), i))
        if len(self.short):
            self.short.make_automaton()

    def named(self, h: np.ndarray, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The distinct doc * items + item of which a lead q-gram is shared, by runs of ``MOST_PAIRS``."""
        low = np.searchsorted(self.hashes, h[at], "left")
        n = np.searchsorted(self.hashes, h[at], "right") - low
        doc, low, n = doc[n > 0], low[n > 0], n[n > 0]
        total, out, a = np.cumsum(n), np.zeros(0, np.int64), 0
        while a < len(n):
            b = max(a + 1, int(np.searchsorted(total, total[a] - n[a] + MOST_PAIRS, "right")))
            entry = np.repeat(low[a:b] - np.cumsum(n[a:b]) + n[a:b], n[a:b]) + np.arange(n[a:b].sum())
            out = np.union1d(out, np.repeat(doc[a:b], n[a:b]) * len(self.ids) + self.items[entry])
            a = b
        return out

    def search(self, texts: list[str], q: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(index of the text, item id, start, end, edits) of every benchmark text found; offsets in normalised characters."""
        encoded = [t.encode() for t in texts]
        ends = np.cumsum([len(e) + 1 for e in encoded])
        data = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
        h = grams(data, q)
        at = np.flatnonzero(self.lead[h >> np.uint64(64 - self.bits)])
        known = -1
        for pair in self.named(h, at, np.searchsorted(ends, at, "right")).tolist():
            d, i = divmod(pair, len(self.ids))
            if d != known:
                known, base = d, int(ends[d]) - len(encoded[d]) - 1
                here = h[base : max(base, base + len(encoded[d]) - q + 1)]
                place = np.flatnonzero(self.any[here >> np.uint64(64 - self.bits)])
                here = here[place]
            yield from self.regions(d, i, *self.diagonals(i, here, place), encoded[d])
        if len(self.short):
            for d, t in enumerate(texts):
                yield from self.short_texts(d, t)

    def diagonals(self, i: int, here: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The diagonals on which a document shares q-grams with an item, rising, and how many up to each."""
        hashes, places = self.own[i]
        low = np.searchsorted(hashes, here, "left")
        n = np.searchsorted(hashes, here, "right") - low
        low, n, place = low[n > 0], n[n > 0], place[n > 0]
        if n.sum() <= MOST_PAIRS:
            entry = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            diagonal, count = np.unique(np.repeat(place, n) - places[entry], return_counts=True)
        else:
            counts = np.zeros(int(place[-1]) + len(places) + 1, np.int32)
            for j in range(int(n.max())):
                np.add.at(counts, place[n > j] - places[low[n > j] + j] + len(places), 1)
            diagonal = np.flatnonzero(counts)
            diagonal, count = diagonal - len(places), counts[diagonal]
        return diagonal, np.concatenate([[0], np.cumsum(count)])

    def regions(self, d: int, i: int, diagonals: np.ndarray, upto: np.ndarray, data: bytes) -> Iterator[tuple[int, int, int, int, int]]:
        k, least = self.budgets[i]
        pattern = self.texts[i]
        size = len(pattern.encode())
        width = (k if len(pattern) == size and data.isascii() else 4 * k) + 1  # a character has at most four bytes
        # Bands of twice the width that overlap by half: any stretch of ``width`` diagonals lies in one of them.
        done = -1
        for band in np.unique(np.concatenate([diagonals // width, diagonals // width - 1])):
            low = int(band) * width
            count = upto[np.searchsorted(diagonals, low + 2 * width)] - upto[np.searchsorted(diagonals, low)]
            if count < least:
                continue
            left, right = max(0, low - width), min(len(data), low + 2 * width + size + width)
            before = len(data[:left].decode(errors="ignore"))
            first = len(data[left : max(left, low)].decode(errors="ignore")) - k
            last = len(data[left : max(left, low + 2 * width)].decode(errors="ignore")) + k
            if before + last <= done:
                continue
            # An edit loses q q-grams at most, or a few more where characters have several bytes.
            lost = (size - Q + 1 - int(count)) // (Q + (0 if len(pattern) == size else 3))
            found = banded(pattern, data[left:right].decode(errors="ignore"), k, first, last, max(0, lost))
            if found and before + found[1] > done:
                done = before + found[2] - 1
                yield d, self.ids[i], before + found[1], before + found[2], found[0]

    def short_texts(self, d: int, text: str) -> Iterator[tuple[int, int, int, int, int]]:
        """Places of texts shorter than a q-gram, no letter or digit of theirs beside another."""
        done: dict[int, int] = {}
        for stop, found in self.short.iter(text):
            start, end = stop + 1 - len(self.texts[found[0]]), stop + 1
            if (start and text[start].isalnum() and text[start - 1].isalnum()) or (end < len(text) and text[stop].isalnum() and text[end].isalnum()):
                continue
            for i in found:
                if start >= done.get(i, 0):
                    done[i] = end
                    yield d, self.ids[i], start, end, 0


def benchmark_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about ``BLOCK_BYTES``, read one at a time."""
    rows = benchmark.select("item_id", "text").filter("item_id is not null and length(text) > 0").dropDuplicates().orderBy("item_id", "text")
    block, size = [], 0
    for r in rows.toLocalIterator():
        block.append((r["item_id"], r["text"]))
        size += len(r["text"].encode())
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def in_batches(items: Items, batches: Iterator[pa.RecordBatch], q: int) -> Iterator[pa.RecordBatch]:
    """What ``items`` finds in Arrow batches of doc_id and text, a slice of the texts at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_ROWS):
            ids, texts = (batch.column(name).slice(first, SLICE_ROWS).to_pylist() for name in ("doc_id", "text"))
            texts = [normal(t) for t in texts]
            for a, b in slices(texts, SLICE_CHARS):
                hits = [(int(ids[a + d]), *rest) for d, *rest in items.search(texts[a:b], q)]
                if hits:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*hits, strict=True), _MATCHES, strict=True)], schema=_MATCHES)


def find_leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE) -> DataFrame:
    """One row for each benchmark text found in each document: doc_id, item_id, start, end, edits.

    Offsets count the characters of the normalised text. A benchmark text counts once for each
    place that does not overlap an earlier one. Benchmark texts shorter than ``q`` bytes are found
    exactly, where no letter or digit of theirs touches another. Null or empty texts match nothing; texts of any length are searched whole;
    repeated rows repeat their result; a document without doc_id and an item without item_id take no part; an empty
    table on either side gives an empty result.
    """
    spark = docs.sparkSession
    found = None
    for block in benchmark_blocks(benchmark):
        # At most BLOCK_BYTES of text and the q-grams in it.
        shared = spark.sparkContext.broadcast(block)

        @lean
        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            yield from in_batches(Items(shared.value, q, rate), batches, q)

        part = docs.select("doc_id", "text").filter("doc_id is not null").mapInArrow(search, MATCHES)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], MATCHES) if found is None else found


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark text was found.

    The ids of the others are stored first: the search is over before the texts are read for the join, and the join
    knows how few they are.
    """
    leaks = written(find_leaks(docs, benchmark).select("doc_id").distinct())
    return docs.join(leaks, "doc_id", "left_anti").select(docs.columns)
