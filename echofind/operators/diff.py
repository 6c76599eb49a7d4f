"""Word-level differences of pairs of texts and their markup."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK_TYPE = "array<struct<op:string,word:string>>"
#: Words of the pairs that a worker marks at a time.
PIECE_WORDS = 50_000
#: Bits of a table that is kept whole, and words of a text whose bits are set one by one.
WHOLE_BITS, SHORT_WORDS = 1 << 24, 2_048
#: Pairs of texts that are split into words at a time.
SPLIT_ROWS = 64
# The markup around changed words.
MARKUP = {
    "html": {"deleted": ('<span class="deleted">', "</span>"), "added": ('<span class="added">', "</span>")},
    "latex": {"deleted": ("\\textcolor{red}{", "}"), "added": ("\\textcolor{green}{", "}")},
}


def _rows(words: list[str], places: dict[str, int], row: int, full: int) -> Iterator[int]:
    """The rows after ``row`` of the common-subsequence length table, as bit vectors: bit j is 0 where column j + 1 is one more than column j."""
    for word in words:
        hit = row & places.get(word, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _places(words: list[str]) -> dict[str, int]:
    """Where each word stands, as bits."""
    places: dict[str, int] = {}
    if len(words) <= SHORT_WORDS:
        for j, word in enumerate(words):
            places[word] = places.get(word, 0) | 1 << j
        return places
    bits: dict[str, list[int]] = {}
    for j, word in enumerate(words):
        bits.setdefault(word, []).append(j)
    for word, at in bits.items():
        vector = bytearray(len(words) // 8 + 1)
        for j in at:
            vector[j >> 3] |= 1 << (j & 7)
        places[word] = int.from_bytes(vector, "little")
    return places


def _length(row: int, j: int) -> int:
    """Column ``j`` of a row of the table."""
    return j - (row & ((1 << j) - 1)).bit_count()


def common_words(first: list[str], second: list[str]) -> list[str]:
    """Longest common subsequence; on ties the walk back steps in ``first``.

    Shared ends are set aside. A row of the length table is one long integer, worked on
    word by word of the machine. Of a large table only about sqrt(n) rows are kept, and each block of rows is rebuilt when the
    walk back reaches it, so whole texts fit in memory at any length.
    """
    start = 0
    limit = min(len(first), len(second))
    while start < limit and first[start] == second[start]:
        start += 1
    end = 0
    while end < limit - start and first[-1 - end] == second[-1 - end]:
        end += 1
    a, b = first[start : len(first) - end], second[start : len(second) - end]
    middle: list[str] = []
    if a and b:
        places = _places(b)
        full = (1 << len(b)) - 1
        # A small table is kept whole and worked out once.
        step = len(a) + 1 if len(a) * len(b) <= WHOLE_BITS else int(len(a) ** 0.5) + 1
        saved = [full]
        if step <= len(a):
            for i, row in enumerate(_rows(a, places, full, full), 1):
                if i % step == 0:
                    saved.append(row)
        j = len(b)
        for block in range((len(a) - 1) // step, -1, -1):
            low, high = block * step, min(len(a), (block + 1) * step)
            if j == 0:
                break
            table = [saved[block], *_rows(a[low:high], places, saved[block], full)]
            i = high
            while i > low and j > 0:
                if a[i - 1] == b[j - 1]:
                    middle.append(a[i - 1])
                    i, j = i - 1, j - 1
                elif _length(table[i - low - 1], j) >= _length(table[i - low], j - 1):
                    i -= 1
                else:
                    j -= 1
        middle.reverse()
    return first[:start] + middle + first[len(first) - end :]


def kept_words(tokens: list[str], common: list[str]) -> list[bool]:
    """Whether each word is kept: at its earliest place in ``common``."""
    kept, at = [], 0
    for word in tokens:
        kept.append(at < len(common) and word == common[at])
        at += kept[-1]
    return kept


def mark_words(tokens: list[str], common: list[str], changed: str) -> list[dict[str, str]]:
    """Label each word ``keep`` at its earliest place in ``common``, else ``changed``."""
    return [{"op": "keep" if kept else changed, "word": word} for word, kept in zip(tokens, kept_words(tokens, common), strict=True)]


def _pieces(batch: pa.RecordBatch, piece_words: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``piece_words`` words in all; a longer pair is a run by itself."""
    sizes = sum(pc.list_value_length(batch.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("words1", "words2"))
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > piece_words:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def _marks(words: pa.Array, kept: list[list[bool]], changed: str) -> pa.Array:
    """``MARK_TYPE`` of one side; the words stay the Arrow strings that they are."""
    ops = pc.if_else(pa.array([k for row in kept for k in row], pa.bool_()), "keep", changed)
    edge = pa.array(np.concatenate([[0], np.cumsum([len(row) for row in kept])]), pa.int32())
    return pa.ListArray.from_arrays(edge, pa.StructArray.from_arrays([ops, words.flatten()], ["op", "word"]))


def _listed(words: pa.Array) -> Iterator[list[str]]:
    """The lists of a column as Python lists; the words are made in one go."""
    each = words.flatten().to_numpy(zero_copy_only=False).tolist()
    edge = [0, *np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False)).tolist()]
    return (each[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True))


def _split_batches(batches: Iterator[pa.RecordBatch], split_rows: int = SPLIT_ROWS) -> Iterator[pa.RecordBatch]:
    """Words of both texts, a few rows at a time. Python and ``SPACE_CHARS`` have the same white space."""
    for whole in batches:
        for first in range(0, whole.num_rows, split_rows):
            batch = whole.slice(first, split_rows)
            columns = [batch.column("id1"), batch.column("id2")]
            for side in ("text1", "text2"):
                split = [text.split() for text in batch.column(side).to_pylist()]
                edge = np.concatenate([[0], np.cumsum([len(words) for words in split])])
                columns.append(pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array([w for words in split for w in words], pa.string())))
            yield pa.RecordBatch.from_arrays(columns, ["id1", "id2", "words1", "words2"])


def _diff_batches(batches: Iterator[pa.RecordBatch], piece_words: int = PIECE_WORDS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in _pieces(batch, piece_words):
            kept1, kept2 = [], []
            for first, second in zip(_listed(piece.column("words1")), _listed(piece.column("words2")), strict=True):
                common = common_words(first, second)
                kept1.append(kept_words(first, common))
                kept2.append(kept_words(second, common))
            marks = [_marks(piece.column("words1"), kept1, "deleted"), _marks(piece.column("words2"), kept2, "added")]
            yield pa.RecordBatch.from_arrays([piece.column("id1"), piece.column("id2"), *marks], ["id1", "id2", "diff1", "diff2"])


def pair_diff(texts: DataFrame, deal: bool = True) -> DataFrame:
    """``(id1, id2, diff1, diff2)`` from ``(id1, id2, text1, text2)``.

    Each side is an array of ``(op, word)`` with op ``keep`` and ``deleted`` in
    text 1, ``keep`` and ``added`` in text 2. The table walk is sequential, so
    it runs in Python on pieces of Arrow batches, where the texts are split too: a worker holds the marks of about ``PIECE_WORDS``
    words, whatever the number of pairs. A sample is a single partition, so the pairs are first dealt
    out to all slots; without ``deal`` they stay where they are and no text is shuffled.
    """
    slots = texts.sparkSession.sparkContext.defaultParallelism
    present = texts.select("id1", "id2", "text1", "text2").where("text1 is not null and text2 is not null")
    if deal:
        present = present.repartition(2 * slots, "id1", "id2")
    return present.mapInArrow(lambda batches: _diff_batches(_split_batches(batches)), f"id1 bigint, id2 bigint, diff1 {MARK_TYPE}, diff2 {MARK_TYPE}")


def _escape_html(word: Column) -> Column:
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        word = F.replace(word, F.lit(plain), F.lit(escaped))
    return word


def diff_markup(marks: Column | str, style: str = "html") -> Column:
    """Join the words by spaces, wrapping deleted and added ones."""
    if style not in MARKUP:
        raise ValueError(f"Unknown markup style {style!r}; use html or latex")
    wraps = MARKUP[style]

    def written(mark: Column) -> Column:
        word = _escape_html(mark["word"]) if style == "html" else mark["word"]
        result = F.when(mark["op"] == "keep", word)
        for op, (before, after) in wraps.items():
            result = result.when(mark["op"] == op, F.concat(F.lit(before), word, F.lit(after)))
        return result

    column = F.col(marks) if isinstance(marks, str) else marks
    return F.array_join(F.transform(column, written), " ")
