"""Token counts by byte-pair merging, without building any token.

The text becomes a linked list of symbols; a heap holds the adjacent pairs whose
concatenation is a piece of the vocabulary. The pair of lowest rank (leftmost
first on ties) is popped and merged until none is left. The count is the number
of initial symbols minus the merges; a symbol outside the vocabulary counts its
UTF-8 bytes. No identifier is looked up or emitted.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Bytes that a worker's remembered fragments take before it starts anew, and the longest that it remembers.
MEMO_BYTES, MEMO_CHARS = 128 << 20, 64


def merge_count(text: str, ranks: dict[str, int]) -> tuple[int, list[str]]:
    """Merges made in ``text`` and the symbols that remain.

    A heap entry is ``rank << 32 | position``. It is stale, and skipped, unless the
    pair that stands at its position now has that very rank.
    """
    symbols = list(text)
    n = len(symbols)
    rank_of = ranks.get
    heap = []
    for i in range(n - 1):
        rank = rank_of(text[i : i + 2])
        if rank is not None:
            heap.append(rank << 32 | i)
    if not heap:
        return 0, symbols
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    merges = 0
    while heap:
        entry = heappop(heap)
        left = entry & 0xFFFFFFFF
        right = after[left]
        if right >= n or not symbols[left]:
            continue
        merged = symbols[left] + symbols[right]
        if rank_of(merged) != entry >> 32:
            continue
        symbols[left], symbols[right] = merged, ""
        after[left] = end = after[right]
        merges += 1
        if end < n:
            before[end] = left
            rank = rank_of(merged + symbols[end])
            if rank is not None:
                heappush(heap, rank << 32 | left)
        prior = before[left]
        if prior >= 0:
            rank = rank_of(symbols[prior] + merged)
            if rank is not None:
                heappush(heap, rank << 32 | prior)
    return merges, [s for s in symbols if s]


class Fragments(dict):
    """Fragment -> token count, filled on demand, emptied when it has grown to ``MEMO_BYTES``.

    Two neighbouring characters that stand beside each other in no piece can never be
    merged across. A fragment is cut at all such places in one pass, so one entry serves
    several fragments and long unbroken texts fall into short ones. What stays longer than ``MEMO_CHARS`` is
    counted each time.
    """

    def __init__(self, ranks: dict[str, int]) -> None:
        super().__init__()
        self.ranks = ranks
        self.inner = {p[i : i + 2] for p in ranks for i in range(len(p) - 1)}
        self.held = 0

    def part(self, text: str) -> int:
        """The tokens of a fragment that cannot be cut."""
        if len(text) == 1:
            return 1 if text in self.ranks else len(text.encode())
        merges, left = merge_count(text, self.ranks)
        count = len(text) - merges
        for s in left:
            if len(s) == 1 and s not in self.ranks:
                count += len(s.encode()) - 1
        return count

    def keep(self, text: str, count: int) -> int:
        if len(text) <= MEMO_CHARS:
            self.held += 150 + 4 * len(text)
            if self.held > MEMO_BYTES:
                self.clear()
                self.held = 0
            self[text] = count
        return count

    def __missing__(self, text: str) -> int:
        inner = self.inner
        ends = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in inner]
        if not ends:
            return self.keep(text, self.part(text))
        total = start = 0
        for end in (*ends, len(text)):
            fragment = text[start:end]
            found = self.get(fragment)
            total += self.keep(fragment, self.part(fragment)) if found is None else found
            start = end
        return self.keep(text, total)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if text[0] == " " or "  " in text or SPACE in text:
            pieces = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", SPACE + text.replace(" ", SPACE))
        else:
            pieces = (SPACE + text.replace(" ", " " + SPACE)).split(" ")
        return sum(map(self.__getitem__, pieces))


_loaded: dict[str, Fragments] = {}


def fragments(model: str) -> Fragments:
    """The counter of a sentencepiece BPE model with byte fallback, loaded once by each worker."""
    if model not in _loaded:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        normal = [i for i in range(sp.vocab_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        order = {score: k for k, score in enumerate(sorted({sp.get_score(i) for i in normal}, reverse=True))}
        ranks = {sp.id_to_piece(i): order[sp.get_score(i)] for i in normal}
        if any(SPACE in p.lstrip(SPACE) for p in ranks):
            raise ValueError("pieces that go on after a space are not supported")
        _loaded[model] = Fragments(ranks)
    return _loaded[model]


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_count(text: Column, model: str = "piece_bpe_32k.model") -> Column:
    """Tokens of each text. ``model`` is a vocabulary name that every worker resolves itself, or a path."""

    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        counter = fragments(model if "/" in model else model_path(model))
        return pd.Series([counter.count(t) for t in texts], dtype="int64")

    return counted(text)


def count_tokens(docs: DataFrame, limit: int = 4096, model: str = "piece_bpe_32k.model", text: str = "text") -> DataFrame:
    """Every column of ``docs`` but the text, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    A null text counts as empty: 0 bytes, 0 tokens. Texts of any length are counted
    whole. Equal rows give equal rows; an empty table gives an empty one. Columns
    named like the new ones are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    new = {"n_bytes": F.octet_length(body).cast("long"), "n_tokens": token_count(body, model)}
    return docs.withColumns(new).withColumn("over_limit", F.col("n_tokens") > limit).drop(text)
