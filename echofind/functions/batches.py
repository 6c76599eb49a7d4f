"""Words of an Arrow batch of texts, each distinct one handled once for the batch."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from echofind.functions.hashing import md5_words


@dataclass(frozen=True)
class BatchWords:
    """Text i has the distinct words ``code`` (places in ``words``) with ``count`` from ``edge[i]`` to ``edge[i + 1]``."""

    words: pa.StringArray
    edge: np.ndarray
    code: np.ndarray
    count: np.ndarray

    def names(self) -> np.ndarray:
        """``feature_hash`` with 64 bits and ``md5`` of each of ``words``, as bigints."""
        if not len(self.words):
            return np.zeros(0, np.int64)
        ends = np.frombuffer(self.words.buffers()[1], np.int32)[self.words.offset :][: len(self.words) + 1].astype(np.int64)
        return md5_words(self.words.buffers()[2].to_pybytes(), ends[:-1], np.diff(ends)).view(np.int64)

    def lists(self, values: np.ndarray) -> pa.ListArray:
        """The values of each text's distinct words, one list for each text."""
        return pa.ListArray.from_arrays(pa.array(self.edge, pa.int32()), pa.array(values, pa.int64()))


def batch_words(texts: pa.StringArray, least: int = 1) -> BatchWords:
    """What stands between plain spaces, of ``least`` characters or more; a null text has no words."""
    listed = pc.split_pattern(pc.fill_null(texts, ""), " ")
    encoded = listed.flatten().dictionary_encode()
    words = encoded.dictionary
    owner = np.repeat(np.arange(len(texts)), np.diff(listed.offsets.to_numpy()))
    width = max(1, len(words))
    key, count = np.unique(owner * width + encoded.indices.to_numpy(), return_counts=True)
    owner, code = np.divmod(key, width)
    long = pc.utf8_length(words).to_numpy(zero_copy_only=False) >= least
    kept = long[code] if len(words) else np.zeros(0, bool)
    place = np.cumsum(long) - 1
    owner, code, count = owner[kept], place[code[kept]], count[kept]
    return BatchWords(words.filter(pa.array(long)), np.searchsorted(owner, np.arange(len(texts) + 1)), code, count)
