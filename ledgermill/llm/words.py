"""Words as bytes, and their 64-bit hashes, shared by the operators that read whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Entries of a worker's cache of word hashes, and the longest word that it keeps.
CACHE_WORDS, CACHE_BYTES = 300_000, 64


class WordHashes(dict):
    """Word -> 64-bit hash; computed when missing, kept for common words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHE_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: bytes) -> list[bytes]:
    """Runs of bytes outside 0x20 and 0x09-0x0D, A-Z lower-cased: what bytes.split() splits at."""
    return text.lower().split()


def texts(batch: pa.RecordBatch, column: str) -> Iterator[bytes]:
    """The texts as UTF-8 bytes, one at a time, without a copy of the column; null is empty."""
    own = batch.column(column)
    for value in own.cast(pa.large_binary() if pa.types.is_large_string(own.type) else pa.binary()):
        yield value.as_py() or b""
