"""Words of whole texts as numpy arrays over the UTF-8 bytes of a block of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from staffwise.llm.shared import row_blocks, string_array, text_buffer

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """The words of some texts, in order: ``row`` of each word, byte ``start`` and ``end`` in its text, and its
    ``code`` in ``dictionary`` (the distinct words, lower-cased). Equal codes mean equal words."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        inside = is_word[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        before = np.concatenate(([False], inside[:-1])) if len(raw) else inside
        after = np.concatenate((inside[1:], [False])) if len(raw) else inside
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.row = np.searchsorted(offsets, self.starts, "right") - 1
        self.first_byte = offsets[self.row]  # where the word's text starts in ``raw``
        spelled = string_array(LOWER[raw[inside]], np.concatenate(([0], np.cumsum(self.ends - self.starts))))
        encoded = spelled.dictionary_encode()
        self.code = np.asarray(encoded.indices).astype(np.int64)
        self.dictionary: pa.Array = encoded.dictionary


def byte_class(inside: bytes, from_byte: int = 128) -> np.ndarray:
    """Truth per byte value: the given bytes, and all from ``from_byte`` on."""
    table = np.zeros(256, bool)
    table[list(inside)] = True
    table[from_byte:] = True
    return table


def text_blocks(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of the blocks of a batch's text column."""
    raw, offsets = text_buffer(batch.column(column))
    for start, end in row_blocks(offsets, limit):
        yield start, end, raw[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
