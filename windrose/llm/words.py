"""Words of Arrow text columns by classes of bytes, in chunks of bounded size and without a loop over words.

A rule gives each of the 256 bytes a kind (part of a word, between words, between pieces) and what it is
written as in words. Bytes above 0x7F are always parts of words, so words of UTF-8 texts are UTF-8.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CHUNK = 4 << 20
_LETTER, _BETWEEN, _BREAK = 0, 1, 2


@dataclass(frozen=True)
class ByteRule:
    """`between` separates words, `breaks` separates words and pieces; both are ASCII."""

    between: bytes
    breaks: bytes = b""
    lower: bool = True

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        kinds = np.zeros(256, np.uint8)
        kinds[list(self.between)] = _BETWEEN
        kinds[list(self.breaks)] = _BREAK
        written = np.arange(256, dtype=np.uint8)
        if self.lower:
            written[ord("A") : ord("Z") + 1] += 32
        return kinds, written


@dataclass(frozen=True)
class Words:
    """The words of a chunk: word i is `terms[ids[i]]`, of row `rows[i]` and piece `pieces[i]`.

    Piece numbers differ between rows and keep rising over the chunks of a column. `continued` says that
    the chunk starts within a row that an earlier chunk has begun.
    """

    terms: pa.Array
    ids: np.ndarray
    rows: np.ndarray
    pieces: np.ndarray
    continued: bool


def _cut(data: np.ndarray, kinds: np.ndarray, rows: np.ndarray, at: int) -> int:
    """The first place from `at` on where no word is cut: a separator or the start of a row."""
    row = int(rows[np.searchsorted(rows, at)])
    for start in range(at, row, 1 << 16):
        found = np.flatnonzero(kinds[data[start : min(row, start + (1 << 16))]])
        if len(found):
            return start + int(found[0])
    return row


def word_chunks(texts: pa.Array, rule: ByteRule, limit: int = _CHUNK) -> Iterator[Words]:
    """The words of a string column; a null is an empty text.

    A chunk has about `limit` bytes, whatever the lengths of texts; only a longer word exceeds it.
    """
    kinds, written = rule.tables()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, content = texts.buffers()
    if content is None or not len(texts):
        return
    rows = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(content, np.uint8)
    start, end, broken = int(rows[0]), int(rows[-1]), 0
    while start < end:
        stop = end if end - start <= limit else _cut(data, kinds, rows, start + limit)
        kind = kinds[data[start:stop]]
        place = np.int32 if stop - start < 1 << 31 else np.int64
        letter = kind == _LETTER
        first = letter.copy()
        first[1:] &= ~letter[:-1]
        starts = rows[np.searchsorted(rows, start) : np.searchsorted(rows, stop)] - start
        first[starts] |= letter[starts]
        at = np.flatnonzero(first)
        breaks = np.cumsum(kind == _BREAK, dtype=place) if rule.breaks else np.zeros(stop - start, np.int64)
        if len(at):
            offsets = np.empty(len(at) + 1, np.int64)
            offsets[:-1] = np.cumsum(letter, dtype=place)[at] - 1
            spelled = written[data[start:stop][letter]]
            offsets[-1] = len(spelled)
            words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(spelled))
            coded = words.dictionary_encode()
            row = np.searchsorted(rows, at + start, side="right") - 1
            yield Words(
                coded.dictionary,
                coded.indices.to_numpy().astype(np.int64),
                row,
                row + broken + breaks[at],
                not len(starts) or starts[0] > 0,
            )
        broken += int(breaks[-1])
        start = stop


def merged_keys(keys: np.ndarray, *amounts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, and the sum of each amount for them."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *[np.add.reduceat(a[order], first) if len(first) else a[:0] for a in amounts]
