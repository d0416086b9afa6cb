"""Whole batches of texts as byte arrays: words, spans and their names, without a loop per row.

A "name" is a 64-bit fingerprint. Operators that decide something by names alone pair two of them
(or compare the bytes), so that equal names mean equal strings at any realistic size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at once; a longer document is worked on alone.
SLICE_BYTES = 2 << 20

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)
_32 = np.uint64(32)
_29 = np.uint64(29)


def mix(left: np.ndarray, right: np.ndarray | np.uint64) -> np.ndarray:
    """Names of pairs."""
    h = left * _A
    h ^= h >> _32
    h += right
    h *= _B
    h ^= h >> _29
    h *= _C
    h ^= h >> _32
    return h


def byte_table(pattern: str, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to a word, and each byte with A-Z lower-cased.

    ``pattern`` matches one lower-cased Latin-1 character; bytes from 0x80 on are parts of longer
    characters.
    """
    fold = np.arange(256, dtype=np.uint8)
    if lower:
        fold[65:91] += 32
    return np.array([bool(re.fullmatch(pattern, chr(b))) for b in fold]), fold


#: Words are runs of anything but ASCII white space.
SPACED = byte_table(r"[^\x20\x09-\x0D]")
SPACED_AS_IS = byte_table(r"[^\x20\x09-\x0D]", lower=False)
#: Words are runs of ASCII letters and digits and of all characters beyond ASCII.
ALNUM = byte_table(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")


@dataclass
class Texts:
    """Texts end to end; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """The text each byte position lies in."""
        return np.searchsorted(self.offsets, positions, "right") - 1


def as_texts(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The column's texts; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks or [pa.array([], column.type)])
    kind = pa.large_binary()
    column = pc.fill_null(column.cast(kind), pa.scalar(b"", kind))
    if len(column) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of bounded text size; one longer row is a run of its own."""
    sizes = as_texts(batch.column(column)).sizes
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def eights(data: np.ndarray, extra: int = 0) -> np.ndarray:
    """The eight bytes from every position on as one number (zeros beyond the end)."""
    padded = np.zeros(len(data) + 8 + extra, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + extra + 1,), "<u8", padded.tobytes(), 0, (1,)).copy()


_KEEP = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], np.uint64)


def span_names(wide: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """Names of byte spans, from ``eights`` of the bytes."""
    names = mix(size.astype(np.uint64), np.uint64(seed))
    rest = np.arange(len(start))
    done = 0
    while len(rest):
        left = size[rest] - done
        part = wide[start[rest] + done] & _KEEP[np.minimum(left, 8)]
        names[rest] = mix(names[rest], part)
        done += 8
        rest = rest[left > 8]
    return names


@dataclass
class Words:
    """The words of a run of texts, in order."""

    folded: np.ndarray
    start: np.ndarray
    size: np.ndarray
    owner: np.ndarray
    counts: np.ndarray
    _wide: np.ndarray | None = None

    @property
    def first(self) -> np.ndarray:
        """Per text, how many words come before it; one entry more than texts."""
        return np.concatenate([[0], np.cumsum(self.counts)])

    @property
    def wide(self) -> np.ndarray:
        if self._wide is None:
            self._wide = eights(self.folded)
        return self._wide

    def names(self, seed: int = 0) -> np.ndarray:
        return span_names(self.wide, self.start, self.size, seed)

    def word(self, i: int) -> bytes:
        return self.folded[self.start[i] : self.start[i] + self.size[i]].tobytes()


def split_words(texts: Texts, table: tuple[np.ndarray, np.ndarray]) -> Words:
    inside_table, fold = table
    inside = inside_table[texts.data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = texts.sizes > 0
    heads, tails = texts.offsets[:-1][full], texts.offsets[1:][full] - 1
    begins[heads] = inside[heads]
    ends[tails] = inside[tails]
    start = np.flatnonzero(begins)
    owner = texts.owner(start)
    return Words(
        fold[texts.data],
        start,
        np.flatnonzero(ends) + 1 - start,
        owner,
        np.bincount(owner, minlength=len(texts)),
    )


def runs_of(names: np.ndarray, width: int) -> np.ndarray:
    """Names of every ``width`` consecutive names; ``len(names) - width + 1`` of them."""
    count = max(0, len(names) - width + 1)
    made = names[:count]
    for k in range(1, width):
        made = mix(made, names[k : k + count])
    return made if width > 1 else made.copy()


def sums_by(owner_counts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over consecutive groups of the given sizes."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(owner_counts)
    return total[ends] - total[ends - owner_counts]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` (``counts[i]`` of them) for every ``i``, end to end."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)
