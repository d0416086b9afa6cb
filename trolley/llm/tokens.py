"""Token ids of whole texts under a public byte-level BPE vocabulary, a batch at a time.

Texts are cut where the tokenizer's pattern always begins a new piece, so each chunk has the same
ids wherever it stands. Equal chunks are encoded once per worker. A chunk is cut before a blank
between two non-blank characters, and around any other single white-space character there.
"""

from __future__ import annotations

from dataclasses import dataclass
import base64
from itertools import chain
import os

import numpy as np

from trolley.llm.text import Texts, eights, ragged, span_names

#: Distinct chunks a worker remembers before it starts afresh.
REMEMBERED = 1_500_000

def _class_table() -> np.ndarray:
    """0 other, 1 blank, 2 other ASCII white space."""
    kinds = np.zeros(256, np.uint8)
    kinds[[9, 10, 11, 12, 13]] = 2
    kinds[32] = 1
    return kinds


_KIND = _class_table()
_CONTROL = np.array([b < 9 or 13 < b < 32 or b == 127 for b in range(256)])
_LEADS = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3, 0xEF])


@dataclass
class Vocabulary:
    """A vocabulary in both files' forms. The JSON file defines the ids; chunks of plain Latin text
    go through the equal rank file, which is several times faster on short strings."""

    json_path: str
    rank_path: str | None = None

    def __post_init__(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._slow = Tokenizer.from_file(self.json_path)
        self._slow.encode_special_tokens = True
        self._fast = None
        self._bytes_of = self.byte_sizes()
        if self.rank_path:
            import public_tokenizers
            import tiktoken

            with open(self.rank_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
        self.forget()

    def forget(self) -> None:
        self._names = np.zeros(0, np.uint64)
        self._starts = np.zeros(0, np.int64)
        self._counts = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, special tokens' strings as ordinary text."""
        return [e.ids for e in self._slow.encode_batch(texts, add_special_tokens=False)]

    def _encode_chunks(
        self, data: np.ndarray, start: np.ndarray, size: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks end to end, and how many each has."""
        rare = np.concatenate([[0], np.cumsum(data >= 0xCA)])
        kind = _KIND[data]
        joins = (kind[start] == 1) & (size > 1) & (rare[start + size] == rare[start])
        joins &= (kind[np.minimum(start + 1, len(data) - 1)] == 0) & (kind[start + size - 1] == 0)
        if self._fast is None:
            joins[:] = False
        counts = np.zeros(len(start), np.int64)
        # Chunks that begin with one blank can be encoded in one go: none leans on another.
        together = np.flatnonzero(joins)
        sizes = size[together]
        text = data[ragged(start[together], sizes)].tobytes().decode()
        joined = np.array(self._fast.encode_ordinary(text) if text else [], np.uint32)
        ends = np.searchsorted(np.cumsum(self._bytes_of[joined]), np.cumsum(sizes)) + 1
        counts[together] = np.diff(ends, prepend=0)
        alone = np.flatnonzero(~joins)
        raw = data.tobytes()
        spans = zip(start[alone].tolist(), (start + size)[alone].tolist(), strict=True)
        ids = self.encode([raw[a:b].decode() for a, b in spans])
        counts[alone] = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.zeros(int(counts.sum()), np.uint32)
        begin = np.cumsum(counts) - counts
        flat[ragged(begin[together], counts[together])] = joined
        flat[ragged(begin[alone], counts[alone])] = np.fromiter(chain.from_iterable(ids), np.uint32)
        return flat, counts

    def _learn(self, data: np.ndarray, names: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Encode the chunks (of distinct, ascending names) that are not remembered yet."""
        if len(self._names):
            at = np.minimum(np.searchsorted(self._names, names), len(self._names) - 1)
            new = self._names[at] != names
            names, start, size = names[new], start[new], size[new]
        if not len(names):
            return
        flat, counts = self._encode_chunks(data, start, size)
        starts = len(self._ids) + np.cumsum(counts) - counts
        self._ids = np.concatenate([self._ids, flat])
        at = np.searchsorted(self._names, names)
        self._names = np.insert(self._names, at, names)
        self._starts = np.insert(self._starts, at, starts)
        self._counts = np.insert(self._counts, at, counts)

    def ids(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids end to end, and how many each text has."""
        odd = np.zeros(len(texts), bool)
        raw = texts.data.tobytes()
        odd[texts.owner(_odd_places(texts.data))] = True
        start, size, owner = _chunks(texts)
        plain = ~odd[owner]
        start, size, owner = start[plain], size[plain], owner[plain]
        names = span_names(eights(texts.data), start, size)
        distinct, first, where = np.unique(names, return_index=True, return_inverse=True)
        if len(self._names) > REMEMBERED:
            self.forget()
        self._learn(texts.data, distinct, start[first], size[first])
        if len(distinct):
            at = np.searchsorted(self._names, distinct)[where]
            starts, counts = self._starts[at], self._counts[at]
        else:
            starts = counts = np.zeros(0, np.int64)
        flat = self._ids[ragged(starts, counts)]
        per_text = np.bincount(owner, counts, len(texts)).astype(np.int64)
        if not odd.any():
            return flat, per_text
        rows = np.flatnonzero(odd)
        whole = self.encode(
            [raw[texts.offsets[i] : texts.offsets[i + 1]].decode() for i in rows.tolist()]
        )
        pieces, done = [], 0
        ends = np.cumsum(per_text)
        for i, ids in zip(rows.tolist(), whole, strict=True):
            pieces += [flat[done : ends[i]], np.array(ids, np.uint32)]
            done = ends[i]
            per_text[i] = len(ids)
        return np.concatenate([*pieces, flat[done:]]), per_text

    def byte_sizes(self) -> np.ndarray:
        """How many bytes of text each id stands for."""
        from tokenizers.pre_tokenizers import ByteLevel

        letters = set(ByteLevel.alphabet())
        sizes = np.zeros(self._slow.get_vocab_size(), np.int64)
        for token, i in self._slow.get_vocab().items():
            sizes[i] = len(token) if set(token) <= letters else len(token.encode())
        return sizes


def _odd_places(data: np.ndarray) -> np.ndarray:
    """Where white space beyond ASCII is, or a control that libraries class differently."""
    found = [np.flatnonzero(_CONTROL[data])]
    lead = np.flatnonzero(_LEADS[data])
    first = data[lead]
    second = data[np.minimum(lead + 1, len(data) - 1)] if len(data) else first
    third = data[np.minimum(lead + 2, len(data) - 1)] if len(data) else first
    odd = (first == 0xC2) & (second <= 0xA0)
    odd |= (first == 0xE1) & ((second == 0x9A) | (second == 0xA0))
    odd |= (first == 0xE2) & (second == 0x80) & ((third <= 0x8F) | (third >= 0xA8) & (third <= 0xAF))
    odd |= (first == 0xE2) & (second == 0x81) & (third >= 0x9F) & (third <= 0xAF)
    odd |= (first == 0xE3) & (second == 0x80) & (third == 0x80)
    odd |= (first == 0xEF) & (second == 0xBB)
    return np.concatenate([*found, lead[odd]])


def _chunks(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, sizes and owners of chunks that are encoded alike wherever they stand."""
    n = len(texts.data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    kind = _KIND[texts.data]
    cut = np.zeros(n + 1, bool)
    if n > 2:
        # A text's first and last characters have a neighbour of another text at most: cutting
        # there as well does no harm, since texts are cut at their ends anyway.
        single = (kind[1:-1] > 0) & (kind[:-2] == 0) & (kind[2:] == 0)
        cut[1 : n - 1] = single
        cut[2:n] |= single & (kind[1:-1] == 2)
    # A blank or line break at a text's end may not lean on the next text.
    edges = texts.offsets[1:-1]
    ends = texts.offsets[1:][texts.sizes > 0] - 1
    ends = ends[kind[ends] > 0]
    cut[ends] = False
    heads = texts.offsets[:-1][texts.sizes > 0]
    odd_heads = heads[kind[heads] > 0] + 1
    cut[odd_heads[odd_heads < n]] = False
    cut[edges] = True
    cut[0], cut[n] = True, False
    start = np.flatnonzero(cut[:n])
    size = np.diff(np.append(start, n))
    return start, size, texts.owner(start)


_LOADED: dict[tuple[str, str | None], Vocabulary] = {}


def vocabulary(json_path: str, rank_path: str | None) -> Vocabulary:
    """The worker's copy of a vocabulary."""
    key = (json_path, rank_path)
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(*key)
    return _LOADED[key]


