"""Benchmark decontamination: Wu-Manber search for all windows of all benchmark items at once.

The alphabet is words. For windows of ``m`` words, a table over the last words read says how far
the search may advance without passing the end of an occurrence; where it says zero, the bucket of
windows that end alike is tested, first by their beginning, then word by word. Windows shorter than
``WINDOW`` (items of few words) are searched per length.

The tables are flat arrays: the items' words end to end with their names, windows as places in them,
items as lists of numbers. The benchmark is searched for in blocks of at most ``BLOCK_BYTES`` of items;
each block's tables are sent to the executors and all documents are read against them. One block is
one pass without a shuffle. With more, each block's pass leaves what it found per distinct text (by two
hashes), and a last pass joins that to the documents; no text is stored.

Defined results: a null text has no words. Items without an id are no items; rows of one item are
one item. Repeated documents and rows without an id each give their own result row. An empty
benchmark contaminates nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import partial, reduce
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import carrying, per_slice
from trolley.llm.text import ALNUM, Words, as_texts, ragged, runs_of, split_words
from trolley.session import stored

WINDOW = 10
#: Words in a shift block.
BLOCK = 3
TABLE_BITS = 20
BLOCK_BYTES = 16 << 20


@dataclass
class Items:
    """The words of all items of a block, end to end, and the items' ids as strings."""

    folded: np.ndarray
    start: np.ndarray
    size: np.ndarray
    names: np.ndarray
    ids: list[str]

    def word(self, i: int) -> bytes:
        return self.folded[self.start[i] : self.start[i] + self.size[i]].tobytes()


@dataclass
class Patterns:
    """The tables of all windows of one length."""

    length: int
    #: Per slot of the last words' name, how many words the search may advance.
    shift: np.ndarray
    #: Windows by the name of their last words; ``head`` is the name of their first words, ``first`` the
    #: number of their first word. Windows of equal words are one.
    tail: np.ndarray
    head: np.ndarray
    first: np.ndarray
    #: The items of window ``w`` are ``owners[offsets[w] : offsets[w + 1]]``.
    owners: np.ndarray
    offsets: np.ndarray

    @property
    def block(self) -> int:
        return min(BLOCK, self.length)


def _slots(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def tables(items: list[tuple[str, str]], window: int = WINDOW) -> tuple[Items, list[Patterns]]:
    """The search tables of ``(item_id, text)``."""
    words = split_words(as_texts(pa.array([t for _, t in items], pa.large_string())), ALNUM)
    held = Items(words.folded, words.start, words.size, words.names(), [i for i, _ in items])
    second = words.names(1)
    counts, firsts = words.counts, words.first[:-1]
    made = []
    for length in np.unique(np.minimum(counts[counts > 0], window)).tolist():
        # Windows of this length are whole items, or all there are in longer ones.
        mine = np.flatnonzero(counts == length) if length < window else np.flatnonzero(counts >= window)
        number = counts[mine] - length + 1
        first, owner = ragged(firsts[mine], number), np.repeat(mine, number)
        # Two names of the whole window say which are equal.
        one, two = runs_of(held.names, length)[first], runs_of(second, length)[first]
        order = np.lexsort((owner, two, one))
        one, two, first, owner = one[order], two[order], first[order], owner[order]
        heads = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
        offsets = np.append(heads, len(first))
        block = min(BLOCK, length)
        pieces = runs_of(held.names, block)
        shift = np.full(1 << TABLE_BITS, length - block + 1, np.uint8)
        for end in range(block, length + 1):
            np.minimum.at(shift, _slots(pieces[first[heads] + end - block]), length - end)
        tail = pieces[first[heads] + length - block]
        by_tail = np.argsort(tail)
        sizes = np.diff(offsets)[by_tail]
        made.append(
            Patterns(
                length,
                shift,
                tail[by_tail],
                pieces[first[heads]][by_tail],
                first[heads][by_tail],
                owner[ragged(heads[by_tail], sizes)],
                np.append(0, np.cumsum(sizes)),
            )
        )
    return held, made


def occurrences(words: Words, names: np.ndarray, items: Items, patterns: Patterns) -> list[tuple[int, int]]:
    """``(first word, window)`` of every occurrence."""
    m, block = patterns.length, patterns.block
    blocks = runs_of(names, block)
    if len(names) < m or not len(patterns.tail):
        return []
    # advance[i]: for a window that would end with word i.
    advance = np.zeros(len(names), np.uint8)
    advance[block - 1 :] = patterns.shift[_slots(blocks)]
    steps, ends, i, n = advance.tobytes(), [], m - 1, len(names)
    while i < n:
        step = steps[i]
        if step:
            i += step
        else:
            ends.append(i)
            i += 1
    last = np.array(ends, np.int64)
    tails = blocks[last - block + 1]
    low = np.searchsorted(patterns.tail, tails, "left")
    count = np.searchsorted(patterns.tail, tails, "right") - low
    window = ragged(low, count)
    first = np.repeat(last, count) - m + 1
    likely = patterns.head[window] == blocks[first]
    likely &= words.owner[first] == words.owner[first + m - 1]
    first, window = first[likely], window[likely]
    for k in range(m):
        alike = names[first + k] == items.names[patterns.first[window] + k]
        first, window = first[alike], window[alike]
    return [
        (a, w)
        for a, w in zip(first.tolist(), window.tolist(), strict=True)
        if all(words.word(a + k) == items.word(patterns.first[w] + k) for k in range(m))
    ]


def _found(rows: pa.RecordBatch, shared) -> tuple[Words, list[list[int]], list[set[str]]]:
    """Each text's hit spans (first and last word) and items."""
    words = split_words(as_texts(rows.column("_text")), ALNUM)
    names = words.names()
    spans: list[list[int]] = [[] for _ in range(rows.num_rows)]
    items: list[set[str]] = [set() for _ in range(rows.num_rows)]
    head = words.first
    words_of, lengths = shared.value
    held = Items(*words_of)
    for one in lengths:
        patterns = Patterns(*one)
        for first, window in occurrences(words, names, held, patterns):
            row = int(words.owner[first])
            begin = first - int(head[row])
            spans[row] += [begin, begin + patterns.length]
            owners = patterns.owners[patterns.offsets[window] : patterns.offsets[window + 1]]
            items[row].update(held.ids[i] for i in owners.tolist())
    return words, spans, items


_RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>"


def _results(carried: pa.Array, name: str, counts: pa.Array, spans: list[list[int]], items: list[set[str]]) -> pa.RecordBatch:
    hits = []
    for span in spans:
        total, reached = 0, 0
        for begin, end in sorted(zip(span[::2], span[1::2], strict=True)):
            total += max(0, end - max(begin, reached))
            reached = max(reached, end)
        hits.append(total)
    digests = [hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in items]
    return pa.RecordBatch.from_arrays(
        [
            carried,
            counts,
            pa.array(hits, pa.int64()),
            pa.array([len(i) for i in items], pa.int64()),
            pa.array(digests, pa.string()),
            pa.array([h > 0 for h in hits], pa.bool_()),
            pa.array([sorted(i) for i in items], pa.list_(pa.string())),
        ],
        [name, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"],
    )


def _sent(docs: DataFrame, items: list[tuple[str, str]], window: int):
    held, found = tables(items, window)
    return docs.sparkSession.sparkContext.broadcast(
        (tuple(getattr(held, f.name) for f in fields(held)), [tuple(getattr(p, f.name) for f in fields(p)) for p in found])
    )


def _one_pass(docs: DataFrame, shared, carried: str) -> DataFrame:
    def make(rows: pa.RecordBatch) -> pa.RecordBatch:
        words, spans, items = _found(rows, shared)
        return _results(rows.column(carried), carried, pa.array(words.counts.astype(np.int64)), spans, items)

    return per_slice(docs, make, carrying(docs, [carried], _RESULT), "_text")


_HASHES = "_h1 long, _h2 long"


def _block_hits(docs: DataFrame, shared, number: int) -> DataFrame:
    """What a block's pass finds, a row per distinct text that holds any of its items."""

    def make(rows: pa.RecordBatch) -> pa.RecordBatch:
        _, spans, items = _found(rows, shared)
        hit = [k for k, span in enumerate(spans) if span]
        return pa.RecordBatch.from_arrays(
            [
                rows.column("_h1").take(pa.array(hit, pa.int64())),
                rows.column("_h2").take(pa.array(hit, pa.int64())),
                pa.array([spans[k] for k in hit], pa.list_(pa.int64())),
                pa.array([sorted(items[k]) for k in hit], pa.list_(pa.string())),
            ],
            ["_h1", "_h2", "_spans", "_items"],
        )

    found = per_slice(docs.select("_text", "_h1", "_h2"), make, f"{_HASHES}, _spans array<long>, _items array<string>", "_text")
    found = found.groupBy("_h1", "_h2").agg(F.first("_spans").alias("_spans"), F.first("_items").alias("_items"))
    return found.withColumn("_block", F.lit(number))


def _several_passes(docs: DataFrame, blocks: list, carried: str) -> DataFrame:
    """``blocks`` make their tables when called, so the driver holds one at a time."""
    docs = docs.withColumns({"_h1": F.xxhash64("_text"), "_h2": F.xxhash64(F.lit(7), "_text")})
    hits = reduce(
        DataFrame.unionByName, [stored(_block_hits(docs, make(), k), "hits") for k, make in enumerate(blocks)]
    )
    # A text has a row per block at most.
    both = [F.flatten(F.collect_list(c)).alias(c) for c in ("_spans", "_items")]
    hits = stored(hits.groupBy(F.col("_h1").alias("_g1"), F.col("_h2").alias("_g2")).agg(*both), "hits")

    def count(rows: pa.RecordBatch) -> pa.RecordBatch:
        counts = split_words(as_texts(rows.column("_text")), ALNUM).counts.astype(np.int64)
        names = [carried, "_h1", "_h2"]
        return pa.RecordBatch.from_arrays([*[rows.column(c) for c in names], pa.array(counts)], [*names, "_n"])

    counted = per_slice(docs, count, carrying(docs, [carried, "_h1", "_h2"], "_n long"), "_text")
    met = counted.join(hits, F.expr("_h1 = _g1 AND _h2 = _g2"), "left").select(carried, "_n", "_spans", "_items")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            spans = [s or [] for s in rows.column("_spans").to_pylist()]
            items = [set(i or []) for i in rows.column("_items").to_pylist()]
            yield _results(rows.column(carried), carried, rows.column("_n"), spans, items)

    return met.mapInArrow(finish, carrying(docs, [carried], _RESULT))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items`` of each row of
    ``docs`` (``doc_id, text``) against the windows of ``benchmark`` (``item_id, text``)."""
    return _searched(docs, "doc_id", benchmark, window, block_bytes)


def contaminated_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The same columns beside ``_row``, a column of any type that ``docs`` has."""
    return _searched(docs, "_row", benchmark, WINDOW, BLOCK_BYTES)


def _searched(
    docs: DataFrame, carried: str, benchmark: DataFrame, window: int, block_bytes: int
) -> DataFrame:
    items = benchmark.filter("item_id IS NOT NULL").select(
        F.col("item_id").cast("string").alias("item"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    rows = docs.select(carried, F.col("text").alias("_text"))

    def make(k: int):
        return _sent(docs, [tuple(r) for r in items.filter(block == k).distinct().collect()], window)

    if blocks == 1:
        return _one_pass(rows, make(0), carried)
    return _several_passes(rows, [partial(make, k) for k in range(blocks)], carried)
