"""Source divergence audit: how differently the sources of a language use its words.

A task gathers shards of texts, keeps a pointer to the start of each word and sorts the pointers by the
words they point at, inside each language and source: first by the first eight bytes, then, inside
runs that are equal and go on, by the next eight (a multikey sort whose characters are eight bytes).
Pointers stay in text order inside a run, so an equal run is a word with its occurrences and, by changes
of the text pointed into, its documents. Spark adds up the runs of all shards.

A language keeps the words in at least ``LEAST_DOCUMENTS`` of its documents. Each source's rate of each
kept word (in parts of ``SCALE``, ``SMOOTH`` added to each count) is compared with the language's, and
with each other source's. Sums over words are taken in slices of words: a task fills a matrix of sources
by words, ``WORDS`` at a time, and hands on a sum a pair of sources, so that words are never multiplied by
pairs of sources in a shuffle. More than ``SOURCES`` sources are met in blocks of so many.

Defined results: null text, language and source count as empty; a language or source of that name is one
like any other. Each row is a document of its own, whatever its id. A language without kept words has
pairs of value zero and no terms; a language with one source has no pairs. Ties of value are ranked by
the item's UTF-8 bytes. An empty table gives an empty result. Texts of any length are split whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.text import Words, as_texts, byte_table, ragged, split_words
from trolley.session import stored

#: Words are runs of ASCII letters and of all characters beyond ASCII.
LETTERS = byte_table(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]")
#: Bytes of text whose pointers are sorted together; a longer document is a shard of its own.
SHARD_BYTES = 8 << 20
LEAST_DOCUMENTS = 30
SCALE = 1_000_000_000
SMOOTH = 5
TERM_RANKS = 50
#: Slices the words of a language are dealt to.
SLICES = 64
WORDS = 512
SOURCES = 256

_KEEP = np.array([(1 << 64) - (1 << 8 * (8 - k)) for k in range(9)], np.uint64)


def _characters(words: Words, pointers: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes at ``depth`` of the words pointed at, in byte order, zeros after the word."""
    left = np.clip(words.size[pointers] - depth, 0, 8)
    at = np.minimum(words.start[pointers] + depth, len(words.folded))
    return words.wide[at].byteswap() & _KEEP[left]


def sorted_runs(words: Words, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pointers (places of words) by group and word, in text order inside a run of equal ones, and
    where each run begins."""
    order = np.arange(len(words.start))
    first = np.zeros(len(order), bool)
    first[:1] = True
    # Places in the order that are not decided yet, in segments of equal words so far.
    open_, segment, depth = order.copy(), group, 0
    while len(open_):
        pointers = order[open_]
        character = _characters(words, pointers, depth)
        moved = np.lexsort((character, segment))
        pointers, character, segment = pointers[moved], character[moved], segment[moved]
        order[open_] = pointers
        first[open_[1:]] |= (character[1:] != character[:-1]) | (segment[1:] != segment[:-1])
        # A run goes on if it is of several words that may differ later.
        run = np.cumsum(first[open_])
        many = np.bincount(run)[run] > 1
        depth += 8
        # A word that ends here is told from longer ones by its next character, which is zero.
        on = many & (words.size[pointers] >= depth)
        open_, segment = open_[on], run[on]
    return order, np.flatnonzero(first)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= SHARD_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    column = pc.fill_null(column.combine_chunks(), "")
    column = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)
    made = column.dictionary_encode()
    return made.indices.to_numpy().astype(np.int64), made.dictionary


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard in _shards(batches):
        words = split_words(as_texts(shard.column("text")), LETTERS)
        if not len(words.start):
            continue
        lang, langs = _codes(shard.column("lang"))
        source, sources = _codes(shard.column("source"))
        group = (lang * len(sources) + source)[words.owner]
        order, heads = sorted_runs(words, group)
        owner = words.owner[order]
        new = np.append(True, owner[1:] != owner[:-1])
        new[heads] = True
        mine = order[heads]
        sizes = words.size[mine]
        terms = words.folded[ragged(words.start[mine], sizes)]
        offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                langs.take(pa.array(group[mine] // len(sources))),
                sources.take(pa.array(group[mine] % len(sources))),
                pa.StringArray.from_buffers(len(mine), pa.py_buffer(offsets.tobytes()), pa.py_buffer(terms.tobytes())),
                pa.array(np.diff(np.append(heads, len(order)))),
                pa.array(np.add.reduceat(new.astype(np.int64), heads)),
            ],
            ["lang", "source", "term", "n", "n_docs"],
        )


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, n_docs``: occurrences and documents of each word (``lang, source, text``)."""
    runs = docs.select(*[F.col(c).cast("string") for c in ("lang", "source", "text")]).mapInArrow(
        _term_counts, "lang string, source string, term string, n long, n_docs long"
    )
    return runs.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _rate(count: str, total: str) -> F.Column:
    whole = f"(CAST({count} AS DECIMAL(20, 0)) + {SMOOTH}) * {SCALE}"
    return F.expr(f"IF(v > 0, 1 + {whole} DIV (CAST({total} AS DECIMAL(20, 0)) + {SMOOTH} * v), 0)")


class _Slice:
    """Sums of absolute differences between the sources of a block and all sources, over words that
    come in order."""

    def __init__(self, lang: str, number: int, block: int) -> None:
        self.tag = (lang, number, block)
        self._low = block * SOURCES
        self._absent: list[np.ndarray] = []
        self._matrix = self._last = None

    def absent(self, rates: np.ndarray) -> None:
        """The rates of words that sources do not have, in the order of the sources."""
        self._absent.append(rates)

    def _begin(self) -> None:
        self._rates = np.concatenate(self._absent)
        self._matrix = np.zeros((len(self._rates), 0), np.int64)
        self._sums = np.zeros((min(SOURCES, len(self._rates) - self._low), len(self._rates)), np.int64)

    def put(self, words: pa.Array, sources: np.ndarray, rates: np.ndarray) -> None:
        if self._matrix is None:
            self._begin()
        place, names = _codes(pa.chunked_array([words]))
        # The last word so far may go on.
        known = self._matrix.shape[1]
        place += known - (names[0].as_py() == self._last)
        new = np.repeat(self._rates[:, None], int(place[-1]) + 1 - known, axis=1)
        self._matrix = np.concatenate([self._matrix, new], axis=1)
        self._matrix[sources, place] = rates
        self._last = names[len(names) - 1].as_py()
        if self._matrix.shape[1] > WORDS:
            self._add(self._matrix[:, :-1])
            self._matrix = self._matrix[:, -1:].copy()

    def _add(self, words: np.ndarray) -> None:
        for row, total in enumerate(self._sums):
            total += np.abs(words - words[self._low + row]).sum(axis=1)

    def result(self) -> pa.RecordBatch:
        if self._matrix is None:
            self._begin()
        self._add(self._matrix)
        rows, sources = self._sums.shape
        a = np.repeat(self._low + np.arange(rows), sources)
        b = np.tile(np.arange(sources), rows)
        apart = a != b
        made = [pa.array([self.tag[0]] * int(apart.sum()), pa.string())]
        made += [pa.array(x[apart]) for x in (a, b, self._sums.ravel())]
        return pa.RecordBatch.from_arrays(made, ["lang", "a", "b", "value"])


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each slice, whose rows are consecutive: those without a word come first."""
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        code, langs = _codes(pa.chunked_array([batch.column("lang")]))
        tags = np.stack([code, batch.column("slice").to_numpy(), batch.column("block").to_numpy()])
        cuts = [0, *(np.flatnonzero((tags[:, 1:] != tags[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            lang, number, block = tags[:, begin].tolist()
            tag = (langs[lang].as_py(), number, block)
            if now is None or now.tag != tag:
                if now is not None:
                    yield now.result()
                now = _Slice(*tag)
            part = batch.slice(begin, end - begin)
            words, rates = part.column("term"), part.column("p").to_numpy()
            none = words.null_count
            if none:
                now.absent(rates[:none])
            if none < len(rates):
                now.put(words.slice(none), part.column("number").to_numpy()[none:], rates[none:])
    if now is not None:
        yield now.result()


def source_divergence(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank`` of ``docs`` (``lang, source, text``): in part ``pair`` a
    source's differences from each other source, in part ``term`` the words it uses more than its
    language does."""
    named = {c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")}
    docs = docs.select(*named.values(), "text")
    counts = stored(term_counts(docs), "terms")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("_docs"))
    kept = stored(kept.filter(F.col("_docs") >= LEAST_DOCUMENTS).drop("_docs"), "kept")
    mine = counts.join(kept, ["lang", "term"]).drop("n_docs")
    totals = mine.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    in_lang = Window.partitionBy("lang")
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.na.fill(0, ["total", "v", "lang_total"]).withColumns(
        {
            "number": F.row_number().over(in_lang.orderBy("source")) - 1,
            "blocks": F.ceil(F.count("*").over(in_lang) / SOURCES).cast("int"),
            "absent": _rate("0", "total"),
        }
    )
    groups = stored(groups, "groups")
    rated = mine.join(groups, ["lang", "source"]).withColumns({"p": _rate("n", "total"), "q": _rate("lang_n", "lang_total")})

    in_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = rated.filter("p > q").selectExpr("lang", "source", "'term' AS part", "term AS item", "p - q AS value")
    terms = terms.withColumn("rank", F.row_number().over(in_group)).filter(F.col("rank") <= TERM_RANKS)

    block = "explode(sequence(0, blocks - 1)) AS block"
    absent = groups.select("lang", "number", "absent", "blocks", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice"))
    absent = absent.selectExpr("lang", "slice", block, "CAST(NULL AS STRING) AS term", "number", "absent AS p")
    slice_of = f"CAST(pmod(xxhash64(term), {SLICES}) AS INT) AS slice"
    met = absent.union(rated.selectExpr("lang", slice_of, block, "term", "number", "p"))
    met = met.repartition("lang", "slice", "block").sortWithinPartitions("lang", "slice", "block", "term", "number")
    pairs = met.mapInArrow(_differences, "lang string, a long, b long, value long")
    pairs = pairs.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    for side, name in (("a", "source"), ("b", "item")):
        names = groups.select("lang", F.col("number").cast("long").alias(side), F.col("source").alias(name))
        pairs = pairs.join(names, ["lang", side])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(in_group)).unionByName(terms)
