"""Quality rules on whole texts, and the perplexity of a modified Kneser-Ney model of the corpus.

The model is of ``ORDER`` symbols per language, where a symbol is a class of UTF-8 bytes (64 of
them, so a context of any length is one number). Spark counts the longest n-grams of all texts and
derives from the counts, with joins and aggregations, the continuation counts, discounts, back-off
weights and probabilities of all orders. All of them stay tables, by language and n-gram, which grow
with the corpus. Executors hold the ``HELD_MODEL`` most frequent of the longest n-grams (8 bytes each),
and what a text has beyond those is looked up by joins with the tables, so each n-gram counts with
its own probability whatever the size of the model.

Per language, the quartiles of the distinct texts' log-perplexities give a band, which has a least
width; texts outside are rejected. The model counts distinct texts, too, so that a text is neither
likelier nor rarer, and no band narrower, for the copies it has.

Defined results: a null text is empty; an empty text (or one without a word) has zero counts, no
perplexity and fails the base rules. A null language is a language of its own. Repeated rows and
null ids each give their own result row. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import carrying, release
from trolley.llm.text import (
    SPACED_AS_IS,
    Texts,
    as_texts,
    mix,
    ragged,
    runs_of,
    slices,
    span_names,
    split_words,
    sums_by,
)
from trolley.session import stored

ORDER = 5
BITS = 6
#: N-grams of the model that every worker holds; the others are joined.
HELD_MODEL = 1 << 22
#: Distinct n-grams a task holds before it hands them on.
HELD_GRAMS = 2_000_000
#: The band: this many interquartile ranges of log-perplexity beyond the quartiles.
REACH = 3.0
#: The interquartile range a band is made of is at least this (nats a byte): what the given languages
#: have is 0.042 to 0.066, and what rounding does to a score is below 1e-11.
LEAST_SPREAD = 0.04
#: Bits that tell which hashes of texts may be those of repeated ones.
REPEAT_BITS = 24
#: Up to this many languages the bands are broadcast; more are joined by a shuffle.
FEW_LANGUAGES = 10_000

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_LN_P = "CAST(ln(p) AS FLOAT) AS value"
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def _symbol_classes() -> np.ndarray:
    """Each byte's class, 1 to 63; 0 marks what is before a text."""
    kinds = np.full(256, 1, np.uint8)
    groups = [b" \t\r\x0b\x0c", b"\n", b"0123456789", b".", b",", b"!", b"?", b"'\"-()[]{}:;/"]
    groups += [bytes([b]) for b in b"#*$%&|<>"]
    for k, group in enumerate(groups, 2):
        kinds[list(group)] = k
    after = 2 + len(groups)
    for k in range(26):
        kinds[97 + k] = kinds[65 + k] = after + k
    after += 26
    for byte in range(0x80, 0xC0):
        kinds[byte] = after + byte % 16 // 2
    after += 8
    for byte in range(0xC0, 0x100):
        kinds[byte] = after + (byte == 0xC3) + 2 * (byte >= 0xD0) + (byte >= 0xE3)
    return kinds


_KIND = _symbol_classes()


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """The rule columns of each text."""
    words = split_words(texts, SPACED_AS_IS)
    letters = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(np.isin(texts.data, _SYMBOLS))])
    marks = texts.offsets
    # Lines: between newlines and text ends.
    breaks = np.flatnonzero(texts.data == 10)
    start = np.sort(np.concatenate([texts.offsets[:-1], breaks + 1]), kind="stable")
    owner = np.repeat(
        np.arange(len(texts)), np.bincount(texts.owner(breaks), minlength=len(texts)) + 1
    )
    order = np.lexsort((start, owner)) if len(start) else start
    start, owner = start[order], owner[order]
    last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
    stop = np.empty_like(start)
    stop[:-1] = start[1:] - 1
    stop[last] = texts.offsets[1:]
    has_word = np.searchsorted(words.start, stop) > np.searchsorted(words.start, start)
    start, stop, owner = start[has_word], stop[has_word], owner[has_word]
    wide = words.wide
    names = mix(span_names(wide, start, stop - start), owner.astype(np.uint64))
    _, first = np.unique(names, return_index=True)
    repeated = np.ones(len(names), bool)
    repeated[first] = False
    # Words inside windows of three words that occur twice or more in their text.
    three = runs_of(words.names(), 3)
    at = words.owner[: len(three)]
    whole = at == words.owner[2:][: len(three)]
    keyed = mix(three, at.astype(np.uint64))[whole]
    place = np.flatnonzero(whole)
    covered = np.zeros(len(words.start) + 1, np.int64)
    if len(keyed):
        order = np.argsort(keyed)
        ranked = keyed[order]
        same = np.append(False, ranked[1:] == ranked[:-1])
        twice = same | np.append(same[1:], False)
        hits = place[order[twice]]
        np.add.at(covered, hits, 1)
        np.add.at(covered, hits + 3, -1)
    inside = np.cumsum(covered)[:-1] > 0
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": sums_by(words.counts, letters[words.start + words.size] - letters[words.start]),
        "n_symbols": symbols[marks[1:]] - symbols[marks[:-1]],
        "n_dup_lines": np.bincount(owner[repeated], minlength=len(texts)).astype(np.int64),
        "n_repeat_words": sums_by(words.counts, inside.astype(np.int64)),
    }


def grams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of each text, and the texts' sizes."""
    pad = ORDER - 1
    kinds = np.zeros(len(texts.data) + pad * len(texts), np.uint32)
    target = texts.offsets[:-1] + pad * np.arange(1, len(texts) + 1)
    kinds[ragged(target, texts.sizes)] = _KIND[texts.data]
    made = kinds[: len(kinds) - pad].copy() if len(kinds) >= pad else kinds[:0]
    for k in range(1, ORDER):
        made <<= np.uint32(BITS)
        made |= kinds[k : k + len(made)]
    return made[kinds[pad:] != 0], texts.sizes


def _by_language(part: pa.RecordBatch) -> Iterator[tuple[str | None, pa.RecordBatch]]:
    tags = part.column("lang")
    for tag in pc.unique(tags).to_pylist():
        chosen = pc.is_null(tags) if tag is None else pc.fill_null(pc.equal(tags, tag), False)
        yield tag, part.filter(chosen)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str | None, tuple[np.ndarray, np.ndarray]] = {}

    def hand_on() -> Iterator[pa.RecordBatch]:
        for tag, (keys, counts) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([tag] * len(keys), pa.string()), keys.astype(np.int64), counts],
                ["lang", "gram", "n"],
            )
        held.clear()

    for batch in batches:
        for part in slices(batch, "text"):
            for tag, rows in _by_language(part):
                keys, counts = np.unique(grams(as_texts(rows.column("text")))[0], return_counts=True)
                if tag in held:
                    keys, at = np.unique(np.concatenate([held[tag][0], keys]), return_inverse=True)
                    counts = np.bincount(at, np.concatenate([held[tag][1], counts]), len(keys))
                held[tag] = keys, counts.astype(np.int64)
            if sum(len(keys) for keys, _ in held.values()) > HELD_GRAMS:
                yield from hand_on()
    yield from hand_on()
    release()


def _text_names(text: str = "text") -> list[F.Column]:
    """Two independent hashes of 64 bits, which stand for a text."""
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(7), text).alias("_h2")]


def in_names(rows: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (with ``_h1``) whose text may be one of ``names`` (``_h1``), and those whose is not.

    A bit per value of ``REPEAT_BITS`` bits of the hash says so: a table of at most
    ``2 ** (REPEAT_BITS - 5)`` rows, which every task gets. No text is moved and none goes to Python.
    """
    slot = f"(_h1 & {(1 << REPEAT_BITS) - 1})"
    bits = stored(
        names.groupBy(F.expr(f"{slot} >> 5").alias("_word")).agg(
            F.expr(f"bit_or(1L << CAST({slot} & 31 AS INT))").alias("_bits")
        ),
        "bits",
    )
    tested = rows.join(F.broadcast(bits), F.expr(f"{slot} >> 5 = _word"), "left")
    tested = tested.withColumn("_may", F.expr(f"coalesce((_bits >> CAST({slot} & 31 AS INT)) & 1 = 1, false)"))
    tested = tested.drop("_word", "_bits")
    return tested.filter("_may").drop("_may"), tested.filter("NOT _may").drop("_may")


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``text, lang`` of each distinct text of each language.

    Only texts whose hash may be that of a repeated one are shuffled, one of a kind from each task.
    """
    named = docs.select("text", "lang", *_text_names())
    repeated = named.groupBy("lang", "_h1", "_h2").agg(F.count("*").alias("n")).filter("n > 1")
    several, single = in_names(named, repeated)
    several = several.groupBy("lang", "_h1", "_h2").agg(F.first("text").alias("text"))
    return single.select("text", "lang").union(several.select("text", "lang"))


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` of the longest n-grams of all distinct texts."""
    counted = distinct_texts(docs).mapInArrow(_count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _smoothed(grams: DataFrame, order: int, lower: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """``lang, gram, n, p`` and ``lang, context, weight`` of one order of the model."""
    seen = [F.sum((F.col("n") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    rates = grams.groupBy("lang").agg(*seen).withColumn("y", F.expr("n1 / nullif(n1 + 2 * n2, 0)"))
    rates = rates.selectExpr(
        "lang AS _of",
        # Without enough n-grams to estimate a discount, half an occurrence.
        *[
            f"least(greatest(coalesce({k} - {k + 1} * y * n{k + 1} / nullif(n{k}, 0), 0.5), 0.1), {k})"
            f" AS d{k}"
            for k in (1, 2, 3)
        ],
    )
    cut = "CASE WHEN n = 1 THEN d1 WHEN n = 2 THEN d2 ELSE d3 END"
    cut_down = grams.join(rates, F.expr("lang <=> _of")).selectExpr(
        "lang", "gram", "n", f"gram >> {BITS} AS context", f"{cut} AS cut"
    )
    # Kept, like all that is read more than once: plans stay small and so does the driver.
    cut_down = stored(cut_down, "discounts")
    contexts = cut_down.groupBy("lang", "context").agg(
        F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("weight")
    )
    contexts = stored(contexts, "contexts")
    both = cut_down.alias("g").join(
        contexts.alias("c"), F.expr("g.lang <=> c.lang AND g.context = c.context")
    )
    both = both.selectExpr("g.lang", "gram", "n", "weight", "greatest(n - cut, 0) / total AS own")
    if lower is None:
        return both.selectExpr("lang", "gram", "n", f"own + weight / {2**BITS} AS p"), contexts
    suffix = f"gram & {(1 << (BITS * (order - 1))) - 1}"
    joined = both.alias("g").join(
        lower.alias("l"), F.expr(f"g.lang <=> l.lang AND (g.{suffix}) = l.gram")
    )
    return joined.selectExpr("g.lang", "g.gram", "g.n", "own + weight * l.p AS p"), contexts


@dataclass
class Held:
    """Some n-grams with their log-probabilities: in ascending order from ``places[tag][0]`` to
    ``places[tag][1]``, for each language."""

    keys: np.ndarray
    values: np.ndarray
    places: dict[str | None, tuple[int, int]]

    def log_probabilities(self, keys: np.ndarray, tag: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Of each n-gram (0 of one that is not held), and which ones are held."""
        first, end = self.places.get(tag, (0, 0))
        values, found = _look_up((self.keys[first:end], self.values[first:end]), keys)
        return np.where(found, values, 0).astype(np.float64), found


@dataclass
class Model:
    """Per order, ``lang, gram, value`` of all n-grams (log-probabilities) and of all contexts
    (log-weights); the most frequent of the longest n-grams are ``held``, too."""

    grams: list[DataFrame]
    contexts: list[DataFrame]
    held: Held

    def look_up(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (``lang, gram`` and other columns) with the log-probability ``value`` of each
        n-gram, from the longest end of it that the model knows."""
        columns, done = wanted.columns, []
        left = wanted.withColumn("_weights", F.lit(0.0))
        for order in range(ORDER, 0, -1):
            left = stored(_joined(left, self.grams[order - 1], (1 << (BITS * order)) - 1, 0), "tried")
            done.append(left.filter("_found IS NOT NULL").selectExpr(*columns, "_weights + _found AS value"))
            left = left.filter("_found IS NULL").drop("_found")
            # The texts counted have no n-gram that is not found at once.
            if left.isEmpty():
                break
            if order > 1:
                left = _joined(left, self.contexts[order - 1], (1 << (BITS * order)) - 1, BITS)
                left = left.withColumn("_weights", F.expr("_weights + coalesce(_found, 0)")).drop("_found")
        else:
            done.append(left.selectExpr(*columns, f"_weights - {BITS * np.log(2)}D AS value"))
        return reduce(DataFrame.union, done)

    def log_probabilities(self, keys: np.ndarray, tag: str | None) -> np.ndarray:
        """Of a few n-grams of a language, whether its texts have them or not."""
        rows = [(i, tag, key) for i, key in enumerate(keys.tolist())]
        wanted = self.grams[0].sparkSession.createDataFrame(rows, "i long, lang string, gram long")
        found = self.look_up(wanted).toArrow()
        result = np.zeros(len(keys))
        result[found["i"].to_numpy()] = found["value"].to_numpy()
        return result


def _joined(rows: DataFrame, values: DataFrame, mask: int, shift: int) -> DataFrame:
    """``rows`` with ``_found``, the value of the part of their n-gram that ``mask`` and ``shift`` leave."""
    values = values.selectExpr("lang AS _of", "gram AS _key", "value AS _found")
    known = F.expr(f"lang <=> _of AND ((gram & {mask}L) >> {shift}) = _key")
    return rows.join(values, known, "left").drop("_of", "_key")


def _look_up(arrays: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, values = arrays
    if not len(hashes):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
    return values[at], hashes[at] == wanted


def _hold(top: DataFrame) -> Held:
    """The most frequent n-grams of ``top`` (``lang, gram, n, p``), as many as may be held."""
    rank = "CAST(8 * log2(n) AS INT)"
    sizes = top.groupBy(F.expr(rank).alias("rank")).count().collect()
    least, total = None, 0
    for row in sorted(sizes, reverse=True):
        total += row["count"]
        if total > HELD_MODEL:
            break
        least = row["rank"]
    chosen = top.filter("false" if least is None else f"{rank} >= {least}")
    rows = chosen.selectExpr("lang", "CAST(gram AS INT) AS gram", _LN_P).toArrow()
    tags = rows["lang"].combine_chunks().dictionary_encode(null_encoding="encode")
    if isinstance(tags, pa.ChunkedArray):
        tags = tags.combine_chunks()
    tag, gram = tags.indices.to_numpy(), rows["gram"].to_numpy()
    order = np.lexsort((gram, tag))
    counts = np.bincount(tag, minlength=len(tags.dictionary))
    ends = np.cumsum(counts)
    spans = zip((ends - counts).tolist(), ends.tolist(), strict=True)
    places = dict(zip(tags.dictionary.to_pylist(), spans, strict=True))
    return Held(gram[order].astype(np.uint32), rows["value"].to_numpy()[order], places)


def train(docs: DataFrame) -> Model:
    """Count with Spark and smooth with Spark; only the n-grams to be held come home."""
    by_order = {ORDER: stored(gram_counts(docs), "grams")}
    for order in range(ORDER - 1, 0, -1):
        suffix = F.expr(f"gram & {(1 << (BITS * order)) - 1}").alias("gram")
        fewer = by_order[order + 1].select("lang", suffix).groupBy("lang", "gram")
        by_order[order] = stored(fewer.agg(F.count("*").alias("n")), "grams")
    grams_of, contexts_of, lower = [], [], None
    for order in range(1, ORDER + 1):
        lower, contexts = _smoothed(by_order[order], order, lower)
        lower = stored(lower, "probabilities")
        grams_of.append(lower.selectExpr("lang", "gram", _LN_P))
        contexts_of.append(contexts.selectExpr("lang", "context AS gram", "CAST(ln(weight) AS FLOAT) AS value"))
    return Model(grams_of, contexts_of, _hold(lower))


def _rests(owner: np.ndarray, keys: np.ndarray, count: int) -> pa.Array:
    """Per text (``count`` of them) its distinct n-grams ``keys`` and how often it has each; null without one."""
    pairs, times = np.unique(owner.astype(np.uint64) << np.uint64(32) | keys, return_counts=True)
    each = np.bincount((pairs >> np.uint64(32)).astype(np.int64), minlength=count)
    parts = [(pairs & np.uint64(0xFFFFFFFF)).astype(np.int64), times.astype(np.int64)]
    pairs = pa.StructArray.from_arrays([pa.array(p) for p in parts], ["gram", "times"])
    ends = np.concatenate([[0], np.cumsum(each)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pairs, mask=pa.array(each == 0))


def scored(docs: DataFrame, carried: list[str], held: Held) -> DataFrame:
    """``carried`` columns, the base counts and each text's mean negative log-probability a byte.

    That is over the n-grams that are held; ``_rest`` has the others of the text's ``_size``.
    """
    shared = docs.sparkSession.sparkContext.broadcast((held.keys, held.values, held.places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Held(*shared.value)
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = as_texts(part.column("_text"))
                tags = part.column("_lang").to_pylist()
                found = base_counts(texts)
                keys, sizes = grams(texts)
                total = np.full(len(texts), np.nan)
                firsts = np.concatenate([[0], np.cumsum(sizes)])
                rests = []
                for tag in set(tags):
                    rows = np.array([i for i, t in enumerate(tags) if t == tag])
                    chosen = ragged(firsts[rows], sizes[rows])
                    logs, here = known.log_probabilities(keys[chosen], tag)
                    owner = np.repeat(np.arange(len(rows)), sizes[rows])
                    with np.errstate(invalid="ignore", divide="ignore"):
                        # Each text is summed by itself: equal texts have equal scores.
                        total[rows] = -np.bincount(owner, logs, len(rows)) / sizes[rows]
                    if not here.all():
                        rests.append((rows[owner[~here]], keys[chosen[~here]]))
                owners, others = zip(*rests, strict=True) if rests else ([np.zeros(0, np.int64)], [keys[:0]])
                columns = [part.column(c) for c in carried] + [pa.array(v) for v in found.values()]
                columns += [
                    pa.array(total, from_pandas=True),
                    pa.array(sizes.astype(np.int64)),
                    _rests(np.concatenate(owners), np.concatenate(others), len(texts)),
                ]
                names = [*carried, *found, "log_perplexity", "_size", "_rest"]
                yield pa.RecordBatch.from_arrays(columns, names)
        release()

    given = [F.col(c) for c in carried]
    chosen = docs.select(*given, F.col("text").alias("_text"), F.col("lang").alias("_lang"))
    made = f"{BASE}, log_perplexity double, _size long, _rest array<struct<gram: long, times: long>>"
    return chosen.mapInArrow(run, carrying(docs, carried, made))


def _with_rests(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` of ``scored`` with the whole ``log_perplexity``: what is not held is joined, once a text."""
    names = ["lang", "_h1", "_h2"]
    several = rows.filter("_rest IS NOT NULL")
    if several.isEmpty():
        return rows.drop("_size", "_rest")
    once = several.groupBy(*names).agg(F.first("_rest").alias("_rest"))
    found = model.look_up(once.select(*names, F.inline("_rest")))
    # Decimals: the same sum in any order, so that equal texts have equal scores.
    logs = F.sum(F.expr("CAST(value AS DECIMAL(22, 16)) * CAST(times AS DECIMAL(10))")).cast("double")
    sums = found.groupBy(F.col("lang").alias("_of"), F.col("_h1").alias("_g1"), F.col("_h2").alias("_g2"))
    sums = sums.agg(logs.alias("_logs"))
    both = rows.join(sums, F.expr("lang <=> _of AND _h1 = _g1 AND _h2 = _g2"), "left")
    whole = F.expr("CASE WHEN _logs IS NULL THEN log_perplexity ELSE log_perplexity - _logs / _size END")
    both = both.withColumn("log_perplexity", whole)
    return stored(both.drop("_size", "_rest", "_of", "_g1", "_g2", "_logs"), "scored")


def verdicts(docs: DataFrame, carried: list[str], reach: float = REACH) -> DataFrame:
    """``carried``, ``lang``, the base columns, ``log_perplexity``, ``base_failed`` and ``kept``, beside
    the hashes of the text (``_h1, _h2``).

    The corpus is read twice, to count and to score; scores are stored before the bands are taken.
    """
    model = train(docs.select("text", "lang"))
    names = ["_h1", "_h2"]
    own = [c for c in carried if c != "lang"]
    docs = docs.select(*own, "lang", "text", *_text_names())
    rows = _with_rests(stored(scored(docs, [*own, "lang", *names], model.held), "scored"), model)
    # Copies count once, however many there are.
    distinct = rows.filter("log_perplexity IS NOT NULL").groupBy(F.col("lang").alias("_of"), *names)
    spread = f"greatest(_q[1] - _q[0], {LEAST_SPREAD})"
    bands = (
        distinct.agg(F.min("log_perplexity").alias("_score")).groupBy("_of")
        .agg(F.percentile_approx("_score", [0.25, 0.75], 10_000).alias("_q"))
        .selectExpr("_of", f"_q[0] - {reach} * {spread} AS _low", f"_q[1] + {reach} * {spread} AS _high")
    )
    bands = stored(bands, "bands")
    if bands.count() <= FEW_LANGUAGES:
        bands = F.broadcast(bands)
    failed = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
    return (
        rows.join(bands, F.col("lang").eqNullSafe(F.col("_of")), "left")
        .withColumn("base_failed", F.expr(failed))
        .withColumn(
            "kept", F.expr("NOT base_failed AND coalesce(log_perplexity BETWEEN _low AND _high, false)")
        )
        .drop("_low", "_high", "_of")
    )


def kept_rows(docs: DataFrame, reach: float = REACH) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, whatever their names.

    Each text goes to Python once to be scored. A verdict is its text's, so rows are found again by
    language and the text's hashes: those of whom no rejected text has the bits are kept where they are,
    the others meet the rejected ones.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    judged = verdicts(docs, [], reach)
    gone = stored(judged.filter("NOT kept").select(F.col("lang").alias("_lang"), "_h1", "_h2").distinct(), "rejected")
    named = docs.select(whole, F.col("lang").alias("_of"), *_text_names())
    doubtful, clean = in_names(named, gone.select("_h1"))
    gone = gone.withColumnsRenamed({"_h1": "_g1", "_h2": "_g2"})
    rejected = F.expr("_of <=> _lang AND _h1 <=> _g1 AND _h2 <=> _g2")
    doubtful = doubtful.join(gone, rejected, "left_anti")
    return clean.select("_row.*").union(doubtful.select("_row.*"))


def quality_rules(docs: DataFrame, reach: float = REACH) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text, lang``; other columns are not looked at)."""
    return verdicts(docs.select("doc_id", "text", "lang"), ["doc_id"], reach).drop("lang", "_h1", "_h2")
