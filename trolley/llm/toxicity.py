"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme values.

A word's features are the word and its beginnings of 4 to 8 bytes, hashed to ``2 ** HASH_BITS``
slots. Spark counts each slot's occurrences in all documents and in the labelled ones. A slot's
score is the log-odds of its rate in toxic against clean text under a Dirichlet prior in proportion
to the whole corpus, taken one standard error towards zero; a word's is the largest of its slots',
less ``DRIFT``, so that ordinary text scores below zero. A linear-time scan finds all maximal
segments of positive total. In clean text a segment of score ``s`` in ``n`` words is expected
``K n exp(-lambda s)`` times by chance: ``lambda`` is taken from the words' scores, and ``K`` from each
text's best segment, both of labelled clean rows that the weights were not learned from. Segments
expected fewer than ``EXPECTED`` times are significant, or fewer still, so that no more than that share
of those rows has one. A document's evidence is its best segment's surprise (the negative
logarithm of how many are expected), the sum and number of its significant ones', and the pooled
surprise of all segments that a single word seldom begins (fewer than ``SELDOM`` times), for what is
spread thinly. A logistic curve fitted on other labelled rows than the counts makes it the score.

Learning takes at most ``SAMPLE`` labelled ids (those with the smallest hashes), which are sent to
the executors, 16 bytes each; texts are never shuffled. Rows whose crc32 of the id (as text) is 2
modulo 4 are held out: never counted as labelled, never calibrated on.

Defined results: a null or empty text has no words and gets the score of no evidence. A row without
an id is unlabelled and not held out. Rows of one id each give a result row. An id whose labels
disagree is not learned from. Without toxic or without clean examples all scores are the share of
toxic ones (one half without any). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.quality_classifier import agreed_labels, fold
from trolley.llm.text import ALNUM, Texts, as_texts, slices, span_names, split_words
from trolley.session import stored

HASH_BITS = 20
SAMPLE = 50_000
FOLDS, HELD_OUT, CALIBRATE = 4, 2, 3
PREFIXES = (4, 5, 6, 7, 8)
#: The prior's weight, as a share of the labelled words.
PRIOR = 0.1
DRIFT = 0.3
#: Clean texts that may hold a significant passage: one in 200, since toxic ones are rare themselves.
EXPECTED = 0.005
SELDOM = 1e-3
CUT = 0.3


def slots_of(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of slots per word (the word, then its beginnings; -1 where it is too short), the words'
    texts, and where each word begins."""
    words = split_words(texts, ALNUM)
    shift = np.uint64(64 - HASH_BITS)
    columns = [(words.names() >> shift).astype(np.int64)]
    for size in PREFIXES:
        slot = np.full(len(words.start), -1, np.int64)
        longer = np.flatnonzero(words.size > size)
        names = span_names(words.wide, words.start[longer], np.full(len(longer), size), seed=1)
        slot[longer] = (names >> shift).astype(np.int64)
        columns.append(slot)
    return np.stack(columns, axis=1), words.owner, words.start


def _counts(rows: Iterator[pa.RecordBatch], ids: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Occurrences of each slot in all, clean and toxic texts, and each kind's words in the last row."""
    made = np.zeros((3, (1 << HASH_BITS) + 1), np.int64)
    for batch in rows:
        for part in slices(batch, "text"):
            slot, owner, _ = slots_of(as_texts(part.column("text")))
            kind = _kinds(part.column("doc_id"), ids, labels)[owner]
            for row, chosen in ((0, slice(None)), (1, kind == 0), (2, kind == 1)):
                mine = slot[chosen]
                made[row, :-1] += np.bincount(mine[mine >= 0], minlength=1 << HASH_BITS)
                made[row, -1] += len(mine)
    return made


def _kinds(column: pa.Array, ids: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Each row's label; -1 without one."""
    known = np.array(column.is_valid())
    given = column.fill_null(0).to_numpy(zero_copy_only=False)
    if not len(ids):
        return np.full(len(given), -1)
    at = np.minimum(np.searchsorted(ids, given), len(ids) - 1)
    return np.where(known & (ids[at] == given), labels[at], -1)


def weights(counts: np.ndarray) -> np.ndarray:
    """Each slot's score from the counts in all, clean and toxic texts."""
    every, clean, toxic = counts[:, :-1].astype(np.float64)
    words = np.maximum(counts[:, -1].astype(np.float64), 1)
    strength = PRIOR * (words[1] + words[2])
    prior = np.maximum(strength * every / words[0], 1e-9)

    def log_odds(seen: np.ndarray, total: float) -> np.ndarray:
        return np.log(seen + prior) - np.log(np.maximum(total + strength - seen - prior, 1))

    gap = log_odds(toxic, words[2]) - log_odds(clean, words[1])
    error = np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    gap = np.sign(gap) * np.maximum(np.abs(gap) - error, 0)
    gap[every == 0] = 0
    return gap.astype(np.float32)


def word_scores(slot: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The largest score of each word's slots, less the drift; clean evidence counts at most once
    the drift."""
    scores = np.where(slot >= 0, table[slot], -np.inf).max(axis=1, initial=-np.inf)
    return np.clip(scores, -DRIFT, None) - DRIFT


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score), in linear time.

    Neighbours of one sign are one step; candidates are kept on a stack with the totals before and
    after them, and each leads to the nearest candidate before it that begins lower.
    """
    if not len(scores) or scores.max() <= 0:
        return []
    sign = scores > 0
    edges = np.flatnonzero(np.append(True, sign[1:] != sign[:-1]))
    total = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    stops = np.append(edges[1:], len(scores))
    found: list[tuple[int, int, float, float, int]] = []
    for first, end in zip(edges[sign[edges]].tolist(), stops[sign[edges]].tolist(), strict=True):
        low, high = float(total[first]), float(total[end])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append((first, end, low, high, j))
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
    return [(first, end, high - low) for first, end, low, high, _ in found]


@dataclass
class Chance:
    """What clean text gives: how often segments of a score are expected, and the surprise from which
    one is significant."""

    rate: float = 1.0
    size: float = 1.0
    need: float = -np.log(EXPECTED)

    def surprise(self, score: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The negative logarithm of how many such segments are expected in so many words."""
        return self.rate * score - np.log(np.maximum(words, 1)) - np.log(self.size)


def decay_of(values: np.ndarray, times: np.ndarray) -> float | None:
    """The rate at which clean segments' scores thin out: the positive root of
    sum p exp(rate * score) = 1, by bisection. Nothing if there is none."""
    share = times / max(times.sum(), 1)
    if not share[values > 0].sum() or (values * share).sum() >= 0:
        return None
    low, high = 0.0, 50.0
    for _ in range(80):
        middle = (low + high) / 2
        with np.errstate(over="ignore"):
            above = (share * np.exp(middle * values)).sum() > 1
        low, high = (low, middle) if above else (middle, high)
    return max((low + high) / 2, 1e-3)


def chance_of(values: np.ndarray, times: np.ndarray, words: np.ndarray, best: np.ndarray) -> Chance:
    """The chance of clean texts, from how often each word score occurs in them and from each text's
    words and best segment (zero without any)."""
    rate = decay_of(values, times)
    if rate is None:
        return Chance()
    # Of a text, words * exp(-rate * best) is exponential with rate K; without a segment it is cut off.
    size = float(np.clip((best > 0).sum() / max((words * np.exp(-rate * best)).sum(), 1e-9), 1e-9, 1))
    known = Chance(rate, size)
    surprises = np.sort(known.surprise(best, words)[best > 0])
    allowed = int(EXPECTED * len(best))
    if len(surprises) > allowed:
        known.need = max(known.need, float(np.nextafter(surprises[len(surprises) - 1 - allowed], np.inf)))
    return known


_BINS = np.linspace(-2 * DRIFT - 1e-6, 15, 400)


def _sample(labels: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids (ascending), labels and folds of the labelled rows to learn from."""
    rows = agreed_labels(labels, "toxic").withColumnRenamed("_labelled", "doc_id")
    rows = rows.withColumn("fold", fold(FOLDS)).filter(F.col("fold") != HELD_OUT)
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toArrow().to_pandas().sort_values("doc_id")
    return tuple(rows[c].to_numpy(np.int64) for c in ("doc_id", "label", "fold"))


def _table(docs: DataFrame, ids: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Count in every task, add up with Spark, and bring home one row per slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _counts(batches, ids, labels)
        slot = np.flatnonzero(made[0])
        for low in range(0, len(slot), 100_000):
            some = slot[low : low + 100_000]
            columns = [some, *made[:, some]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["slot", "a", "c", "t"])

    counted = docs.mapInArrow(run, "slot long, a long, c long, t long")
    rows = counted.groupBy("slot").agg(*[F.sum(c).alias(c) for c in ("a", "c", "t")]).toArrow()
    counts = np.zeros((3, (1 << HASH_BITS) + 1), np.int64)
    slot = rows["slot"].to_numpy()
    for k, c in enumerate(("a", "c", "t")):
        counts[k, slot] = rows[c].to_numpy()
    return weights(counts)


def _logistic(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton's method; the last weight is the constant."""
    x = np.column_stack([rows, np.ones(len(rows))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (labels - p) - 1e-2 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


#: What the logistic curve reads, as SQL: capped or on a log scale, so that no document bends it.
_EVIDENCE = [
    "greatest(least(best, 20), -10)", "ln(1 + greatest(total, 0))", "ln(1 + n_found)",
    "ln(1 + pooled)", "ln(1 + n_words)",
]


def find_passages(docs: DataFrame, table: np.ndarray, chance: Chance) -> DataFrame:
    """``doc_id, n_words, best, total, n_found, pooled, passages`` of each row: the surprise of the
    best segment, the sum over significant ones, their number, the pooled surprise of all seldom
    ones, and the significant ones' byte spans."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    seldom = -np.log(SELDOM)
    numbers = chance.rate, chance.size, chance.need

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Chance(*numbers)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = as_texts(part.column("text"))
                slot, owner, start = slots_of(texts)
                scores = word_scores(slot, shared.value)
                edges = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
                best, total, count, pooled, spans = [], [], [], [], []
                for i, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    found = maximal_segments(scores[low:high])
                    gains = known.surprise(np.array([s for _, _, s in found]), np.array(high - low))
                    single = gains + np.log(max(high - low, 1))
                    pooled.append(float(single[single >= seldom].sum()))
                    best.append(float(gains.max(initial=-10.0)))
                    strong = np.flatnonzero(gains >= known.need)
                    total.append(float(gains[strong].sum()))
                    count.append(len(strong))
                    begin = texts.offsets[i]
                    ends = [start[low + found[k][1]] if low + found[k][1] < high else texts.offsets[i + 1] for k in strong]
                    spans.append(
                        [int(x - begin) for k, end in zip(strong, ends, strict=True) for x in (start[low + found[k][0]], end)]
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(np.diff(edges)), pa.array(best, pa.float64()),
                        pa.array(total, pa.float64()), pa.array(count, pa.int64()), pa.array(pooled, pa.float64()),
                        pa.array(spans, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_words", "best", "total", "n_found", "pooled", "passages"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, best double, total double, n_found long, pooled double, passages array<long>"
    return docs.mapInArrow(run, schema)


def _chance(docs: DataFrame, table: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Chance:
    """The chance of the clean ones of the given rows, of which there are no more than the sample."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, words, best = np.zeros(len(_BINS) + 1, np.int64), [], []
        for batch in batches:
            batch = batch.filter(pa.array(_kinds(batch.column("doc_id"), ids, labels) == 0))
            for part in slices(batch, "text"):
                slot, owner, _ = slots_of(as_texts(part.column("text")))
                scores = word_scores(slot, shared.value)
                times += np.bincount(np.searchsorted(_BINS, scores), minlength=len(times))
                edges = np.searchsorted(owner, np.arange(part.num_rows + 1)).tolist()
                for low, high in zip(edges[:-1], edges[1:], strict=True):
                    words.append(high - low)
                    best.append(max((s for _, _, s in maximal_segments(scores[low:high])), default=0.0))
        at = np.flatnonzero(times)
        columns = [[*at, *[None] * len(words)], [*times[at], *words], [*[None] * len(at), *best]]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["at", "n", "best"])

    rows = docs.mapInArrow(run, "at long, n long, best double")
    rows = rows.groupBy("at", "n", "best").agg(F.count("*").alias("rows")).toArrow().to_pandas()
    middles = np.append(_BINS, _BINS[-1])
    scores, texts = rows[rows["at"].notna()], rows[rows["at"].isna()]
    times = texts["rows"].to_numpy(np.int64)
    return chance_of(
        middles[scores["at"].to_numpy(np.int64)],
        (scores["n"] * scores["rows"]).to_numpy(),
        np.repeat(texts["n"].to_numpy(np.float64), times),
        np.repeat(texts["best"].to_numpy(np.float64), times),
    )


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_words, n_found, passages`` of each row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids, marks, folds = _sample(labels, sample)
    learn = folds != CALIBRATE
    table = _table(docs, ids[learn], marks[learn])
    chance = _chance(docs, table, ids[~learn], marks[~learn])
    found = stored(find_passages(docs, table, chance), "passages")

    # At most the sample's rows come back.
    aside = found.sparkSession.createDataFrame(
        pa.table({"_id": ids[~learn], "label": marks[~learn]}) if (~learn).any() else [], "_id long, label long"
    )
    rows = found.join(aside, F.expr("doc_id = _id")).selectExpr(*_EVIDENCE, "label")
    rows = rows.toArrow().to_pandas().to_numpy(np.float64)
    if len(set(rows[:, -1])) == 2:
        curve = _logistic(rows[:, :-1], rows[:, -1]).tolist()
    else:
        share = (rows[:, -1].sum() + 1) / (len(rows) + 2)
        curve = [0.0] * len(_EVIDENCE) + [float(np.log(share / (1 - share)))]
    line = " + ".join(f"{w!r}D * {e}" for w, e in zip(curve, [*_EVIDENCE, "1"], strict=True))
    return found.select(
        "doc_id",
        F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.expr(f"1 / (1 + exp(-({line})))").alias("score"),
        F.expr(f"CASE WHEN 1 / (1 + exp(-({line}))) >= {CUT} THEN 1 ELSE 0 END").alias("predicted"),
        "n_words",
        "n_found",
        "passages",
    )
