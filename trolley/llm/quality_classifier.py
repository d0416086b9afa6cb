"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

One pass over all texts makes the statistics and stores them (some thirty numbers a document). The
trees are fitted on the driver on at most ``SAMPLE`` labelled rows, the ones with the smallest hash
of their id; scoring walks flat arrays in the executors and does not read texts again.

Labels, language, source and id are never inputs of a score. Rows whose crc32 of the id (as text) is
0 modulo ``FOLDS`` are held out of fitting.

Defined results: a null or empty text has all statistics zero and gets a score like any other. A row
without an id is never fitted on, is not held out, and is scored. Rows of one id each give a result
row. An id whose labels disagree, or is labelled with null, is not fitted on. Without labelled rows
every score is one half. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import per_slice
from trolley.llm.quality_rules import base_counts
from trolley.llm.text import SPACED, as_texts, mix, split_words, sums_by
from trolley.llm.trees import Forest, fit
from trolley.session import stored

FOLDS = 5
SAMPLE = 20_000
CUT = 0.3

_CLASSES = {
    "upper": np.array([65 <= b <= 90 for b in range(256)]),
    "lower": np.array([97 <= b <= 122 for b in range(256)]),
    "digit": np.array([48 <= b <= 57 for b in range(256)]),
    "blank": np.array([b in b" \t\r\x0b\x0c" for b in range(256)]),
    "beyond": np.array([b >= 128 for b in range(256)]),
    "stop": np.array([b in b".!?" for b in range(256)]),
    "shout": np.array([b == 33 for b in range(256)]),
    "comma": np.array([b in b",;:" for b in range(256)]),
    "symbol": np.array([b in b"#*$%&|<>" for b in range(256)]),
    "bar": np.array([b == 124 for b in range(256)]),
    "line": np.array([b == 10 for b in range(256)]),
    "bracket": np.array([b in b"()[]{}\"'" for b in range(256)]),
    "same": None,
}
STATISTICS = [
    "size", "words", "word_length", "long_words", "short_words", "distinct", "commonest", "capital_words",
    "lines", "dup_lines", "repeat_words", "symbol_words", "entropy", "line_words", *_CLASSES,
]


def statistics(rows: pa.RecordBatch) -> np.ndarray:
    """A row of ``STATISTICS`` per text."""
    texts = as_texts(rows.column("text"))
    n = len(texts)
    base = base_counts(texts)
    words = split_words(texts, SPACED)
    size, count = texts.sizes, words.counts
    some, full = np.maximum(count, 1), np.maximum(size, 1)

    def per_byte(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[texts.offsets[1:]] - total[texts.offsets[:-1]]

    def per_word(mask: np.ndarray) -> np.ndarray:
        return sums_by(count, mask.astype(np.int64)) / some

    distinct, commonest = np.zeros(n), np.zeros(n)
    if len(words.start):
        keys = mix(words.names(), words.owner.astype(np.uint64))
        _, first, times = np.unique(keys, return_index=True, return_counts=True)
        distinct = np.bincount(words.owner[first], minlength=n)
        np.maximum.at(commonest, words.owner[first], times)
    heads = texts.data[words.start] if len(words.start) else texts.data[:0]
    marks = np.concatenate([[0], np.cumsum(_CLASSES["symbol"][texts.data])])
    lines = per_byte(texts.data == 10) + 1
    # Entropy of the bytes, from a histogram per text.
    entropy = np.zeros(n)
    ends = texts.offsets.tolist()
    for i in range(n):
        if size[i]:
            shares = np.bincount(texts.data[ends[i] : ends[i + 1]], minlength=256) / size[i]
            shares = shares[shares > 0]
            entropy[i] = -(shares * np.log2(shares)).sum()
    same = np.append(False, texts.data[1:] == texts.data[:-1])
    columns = [
        np.log1p(size), np.log1p(count), base["word_chars"] / some, per_word(words.size > 12),
        per_word(words.size < 3), distinct / some, commonest / some, per_word(_CLASSES["upper"][heads]),
        np.log1p(lines), base["n_dup_lines"] / lines, base["n_repeat_words"] / some,
        per_word(marks[words.start + words.size] > marks[words.start]), entropy, count / lines,
        *[per_byte(same[: len(texts.data)] if t is None else t[texts.data]) / full for t in _CLASSES.values()],
    ]
    made = np.stack(columns, axis=1).astype(np.float64)
    made[size == 0] = 0
    return made


def _measure(rows: pa.RecordBatch) -> pa.RecordBatch:
    made = statistics(rows)
    ends = np.arange(len(made) + 1, dtype=np.int32) * len(STATISTICS)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel().astype(np.float32)))
    return pa.RecordBatch.from_arrays([rows.column("doc_id"), lists], ["doc_id", "statistics"])


def agreed_labels(labels: DataFrame, name: str) -> DataFrame:
    """``doc_id, label`` of the ids that have one label, 0 or 1."""
    rows = labels.filter(f"doc_id IS NOT NULL AND {name} IN (0, 1)").groupBy("doc_id")
    both = rows.agg(F.min(name).alias("label"), F.max(name).alias("_other"))
    return both.filter("label = _other").select(F.col("doc_id").alias("_labelled"), "label")


def fold(folds: int) -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def train(measured: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    """Fit on the ``sample`` labelled rows with the smallest hashes that are not held out."""
    rows = measured.filter(fold(FOLDS) != 0).join(
        agreed_labels(labels, "quality"), F.expr("doc_id = _labelled")
    )
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("statistics", "label").toArrow()
    values = np.array(chosen["statistics"].to_pylist(), np.float64).reshape(-1, len(STATISTICS))
    return fit(values, chosen["label"].to_numpy().astype(np.float64))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs`` (``doc_id, text``)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    measured = stored(
        per_slice(docs.select("doc_id", "text"), _measure, f"doc_id {kind}, statistics array<float>"), "statistics"
    )
    forest = train(measured, labels, sample)
    arrays = forest.features, forest.thresholds, forest.leaves, forest.start

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Forest(*arrays)
        for batch in batches:
            values = batch.column("statistics").flatten().to_numpy().astype(np.float64)
            scores = known.score(values.reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    scored = measured.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        F.coalesce(fold(FOLDS) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"),
    )
