"""A corpus from documents: rules, near duplicates, repeated passages, benchmark texts, packing.

Each stage works on what the one before kept, written as Parquet and read again, and all but the
last return the columns they were given.

* ``quality_rules``: rows that fail the base rules or fall outside their language's band go.
* ``near_duplicates``: one document of each component stays, the one with the smallest id.
* ``repeated_passages``: bytes of 50-byte strings that an earlier document has are cut out of
  ``text`` (a character that loses a byte goes as a whole); ``n_chars`` follows.
* ``benchmark_texts``: documents that contain a window of a benchmark item go.
* ``packing``: what is left is tokenised and packed; rows are pieces.

Defined results: rows without an id pass near duplicates and repeated passages untouched. Rows of one
id share a verdict only where they share a text. Extra columns of ``documents`` are carried along,
whatever their names. An empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm.common import new_folder, prepared, table
from trolley.llm.decontamination import contaminated_rows
from trolley.llm.near_dedup import near_dedup
from trolley.llm.packing import pack
from trolley.llm.quality_rules import kept_rows
from trolley.llm.substring_dedup import cut_substrings


def _whole(docs: DataFrame) -> F.Column:
    """All columns as one, out of the way of the operators' own names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    # A name that no column has.
    name = "_gone" + "_" * max(len(c) for c in docs.columns)
    gone = near_dedup(docs).filter("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.expr(f"CAST(doc_id AS BIGINT) = {name}"), "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    others = [c for c in docs.columns if c != "text"]
    cut = cut_substrings(docs, others, with_text=True)
    made = {c: F.col(f"row.`{c}`") for c in others}
    made["text"] = F.col("kept_text")
    if "n_chars" in made:
        changed = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        made["n_chars"] = F.when(F.col("n_removed") > 0, changed).otherwise(made["n_chars"])
    return cut.select(*[made[c].alias(c) for c in docs.columns])


def benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    rows = docs.select("doc_id", "text", _whole(docs))
    return contaminated_rows(rows, table(spark, sf_dir, "benchmark")).filter("NOT contaminated").select("_row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_texts", benchmark_texts),
    ("packing", packing),
]

#: Bands of a language model and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name)
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
