"""What the operators share on the Spark side: batches to Python, tables kept between steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import suppress
import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.text import slices
from trolley.session import prepare, shared_dir, stored


#: Partitions the edges of one node are dealt over, besides what adaptive execution splits.
SALTS = 8
#: Rows of texts that go to Python at a time: with Spark's own 10,000, what both sides of the pipe
#: hold is tens of megabytes a task and grows with the documents.
ROWS_PER_BATCH = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings the operators rely on; smaller batches are left as they are."""
    prepare(spark)
    if not 0 < int(spark.conf.get(_BATCH)) <= ROWS_PER_BATCH:
        spark.conf.set(_BATCH, str(ROWS_PER_BATCH))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def release() -> None:
    """Give back what a task has freed: workers are kept for the next stage, and its tasks count with
    what is left of this one's."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def per_slice(
    df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType, text: str = "text"
) -> DataFrame:
    """Map runs of rows with a bounded amount of ``text`` to batches of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                made = make(part)
                if made is not None:
                    yield made
        release()

    return df.mapInArrow(run, schema)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh place in the folder all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def carrying(df: DataFrame, carried: list[str], made: str) -> T.StructType:
    """The ``carried`` columns of ``df`` (as they are, whatever their names) and the ``made`` ones."""
    return T.StructType([*[df.schema[c] for c in carried], *T.StructType.fromDDL(made)])


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of an undirected graph (``a, b``; longs): the smallest node reachable.

    Alternates large stars (every node's larger neighbours point to its smallest) and small stars
    (its smaller neighbours and itself do) until nothing changes. Stars of hub nodes are built by
    joins, salted, so that a hub is several tasks' work and in no task's memory. Nodes without an edge are not listed.
    """
    def keep(df: DataFrame) -> tuple[DataFrame, tuple]:
        kept = stored(df.distinct(), "edges")
        return kept, tuple(
            kept.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        # pairs: a is the centre
        smallest = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        side = F.col("b") > F.col("a") if larger else F.col("b") <= F.col("a")
        # A hub's neighbours are dealt over several partitions, which its smallest visits.
        salted = pairs.filter(side).withColumn("salt", F.pmod(F.hash("b"), F.lit(SALTS)))
        spread = smallest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        moved = salted.join(spread, ["a", "salt"]).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        if not larger:
            moved = moved.union(smallest.select("a", F.col("m").alias("b")))
        return moved.filter("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b")

    now, sign = keep(edges.filter("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b"))
    while sign[0]:
        both = now.union(now.selectExpr("b AS a", "a AS b"))
        now = star(both, larger=True).distinct()
        now, new = keep(star(now, larger=False))
        if new == sign:
            break
        sign = new
    return (
        now.groupBy("a").agg(F.min("b").alias("component"))
        .selectExpr("a AS node", "component")
        .union(now.selectExpr("b AS node", "b AS component").distinct())
    )
