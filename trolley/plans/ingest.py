"""Storing one batch of outcomes; shared by the batch job and the stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators.enrich import fact_rows
from trolley.operators.metrics import FLUSH_FAILED, samples_of
from trolley.operators.prefix import Keys
from trolley.operators.rollups import PARTIALS
from trolley.plans.batch import Settings, accepted_events, outcomes
from trolley.plans.reads import event_days
from trolley.sinks.dead_letters import dead_letters
from trolley.sinks.flush import flush
from trolley.sinks.publish import enriched_messages
from trolley.sinks.tables import BATCH, write_batch, write_fact
from trolley.session import stored


@dataclass(frozen=True)
class Tables:
    """Where a job's tables lie: one folder each below ``root``."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def fact(self) -> str:
        return self.path("cart_events_raw")

    @property
    def dead_letter(self) -> str:
        return self.path("dead_letter")

    @property
    def enriched(self) -> str:
        return self.path("enriched_events")

    @property
    def event_days(self) -> str:
        return self.path("event_days")

    @property
    def metrics(self) -> str:
        return self.path("metrics")

    def partials(self, rollup: str) -> str:
        return self.path(f"partials_{rollup}")


def store_results(results: DataFrame, tables: Tables, batch_id: int) -> None:
    """Write everything one batch produces; ``results`` must be cached or checkpointed.

    The fact table goes first. Every write replaces an earlier attempt of the same batch, so a
    failure anywhere is repaired by running the batch again.
    """
    accepted = accepted_events(results)
    fact = fact_rows(accepted)
    write_fact(fact, tables.fact, batch_id)
    write_batch(dead_letters(results), tables.dead_letter, batch_id)
    write_batch(enriched_messages(accepted), tables.enriched, batch_id)
    write_batch(event_days(fact), tables.event_days, batch_id)
    for name in PARTIALS:
        write_batch(partial_of(name, fact), tables.partials(name), batch_id)
    write_batch(samples_of(results), tables.metrics, batch_id)


def ingest_batch(
    events: DataFrame,
    tables: Tables,
    batch_id: int = 0,
    settings: Settings = Settings(),
    hot: Keys = None,
) -> DataFrame:
    """Process a batch of arrivals and store all of it; returns the outcomes."""
    results = outcomes(events, settings, hot)
    if settings.clean_resends:
        # Otherwise what is costly has been stored on the way.
        results = stored(results, "outcomes")
    store_results(results, tables, batch_id)
    return results


def flush_batch(
    accepted: DataFrame,
    tables: Tables,
    batch_id: int,
    write: Callable[[DataFrame], None] | None = None,
    on_success: Callable[[], None] = lambda: None,
) -> bool:
    """Write a batch of accepted events as ``flush`` does, and count it.

    A batch that is stored leaves its counters; one that is not leaves its dead letters and counters of
    failed writes, and ``FlushError`` is raised. Repeating the batch replaces either.
    """
    if write is None:
        write = partial(write_fact, path=tables.fact, batch_id=batch_id)

    def count(rows: DataFrame) -> None:
        write_batch(samples_of(rows), tables.metrics, batch_id)

    def lost(letters: DataFrame) -> None:
        write_batch(letters, tables.dead_letter, batch_id)
        count(accepted.withColumn("outcome", F.lit(FLUSH_FAILED)))

    def kept() -> None:
        count(accepted)
        on_success()

    return flush(accepted, write, lost, kept)


def partial_of(rollup: str, fact: DataFrame) -> DataFrame:
    """What a batch leaves, of a size that does not grow with its events."""
    return PARTIALS[rollup].partial(fact)


class _Partials:
    """The folders of a roll-up's partials: one a batch, and aside of them what a compaction has merged.

    A merge is there once Spark has marked it as finished. From then on it stands for all batches up to
    its own, whichever of their folders are still left.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path, self.aside = path, f"{path}_compacted"
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self, path: str) -> list[int]:
        root = self._hadoop.Path(path)
        if not self._fs.exists(root):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(root)]
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{BATCH}="))

    def batches(self) -> list[int]:
        return self._numbers(self.path)

    def merged(self) -> int | None:
        """The last batch of a finished merge that has not taken its place yet."""
        done = [n for n in self._numbers(self.aside) if self._exists(f"{self.aside}/{BATCH}={n}/_SUCCESS")]
        return max(done, default=None)

    def folders(self) -> list[str]:
        """What readers read: every batch once."""
        upto = self.merged()
        if upto is None:
            return [f"{self.path}/{BATCH}={n}" for n in self.batches()]
        later = [f"{self.path}/{BATCH}={n}" for n in self.batches() if n > upto]
        return [f"{self.aside}/{BATCH}={upto}", *later]

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._hadoop.Path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._hadoop.Path(path), True)

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._hadoop.Path(source), self._hadoop.Path(target)):
            raise OSError(f"{source} could not be moved to {target}")


def stored_rollup(spark: SparkSession, tables: Tables, rollup: str) -> DataFrame:
    """A roll-up read from the partials all batches left. Minutes are exact; distinct counts of more than
    4,096 sessions or users of an hour or product are estimates, the exact ones come from the fact table."""
    partials = spark.read.parquet(*_Partials(spark, tables.partials(rollup)).folders())
    return PARTIALS[rollup].of_partials(partials)


def compaction_steps(spark: SparkSession, tables: Tables, rollup: str, upto: int) -> Iterator[str]:
    """``compact_partials`` step by step. It may stop after any step, or in the middle of one:
    ``stored_rollup`` is right at any time, and the next run finishes what this one began."""
    held = _Partials(spark, tables.partials(rollup))
    merged = held.merged()
    if merged is None:
        old = [b for b in held.batches() if b <= upto]
        if len(old) < 2:
            return
        partials = spark.read.parquet(*[f"{held.path}/{BATCH}={b}" for b in old])
        merged = old[-1]
        write_batch(PARTIALS[rollup].merged(partials), held.aside, merged)
        yield "merged"
    for batch in held.batches():
        if batch <= merged:
            held.delete(f"{held.path}/{BATCH}={batch}")
            yield f"deleted {batch}"
    held.move(f"{held.aside}/{BATCH}={merged}", f"{held.path}/{BATCH}={merged}")
    yield "moved"


def compact_partials(spark: SparkSession, tables: Tables, rollup: str, upto: int) -> None:
    """Merge the partials of all batches up to a finished one into that batch's.

    The merged rows are stored aside first and stand for the batches from the moment they are
    complete; then the older folders go, and one rename puts the merged one in their place. A run that
    broke off is finished first, before anything is merged anew.
    """
    for _ in range(2):
        # The first round may only have finished an earlier run.
        for _ in compaction_steps(spark, tables, rollup, upto):
            pass
