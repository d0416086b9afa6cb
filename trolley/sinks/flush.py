"""Writing one batch of accepted events where the caller holds the state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from trolley.operators.enrich import fact_rows
from trolley.sinks.dead_letters import failed_flush


class FlushError(Exception):
    """The batch was not stored; all its events have been dead-lettered."""


def flush(
    accepted: DataFrame,
    write: Callable[[DataFrame], None],
    dead_letter: Callable[[DataFrame], None],
    on_success: Callable[[], None] = lambda: None,
) -> bool:
    """Write the batch, then let the caller commit its state.

    If the write fails, every event of the batch goes to the dead letters, ``on_success`` is not
    called (so nothing counts as processed) and FlushError is raised. An empty batch does nothing.
    """
    if accepted.isEmpty():
        return False
    try:
        write(fact_rows(accepted))
    except Exception as error:
        dead_letter(failed_flush(accepted, str(error)))
        raise FlushError(f"flush failed: {error}") from error
    on_success()
    return True
