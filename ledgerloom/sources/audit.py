"""Row counts of inputs, observed while a job runs anyway."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, functions as F


class EmptyInput(ValueError):
    """An input that must have rows has none."""


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows plus an observation of their number: no extra pass over the data."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def seen_rows(observation: Observation, counted_apart: Callable[[], int] = lambda: 0) -> int:
    """Number of rows seen by a finished job.

    Where AQE found the rows to be none it has dropped the observing step with them; then they are counted apart.
    """
    try:
        return observation.get["rows"]
    except Py4JJavaError:
        return counted_apart()


def require_rows(seen: Observation | int, name: str) -> int:
    """Number of rows seen by a finished job; an empty input is an error."""
    rows = seen if isinstance(seen, int) else seen_rows(seen)
    if rows == 0:
        raise EmptyInput(f"{name}: no rows")
    return rows
