"""Running a batch job: load, process, save."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from quayline.operators.keyed import KeyedTable
from quayline.sources.tables import load_fact


@dataclass(frozen=True)
class Job:
    """``process`` turns the source rows into the rows of the target table; ``unique`` says that their keys differ."""

    name: str
    process: Callable[[DataFrame], DataFrame]
    mode: str = "full"
    unique: bool = False


def run_job(job: Job, source: DataFrame, target: Callable[[DataFrame], KeyedTable], as_of: dt.date | str) -> KeyedTable:
    """Run a job. A full load replaces the target, an increment (the day before ``as_of``) is merged into it.

    ``target`` gives the table to save to, which may depend on the result's schema. Errors end the job.
    """
    result = job.process(load_fact(source, job.mode, as_of))
    table = target(result)
    if job.mode == "full":
        table.replace(result, unique=job.unique)
    else:
        table.upsert(result, unique=job.unique)
    return table
