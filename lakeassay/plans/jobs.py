"""Running independent Spark jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def run_together(tasks: Sequence[Callable[[], Result]], at_once: int = 4) -> list[Result]:
    """Results in order. The tail of one job leaves room on the cluster for the next.

    The first failure is raised once the jobs already submitted have ended.
    """
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        submitted = [pool.submit(inherit(task)) for task in tasks]
        return [job.result() for job in submitted]
