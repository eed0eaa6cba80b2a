"""Independent jobs on one session at the same time."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable, Mapping
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from contextvars import copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Key = TypeVar("Key", bound=Hashable)
Value = TypeVar("Value")


def side_by_side(
    spark: SparkSession,
    name: str,
    tasks: Mapping[Key, Callable[[], Value]],
    threads: int | None = None,
) -> dict[Key, Value]:
    """What each task returns, in the order given.

    Each task runs on a thread of its own, in a job group and scheduler pool of its own (pools share
    the executors evenly where ``spark.scheduler.mode`` is FAIR); with ``threads`` so many at a time.
    When one fails, the jobs of all others are cancelled, and its error is raised.
    """
    context = spark.sparkContext
    tag = f"{name}-{uuid.uuid4().hex}"

    def started(key: Key, task: Callable[[], Value]) -> Callable[[], Value]:
        def work() -> Value:
            context.setJobGroup(f"{tag}-{key}", f"{name} {key}")
            context.setLocalProperty("spark.scheduler.pool", f"{name}-{key}")
            context.addJobTag(tag)
            return task()

        variables = copy_context()
        return inheritable_thread_target(spark)(lambda: variables.run(work))

    with ThreadPoolExecutor(threads or max(len(tasks), 1)) as pool:
        running = {key: pool.submit(started(key, task)) for key, task in tasks.items()}
        done, others = wait(running.values(), return_when=FIRST_EXCEPTION)
        failed = [future for future in done if future.exception()]
        if failed:
            for future in others:
                future.cancel()
            context.cancelJobsWithTag(tag)
            raise failed[0].exception()
        return {key: future.result() for key, future in running.items()}
