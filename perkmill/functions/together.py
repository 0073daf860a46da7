"""Independent steps side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")
#: Steps that run at the same time.
AT_ONCE = 8


def together(spark: SparkSession, *steps: Callable[[], T]) -> list[T]:
    """Results of steps that don't depend on each other, in their order.

    A step that writes out candidates or looks up bounds waits for Spark several times, mostly for plans of
    short queries; in threads of the driver these waits overlap, and one step's tasks fill the cores that
    the last tasks of another leave idle. Job groups, tags and other local properties carry over.
    If steps fail, the first one's error is raised once all have ended, so that none runs on unseen.
    """
    with ThreadPoolExecutor(max(1, min(AT_ONCE, len(steps)))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]
