"""Starting a few Spark jobs side by side from the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def side_by_side(
    spark: SparkSession, work: Callable[[Any], Any], items: Iterable, parallelism: int
) -> list:
    """``work(item)`` for each item, in order of the items; Spark shares its slots among them."""
    task = inheritable_thread_target(spark)(work)
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        return list(pool.map(task, items))
