"""From raw files to the silver table, and from silver to the two gold tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.operators.cleaning import RowCounts, clean_events, counted_stats
from basketry.operators.daily import product_by_day
from basketry.operators.sketches import viewer_sketches
from basketry.operators.summary import product_summary
from basketry.session import prepare
from basketry.settings import ROLLING_WINDOW
from basketry.sources import tables
from basketry.sources.bronze import entries, read_bronze, source_name


def build_silver(
    spark: SparkSession,
    paths: str | Sequence[str],
    silver: str,
    log: str | None = None,
    valid_event_types: Iterable[str] | None = None,
    limit_per_file: int | None = None,
) -> DataFrame:
    """Clean raw files into the silver table and return it.

    With ``log`` the rows read and kept per entry are appended there. They are counted by the job
    that cleans and writes, so raw files are read once and silver is not read at all.
    """
    raw = read_bronze(prepare(spark), paths, limit_per_file)
    names = [source_name(p) for p in entries(paths)]
    rows_in, rows_out = RowCounts(len(names)), RowCounts(len(names))
    cleaned = clean_events(rows_in.watch(raw), valid_event_types, keep_source=True)
    tables.write_silver(rows_out.watch(cleaned), silver)
    if log is not None:
        stats = counted_stats(spark, rows_in, rows_out, names)
        tables.append_run_log(stats.withColumn("silver", F.lit(silver)), log, "clean")
    return tables.read_silver(spark, silver)


def build_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    log: str | None = None,
    window: int = ROLLING_WINDOW,
    sketches: bool = False,
) -> dict[str, DataFrame]:
    """Write ``product_summary`` and ``product_by_day`` from silver and return both.

    With ``sketches`` also ``viewer_sketches``, from which distinct viewers of any days follow.
    """
    events = tables.read_silver(prepare(spark), silver)
    names = ("product_summary", "product_by_day", *(["viewer_sketches"] if sketches else []))
    paths = {name: f"{gold}/{name}" for name in names}
    if sketches:
        tables.write_gold(viewer_sketches(events), paths["viewer_sketches"], by_day=True)
    tables.write_gold(product_summary(events), paths["product_summary"])
    tables.write_gold(product_by_day(events, window), paths["product_by_day"], by_day=True)
    built = {name: tables.read_gold(spark, path) for name, path in paths.items()}
    if log is not None:
        sizes = [
            frame.agg(F.lit(name).alias("table"), F.count("*").alias("rows"))
            for name, frame in built.items()
        ]
        tables.append_run_log(reduce(DataFrame.unionByName, sizes), log, "build_features")
    return built
