"""Parquet and JSON tables between the steps: silver, gold, logs, results, models."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.settings import EVENT_COLUMNS


def _read_parquet(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from problem
        raise


def _by_day(df: DataFrame) -> DataFrame:
    """Gather each day into few, evenly sized tasks.

    ``rebalance`` clusters by day and lets AQE merge the small days and cut a hot day into
    several tasks, so a day with a third of all rows still becomes many files of bounded
    size. ``repartition("date")`` would write that day from one task.
    """
    return df.hint("rebalance", F.col("date"))


def write_silver(events: DataFrame, path: str, only_days: bool = False) -> None:
    """Replace the silver table, one folder per day; with ``only_days`` just the days of ``events``."""
    mode = "dynamic" if only_days else "static"
    writer = _by_day(events).write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy("date").parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned events; the number of the entry they came from is left in the files."""
    return _read_parquet(spark, path).select(*EVENT_COLUMNS, "date")


def write_gold(gold: DataFrame, path: str, by_day: bool = False) -> None:
    """Replace a gold table; ``by_day`` suits the daily table, whose readers pick days.

    Each day is sorted by product, so that a lookup skips row groups and columns pack well.
    """
    if by_day:
        days = _by_day(gold).sortWithinPartitions("date", "product_id")
        days.write.mode("overwrite").partitionBy("date").parquet(path)
    else:
        gold.write.mode("overwrite").parquet(path)


def write_bucketed_gold(gold: DataFrame, name: str, path: str, buckets: int) -> None:
    """Replace the catalog table ``name``, its files at ``path`` dealt out by product.

    What works per product (windows, summary joins, lookups) then reads its rows where they lie instead of
    shuffling them first. A bucket is one file, as rows are brought together by the same hash before;
    a product has one row a day, so buckets stay even. Size ``buckets`` for 128-256 MB each.
    """
    dealt = gold.repartition(buckets, "product_id")
    writer = dealt.write.mode("overwrite").bucketBy(buckets, "product_id").sortBy("product_id", "date")
    writer.option("path", path).format("parquet").saveAsTable(name)


def read_bucketed_gold(spark: SparkSession, name: str) -> DataFrame:
    """The table with its buckets. Joins on product and day may use them, although they lack the day."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark.table(name)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold with its date as ``DateType`` and the same date as text in ``date_str``."""
    gold = _read_parquet(spark, path)
    if "date" not in gold.columns:
        return gold
    day = F.to_date("date")
    return gold.withColumns({"date": day, "date_str": F.date_format(day, "yyyy-MM-dd")})


def append_run_log(stats: DataFrame, path: str, stage: str) -> None:
    """Append the rows of ``stats`` with the run's time and stage name."""
    stamped = stats.select(
        F.current_timestamp().alias("timestamp"), F.lit(stage).alias("stage"), "*"
    )
    stamped.write.mode("append").json(path)


def write_profile(profile: DataFrame, path: str) -> None:
    """One-row profile as JSON."""
    profile.write.mode("overwrite").json(path)


def write_results(results: DataFrame, path: str) -> None:
    """Replace the results of the experiments in ``results``, leaving other experiments alone."""
    (
        results.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("experiment")
        .parquet(path)
    )


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return _read_parquet(spark, path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
