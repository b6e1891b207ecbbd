"""Raw files as a stream: clean each micro-batch as it arrives.

The same row-wise cleaning as the batch run, applied piece by piece so that a month of
files never has to be read at once. A micro-batch plays the part of a chunk.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.operators import cleaning
from basketry.session import prepare
from basketry.settings import EVENT_COLUMNS
from basketry.sources.tables import write_silver

_SILVER_SCHEMA = (
    "event_time timestamp, event_type string, product_id long, category_id long, category_code string, "
    "brand string, price double, user_id long, user_session string, date date"
)
_RAW_SCHEMA = ", ".join(f"{c} string" for c in EVENT_COLUMNS)


def stream_bronze(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """New CSV files of ``folder`` as text rows; a file with another column order is an error."""
    reader = spark.readStream.schema(_RAW_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder, header=True, escape='"', enforceSchema=False)


def start_ingest(
    bronze: DataFrame, silver: str, checkpoint: str, valid_event_types=None
) -> StreamingQuery:
    """Clean what has arrived and store it by batch and day, then stop.

    A batch overwrites only its own ``batch=`` folder, so a batch that is run again after a
    failure replaces its first attempt instead of doubling it.
    """

    def store(rows: DataFrame, batch: int) -> None:
        cleaned = cleaning.clean_events(rows, valid_event_types).withColumn("batch", F.lit(batch))
        (
            cleaned.hint("rebalance", F.col("date"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch", "date")
            .parquet(silver)
        )

    return (
        bronze.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, silver: str) -> DataFrame:
    """Silver events of all batches, with the copies that fell into different batches dropped."""
    return cleaning.drop_copies(_stored(spark, silver, _SILVER_SCHEMA))


def ingest_folder(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Ingest what is new in ``folder``, then settle the days it touches into the silver table.

    The batches stay in ``target/batches``. Copies across batches are dropped once, while
    ``target/silver`` is written, so that readers of silver do not repeat that shuffle; equal
    events have equal days, so only the days of new batches are read and written again. The
    number of the last settled batch is noted after the write: a run that fails in between
    settles the same days once more.
    """
    stream = stream_bronze(prepare(spark), folder)
    start_ingest(stream, f"{target}/batches", f"{target}/state").awaitTermination()
    batches = _stored(spark, f"{target}/batches", f"{_SILVER_SCHEMA}, batch int")
    fresh = batches.where(F.col("batch") > _last_settled(spark, f"{target}/settled"))
    found = fresh.groupBy("date").agg(F.max("batch").alias("batch")).collect()  # a row for each day
    if found:
        touched = batches.where(F.col("date").isin([r["date"] for r in found]))
        rows = cleaning.drop_copies(touched.select(*EVENT_COLUMNS, "date"))
        write_silver(rows, f"{target}/silver", only_days=True)
        note = spark.createDataFrame([(max(r["batch"] for r in found),)], "batch int")
        note.write.mode("append").json(f"{target}/settled")
    return _stored(spark, f"{target}/silver", _SILVER_SCHEMA)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that has no files, or no folder, as long as no valid row has come."""
    try:
        return spark.read.schema(schema).parquet(path).select(*_columns(schema))
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def _columns(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _last_settled(spark: SparkSession, path: str) -> int:
    try:
        return spark.read.schema("batch int").json(path).agg(F.max("batch")).first()[0]
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return -1
        raise
