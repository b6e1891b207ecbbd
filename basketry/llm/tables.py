"""Tables that a job writes once and reads several times, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from basketry import scratch


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` and read it back: work is not repeated and survives lost executors."""
    path = scratch.scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(*columns: str) -> Column:
    """Hash of a row's own content, nulls told apart; with the id it names a row of any corpus."""
    return F.xxhash64(*(x for c in columns for x in (F.col(c).isNull(), F.col(c))))


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """Every row as one struct ``row``, so that its columns clash with no name, and its key."""
    return docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), row_key(*columns).alias("row_key")
    )


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on (doc_id, row_key); hot groups of copies spread by their ids."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["row_key"] == right["row_key"])


def with_text(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``rows`` (row, text), with the new text; ``n_chars`` follows it."""
    fresh = {"text": F.col("text"), "n_chars": F.length("text")}
    return rows.select(
        *(fresh.get(f.name, F.col(f"row.`{f.name}`")).cast(f.dataType).alias(f.name) for f in docs.schema)
    )


def text_schema(docs: DataFrame) -> StructType:
    """Schema of (row, text) frames, as Python functions return them."""
    return StructType().add("row", docs.schema).add("text", "string")
