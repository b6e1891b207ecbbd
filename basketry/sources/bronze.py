"""Raw event files: CSV with a header, every column kept as text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

SOURCE_COLUMN = "source_file"
SOURCE_NO = "source_no"


def source_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def entries(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def bronze_paths(folder: str, files: Sequence[str] = (), single: str | None = None) -> list[str]:
    """Paths of the listed monthly files, or of the single file when no list is given."""
    names = list(files) or ([single] if single else [])
    if not names:
        raise ValueError("name at least one bronze file")
    return [f"{folder.rstrip('/')}/{name}" for name in names]


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    # Columns bind by the header of this entry. With enforceSchema off, a folder whose
    # files carry different headers fails loudly instead of mixing up its columns; the
    # escape setting reads doubled quotes the way CSV writers emit them.
    try:
        return spark.read.csv(path, header=True, escape='"', enforceSchema=False)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no raw events at {path}") from problem
        raise


def _first_rows(entry: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each file of an entry, in file order.

    Rows are counted for each split of a file; only splits that begin before row ``n`` are looked at
    again, and each task sends no more than ``n`` rows of a file to where they are cut.
    """
    own = entry.columns
    placed = entry.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_begin": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
    )
    earlier = Window.partitionBy("_file").orderBy("_begin").rowsBetween(Window.unboundedPreceding, -1)
    splits = placed.groupBy("_file", "_begin").agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    wanted = splits.withColumn("_before", before).where(F.col("_before") < n)
    rows = placed.join(wanted.select("_file", "_begin"), ["_file", "_begin"], "left_semi")
    place = F.row_number().over(Window.partitionBy("_file").orderBy("_begin", "_row"))
    return rows.withColumn("_place", place).where(F.col("_place") <= n).select(*own)


def read_bronze(
    spark: SparkSession,
    paths: str | Sequence[str],
    limit_per_file: int | None = None,
) -> DataFrame:
    """One text frame over all entries, matched by column name.

    An entry is a file, a folder or a glob, and ``.gz`` / ``.bz2`` files are decompressed by
    suffix. ``source_file`` is the last part of the entry's path and ``source_no`` its position,
    which tells entries of equal names apart. ``limit_per_file`` is for dry runs: it keeps the
    first rows of each file.
    """
    frames = []
    for number, path in enumerate(entries(paths)):
        whole = _read_csv(spark, path)
        part = whole if limit_per_file is None else _first_rows(whole, limit_per_file)
        frames.append(part.withColumns({SOURCE_COLUMN: F.lit(source_name(path)), SOURCE_NO: F.lit(number)}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
