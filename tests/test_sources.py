from __future__ import annotations

import glob
import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from basketry import scratch
from basketry.operators import cleaning
from basketry.plans import build
from basketry.settings import EVENT_COLUMNS
from basketry.sources import bronze, tables
from data import RAW, raw_frame

HEADER = ",".join(EVENT_COLUMNS)


def csv_lines(rows, columns=EVENT_COLUMNS):
    order = [EVENT_COLUMNS.index(c) for c in columns]
    return "\n".join([",".join(columns)] + [",".join(r[i] for i in order) for r in rows]) + "\n"


@pytest.fixture
def months(tmp_path):
    (tmp_path / "jan.csv").write_text(csv_lines(RAW[:6]))
    with gzip.open(tmp_path / "feb.csv.gz", "wt") as f:
        f.write(csv_lines(RAW[6:], EVENT_COLUMNS[::-1]))
    return [str(tmp_path / "jan.csv"), str(tmp_path / "feb.csv.gz")]


def test_columns_bind_by_name_in_each_file(spark, rows, months):
    raw = bronze.read_bronze(spark, months)
    assert raw.columns == [*EVENT_COLUMNS, "source_file", "source_no"]
    assert set(dict(raw.drop("source_no").dtypes).values()) == {"string"}
    want = cleaning.clean_events(raw_frame(spark))
    assert rows(cleaning.clean_events(raw)) == rows(want)
    counts = {r[0]: r[1] for r in raw.groupBy("source_file").count().collect()}
    assert counts == {"jan.csv": 6, "feb.csv.gz": 6}


def test_doubled_quotes(spark, tmp_path):
    path = tmp_path / "q.csv"
    row = list(RAW[0])
    row[5] = '"the ""big"" one, ltd"'
    path.write_text(csv_lines([row]))
    assert bronze.read_bronze(spark, str(path)).first()["brand"] == 'the "big" one, ltd'


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        bronze.read_bronze(spark, [str(tmp_path / "none.csv")])
    with pytest.raises(FileNotFoundError):
        tables.read_silver(spark, str(tmp_path / "none"))


def test_listed_files_win_over_the_single_one():
    assert bronze.bronze_paths("/b/", ["x.csv", "y.csv"], "z.csv") == ["/b/x.csv", "/b/y.csv"]
    assert bronze.bronze_paths("/b", single="z.csv") == ["/b/z.csv"]
    with pytest.raises(ValueError):
        bronze.bronze_paths("/b")


def test_row_cap_is_per_file(spark, months):
    raw = bronze.read_bronze(spark, months, limit_per_file=2)
    assert {r[1] for r in raw.groupBy("source_file").count().collect()} == {2}


@pytest.mark.parametrize("n", [0, 1, 150, 399, 400, 650, 5000])
def test_row_cap_keeps_the_first_rows_across_splits(spark, tmp_path, n):
    lines = [[*RAW[0][:7], str(i), "s"] for i in range(800)]
    (tmp_path / "a.csv").write_text(csv_lines(lines[:400]))
    (tmp_path / "b.csv").write_text(csv_lines(lines[400:]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "4k")
    try:
        kept = bronze.read_bronze(spark, str(tmp_path), limit_per_file=n)
        got = sorted(int(r["user_id"]) for r in kept.select("user_id").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    cap = min(n, 400)  # of each of the two files
    assert got == [*range(cap), *range(400, 400 + cap)]


def test_row_cap_stays_in_tasks(spark, months):
    capped = bronze.read_bronze(spark, months[:1], limit_per_file=2)
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan and "WindowGroupLimit" in plan
    assert "ExistingRDD" not in plan and "LocalTableScan" not in plan


def test_mixed_headers_in_one_folder_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text(csv_lines(RAW[:6]))
    (tmp_path / "b.csv").write_text(csv_lines(RAW[6:], EVENT_COLUMNS[::-1]))
    with pytest.raises(Exception, match="CSV header does not conform"):
        bronze.read_bronze(spark, str(tmp_path)).collect()


def test_silver_round_trip_replaces(spark, rows, tmp_path):
    path = str(tmp_path / "silver")
    events = cleaning.clean_events(raw_frame(spark))
    tables.write_silver(events.withColumn("date", F.lit("1999-01-01").cast("date")), path)
    tables.write_silver(events, path)
    back = tables.read_silver(spark, path)
    assert rows(back.select(*events.columns)) == rows(events)
    assert sorted(d.split("=")[1] for d in glob.glob(path + "/date=*")) == [
        "2024-03-01",
        "2024-03-02",
        "2024-03-03",
    ]
    plan = back.where("date = '2024-03-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "hot")
    numbers = spark.range(0, 400_000, 1, 16).selectExpr(
        "sha2(cast(id as string), 256) AS text",
        "date_add(DATE '2024-01-01', cast(if(id % 3 = 0, id % 90, 0) as int)) AS date",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        tables.write_silver(numbers, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{path}/date=2024-01-01/*.parquet")) > 3
    assert len(glob.glob(f"{path}/date=2024-02-01/*.parquet")) <= 2
    assert spark.read.parquet(path).count() == 400_000


def test_results_replace_only_their_experiments(spark, rows, tmp_path):
    path = str(tmp_path / "results")
    frame = lambda e, v: spark.createDataFrame([(v, e)], "mae double, experiment string")
    tables.write_results(frame("e1", 1.0).union(frame("e2", 2.0)), path)
    tables.write_results(frame("e1", 3.0), path)
    back = tables.read_results(spark, path)
    assert rows(back, "experiment", "mae") == [("e1", 3.0), ("e2", 2.0)]


def test_files_to_gold(spark, rows, months, tmp_path):
    silver, gold, log = (str(tmp_path / n) for n in ("silver", "gold", "log"))
    events = build.build_silver(spark, months, silver, log)
    assert events.count() == 10
    built = build.build_gold(spark, silver, gold, log)
    assert built["product_summary"].count() == 2
    assert built["product_by_day"].count() == 5
    assert {r["date_str"] for r in built["product_by_day"].collect()} == {
        "2024-03-01",
        "2024-03-02",
        "2024-03-03",
    }
    logged = spark.read.json(log)
    assert logged.where("timestamp IS NULL").count() == 0
    kept = logged.where("stage = 'clean'")
    assert rows(kept, "source_file", "rows_in", "rows_out") == [
        ("feb.csv.gz", 6, 4),
        ("jan.csv", 6, 6),
    ]
    # a single path, and entries of one name
    assert build.build_silver(spark, months[0], f"{silver}-one", f"{log}-one").count() == 6
    again = [months[0], months[0].replace("jan.csv", "../") + tmp_path.name + "/jan.csv"]
    build.build_silver(spark, again, f"{silver}-two", f"{log}-two")
    stats = spark.read.json(f"{log}-two")
    assert rows(stats, "source_no", "source_file", "rows_in", "rows_out") == [
        (0, "jan.csv", 6, 6),
        (1, "jan.csv", 6, 0),
    ]
    sizes = logged.where("stage = 'build_features'")
    assert rows(sizes, "table", "rows") == [("product_by_day", 5), ("product_summary", 2)]


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = (scratch.scratch_path(spark, "x") for _ in range(2))
    assert first != second
    if root:
        assert first.startswith(root.rstrip("/"))
    else:
        assert spark.sparkContext.getCheckpointDir()


def test_raw_files_are_read_once(spark, months, tmp_path, monkeypatch):
    """The rows in and out are known although the raw files are gone after the write."""
    import shutil

    (tmp_path / "raw").mkdir()
    raw = [shutil.copy(m, tmp_path / "raw") for m in months]
    write = tables.write_silver

    def write_and_lose(*args, **kwargs):
        write(*args, **kwargs)
        for path in raw:
            Path(path).rename(f"{path}.gone")

    monkeypatch.setattr(tables, "write_silver", write_and_lose)
    build.build_silver(spark, [str(r) for r in raw], str(tmp_path / "silver"), str(tmp_path / "log"))
    monkeypatch.undo()
    build.build_silver(spark, months, str(tmp_path / "silver2"), str(tmp_path / "log2"))
    columns = ("source_no", "rows_in", "rows_out")
    one, two = (sorted(map(tuple, spark.read.json(str(tmp_path / n)).select(*columns).collect())) for n in ("log", "log2"))
    assert one == two and sum(r[2] for r in one) == spark.read.parquet(str(tmp_path / "silver")).count()
