from __future__ import annotations

from basketry.operators import cleaning
from basketry.settings import EVENT_COLUMNS
from basketry.streaming import ingest
from data import RAW, raw_frame


def write(folder, name, rows):
    lines = [",".join(EVENT_COLUMNS)] + [",".join(r) for r in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_stream_equals_batch_and_resumes(spark, rows, tmp_path):
    folder, silver, state = (tmp_path / n for n in ("in", "silver", "state"))
    folder.mkdir()
    write(folder, "1.csv", RAW[:5])
    write(folder, "2.csv", RAW[3:9])  # repeats two rows of the first file

    def ingest_new():
        stream = ingest.stream_bronze(spark, str(folder), files_per_batch=1)
        ingest.start_ingest(stream, str(silver), str(state)).awaitTermination()
        return ingest.read_ingested(spark, str(silver))

    assert rows(ingest_new()) == rows(cleaning.clean_events(raw_frame(spark, RAW[:9])))
    write(folder, "3.csv", RAW[9:])
    want = rows(cleaning.clean_events(raw_frame(spark)))
    assert rows(ingest_new()) == want
    assert rows(ingest_new()) == want  # nothing new: nothing changes
    assert spark.read.parquet(str(silver)).select("batch").distinct().count() == 3


def test_only_touched_days_are_settled_again(spark, rows, tmp_path):
    folder, target = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    write(folder, "1.csv", RAW[:6])
    first = rows(ingest.ingest_folder(spark, str(folder), str(target)))
    assert first == rows(cleaning.clean_events(raw_frame(spark, RAW[:6])))
    old = {p.name for p in (target / "silver" / "date=2024-03-01").iterdir()}
    write(folder, "2.csv", RAW[4:5] + RAW[6:8])  # one known row of March 1st, two new ones of the 2nd
    ingest.ingest_folder(spark, str(folder), str(target))
    write(folder, "3.csv", RAW[8:])
    kept = {p.name for p in (target / "silver" / "date=2024-03-01").iterdir()}
    done = rows(ingest.ingest_folder(spark, str(folder), str(target)))
    assert done == rows(cleaning.clean_events(raw_frame(spark)))
    assert kept != old and {p.name for p in (target / "silver" / "date=2024-03-01").iterdir()} == kept
    assert rows(ingest.ingest_folder(spark, str(folder), str(target))) == done


def test_a_replayed_batch_replaces_itself(spark, rows, tmp_path):
    folder, silver = tmp_path / "in", tmp_path / "silver"
    folder.mkdir()
    write(folder, "1.csv", RAW)
    for attempt in ("a", "b"):  # a fresh state folder makes the same file batch 0 again
        stream = ingest.stream_bronze(spark, str(folder))
        ingest.start_ingest(stream, str(silver), str(tmp_path / attempt)).awaitTermination()
    assert spark.read.parquet(str(silver)).count() == 10


def test_folders_without_a_valid_row(spark, rows, tmp_path):
    folder, target = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    want = cleaning.clean_events(raw_frame(spark, RAW[9:11]))
    nothing = ingest.ingest_folder(spark, str(folder), str(target))
    assert nothing.collect() == [] and nothing.schema.simpleString() == want.schema.simpleString()
    write(folder, "1.csv", RAW[9:11])  # a bad time, an unknown type
    again = ingest.ingest_folder(spark, str(folder), str(target))
    assert again.collect() == [] and again.columns == want.columns
    write(folder, "2.csv", RAW)
    assert rows(ingest.ingest_folder(spark, str(folder), str(target))) == rows(cleaning.clean_events(raw_frame(spark)))
