"""Ingest jobs: a broken file loses no other, and a run counts once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import jobs

FIELDS = "series string, obs_date date, value double"


def lines(text):
    for line in text.splitlines()[1:]:
        name, day, value = line.split(",")
        yield name, dt.date.fromisoformat(day), float(value)


def late_failure(text):
    yield from lines(text)
    raise ValueError("cut off")


LAYOUTS = [jobs.Layout("short", lambda t: t.startswith("short"), late_failure), jobs.Layout("plain", lambda t: "series" in t[:40], lines), jobs.Layout("curve", lambda t: t.startswith("Tenor"), None)]
CATALOG = "series_id string, min_value double, max_value double, max_step double"
TODAY = dt.date(2024, 6, 30)


@pytest.fixture
def job(spark, tmp_path):
    records = lambda rows: rows.select(F.col("series").alias("series_id"), "obs_date", F.lit("{}").alias("dims_key"), "value", F.struct("file", "row_no").alias("seq"), "file", "row_no")
    hide = lambda text: F.regexp_replace(text, "'[^']*'", "***")
    return jobs.Job("test", LAYOUTS, FIELDS, records, jobs.observation_store(spark, str(tmp_path / "store"), 4), hide)


def put(tmp_path, **files):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def catalog(spark):
    return spark.createDataFrame([("a", 0.0, 40.0, None), ("b", 0.0, 40.0, 5.0)], CATALOG)


def test_one_bad_file_of_five_loses_no_other(spark, tmp_path, job):
    good = {f"f{i}": f"series\na,2024-01-0{i + 1},{i}" for i in range(4)}
    folder = put(tmp_path, **good, f9="series\na,2024-01-09,1\na,2024-01-10,secret")
    assert job.run(folder, catalog(spark), F.lit(TODAY)) == {"status": "partial", "rows": 4, "files": 5, "skipped": 1}
    assert sorted(r.value for r in job.store.read().collect()) == [0.0, 1.0, 2.0, 3.0]
    assert [(r.file.rsplit("/", 1)[1], r.row_no, r.error) for r in job.bad_records().collect()] == [("f9.csv", None, "ValueError: could not convert string to float: ***")]
    assert job.run(folder, catalog(spark), F.lit(TODAY))["status"] == "no_new_data"
    folder = put(tmp_path, g0="series\na,2024-01-01,7\nb,2024-01-01,99\nno,2024-01-01,1\nb,2025-01-01,1", c="Tenor,Mid\n1,2", s="short series\na,2024-02-01,5")
    assert job.run(folder, catalog(spark), F.lit(TODAY)) == {"status": "success", "rows": 2, "files": 3, "skipped": 0}
    assert [(r.series_id, str(r.obs_date), r.value) for r in job.store.log().collect()] == [("a", "2024-01-01", 0.0)]
    gates = sorted((r.row_no, r.error) for r in job.bad_records().filter("row_no is not null").collect())
    assert gates == [(1, "above maximum"), (2, "not in catalog"), (3, "future date")]
    assert job.store.facts(1) == {"job": "test", "files": 3, "rows": 2}


def test_all_bad_raises_and_commits_nothing(spark, tmp_path, job):
    folder = put(tmp_path, x="what is this", y="series\na,b,c")
    with pytest.raises(ValueError, match="all 2 file"):
        job.run(folder, catalog(spark), F.lit(TODAY))
    assert job.store.batches() == [] and job.bad_records() is None
    folder = put(tmp_path, z="series\nno,2024-01-01,1")
    with pytest.raises(ValueError, match="every record"):
        job.run(folder, catalog(spark), F.lit(TODAY))
    folder = put(tmp_path, z="series\na,2024-01-01,1")
    assert job.run(folder, catalog(spark), F.lit(TODAY)) == {"status": "partial", "rows": 1, "files": 3, "skipped": 2}


def test_a_run_that_broke_off_is_taken_again_once(spark, tmp_path, job, monkeypatch):
    folder = put(tmp_path, f="series\na,2024-01-01,1")

    def broken(*args):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(job.store, "_commit", broken)
        with pytest.raises(OSError):
            job.run(folder, catalog(spark), F.lit(TODAY))
    assert job.store.batches() == [] and job.store.read().isEmpty()
    assert job.run(folder, catalog(spark), F.lit(TODAY))["rows"] == 1 and job.store.read().count() == 1
    put(tmp_path, f="series\na,2024-01-01,22")
    assert job.run(folder, catalog(spark), F.lit(TODAY))["rows"] == 1 and [r.value for r in job.store.read().collect()] == [22.0]
