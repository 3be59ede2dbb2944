"""Ingest jobs: published files of several layouts become points of a store; a broken file loses no other.

Files are told apart by their content and read by a table function, joined laterally to the files, so that a file gives as
many rows as it holds and is read in a task of its own. A file that no layout fits, or whose parser fails, gives one row with
the error and nothing else. A run takes the files that no committed run has taken, writes what it read once, and counts
from the moment the store's manifest is there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import loads, merge
from ledgerline.sources.store import BucketStore

FILE = ["file", "length", "modified"]
STATE = "series_id string, obs_date date, dims_key string, value double, flagged boolean, revised_at timestamp, first_seen_at timestamp"


class Layout(NamedTuple):
    """One layout: its name, whether a text looks like it, and its rows. A parser fails for a text that is no such file after
    all. Without a parser the files are another job's: they give no rows and no error."""

    name: str
    fits: Callable[[str], bool]
    parse: Callable[[str], Iterable[tuple]] | None


def file_parser(layouts: list[Layout], fields: str, encoding: str = "utf-8"):
    """A table function content -> (layout, row_no, error, fields...): the rows of the first layout that fits and can read the
    text, all or none of them, else one row with the error of the first that failed."""

    width = len(fields.split(","))

    class Parse:
        def eval(self, content):
            text = bytes(content).decode(encoding, "replace")
            failed, error = None, "no layout fits"
            for layout in layouts:
                if not layout.fits(text):
                    continue
                if layout.parse is None:
                    return
                try:
                    rows = list(layout.parse(text))
                except Exception as e:  # whatever a broken file does to a parser is that file's error
                    if failed is None:
                        failed, error = layout.name, f"{type(e).__name__}: {e}"
                    continue
                for n, row in enumerate(rows):
                    yield (layout.name, n, None, *row)
                return
            yield (failed, None, error, *[None] * width)

    return F.udtf(Parse, returnType=f"layout string, row_no int, error string, {fields}")


def published(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder and those below it: (file, length, modified, content)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"), "content")


def parse_files(files: DataFrame, layouts: list[Layout], fields: str) -> DataFrame:
    """files (file, ..., content) -> their rows beside what identifies the file, without the content. Files are dealt out by
    name first: a task's share of them does not depend on how they were listed."""
    rows = file_parser(layouts, fields)(F.col("content").outer())
    return files.repartition("file").lateralJoin(rows).drop("content")


@dataclass
class Job:
    """A source's job. records: parsed rows without errors -> (series_id, obs_date, dims_key, value, seq, file, row_no), of
    which the last by seq counts for a point. redact: what may be kept of an error's text."""

    name: str
    layouts: list[Layout]
    fields: str
    records: Callable[[DataFrame], DataFrame]
    store: BucketStore
    redact: Callable[[Column], Column] = lambda text: text

    def _path(self, kind: str, number: int) -> str:
        return f"{self.store.path}/{kind}/batch={number}"

    def _kept(self, kind: str) -> DataFrame | None:
        paths = [self._path(kind, n) for n in self.store.batches()]
        return self.store.spark.read.parquet(*paths) if paths else None

    def new_files(self, folder: str) -> DataFrame:
        """Files that no committed run has taken; a file that was replaced is new."""
        files, done = published(self.store.spark, folder), self._kept("files")
        return files if done is None else files.join(done.select(*FILE), FILE, "left_anti")

    def bad_records(self) -> DataFrame | None:
        """(file, row_no, error) of all committed runs: files that could not be read, and records that the gates rejected."""
        return self._kept("bad")

    def run(self, folder: str, catalog: DataFrame, today: Column, now: datetime | None = None) -> dict:
        """Take a folder's new files into the store: {status, rows, files, skipped}. status is `success`, `partial` if a file
        was skipped, or `no_new_data`. Raises, with nothing committed, if every file failed or every record was rejected."""
        spark, done = self.store.spark, self.store.batches()
        number = done[-1] + 1 if done else 0
        files, parsed = self._path("files", number), self._path("parsed", number)
        # the list of files is fixed first: what is put into the folder meanwhile is the next run's
        self.new_files(folder).select(*FILE).write.mode("overwrite").parquet(self._path("taken", number))
        taken = spark.read.parquet(self._path("taken", number))
        content = published(spark, folder).join(taken, FILE, "left_semi")
        parse_files(content, self.layouts, self.fields).write.mode("overwrite").parquet(parsed)
        rows = spark.read.parquet(parsed)
        failed = rows.filter("error is not null").select(*FILE, "error")
        taken.join(failed, FILE, "left").write.mode("overwrite").parquet(files)
        counts = spark.read.parquet(files).agg(F.count(F.lit(1)).alias("files"), F.count("error").alias("skipped"), F.min("error").alias("first")).first()
        if counts.files == 0:
            return {"status": "no_new_data", "rows": 0, "files": 0, "skipped": 0}
        if counts.skipped and rows.filter("error is null").isEmpty():
            raise ValueError(f"all {counts.skipped} file(s) failed; first: {counts.first}")
        stamp = F.lit(now) if now else F.current_timestamp()
        last = merge.dedupe_last(self.records(rows.filter("error is null")), merge.POINT, "seq")
        stored = self.store.read()
        judged = merge.validate(last, catalog, merge.latest_value(last, stored), today)
        judged.write.mode("overwrite").parquet(self._path("judged", number))
        judged = loads.all_rejected_guard(spark.read.parquet(self._path("judged", number)))
        gates = judged.filter("reason is not null").select("file", "row_no", F.col("reason").alias("error"))
        broken = rows.filter("error is not null").select("file", F.lit(None).cast("int").alias("row_no"), self.redact(F.col("error")).alias("error"))
        broken.unionByName(gates).write.mode("overwrite").parquet(self._path("bad", number))
        accepted = judged.filter("reason is null").select(*merge.POINT, "value", "flagged")
        n = accepted.count()
        self.store.merge(accepted, number, lambda old, new: with_revisions(old, new, stamp), {"job": self.name, "files": counts.files, "rows": n})
        return {"status": "partial" if counts.skipped else "success", "rows": n, "files": counts.files, "skipped": counts.skipped}


def with_revisions(stored: DataFrame, incoming: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(state, revisions) of a merge, for BucketStore.merge."""
    merged = merge.merge_observations(stored, incoming, now)
    state = merged.select(*merge.POINT, "value", "flagged", "revised_at", "first_seen_at")
    return state, merged.filter("action = 'changed'").select(*merge.POINT, F.col("prior_value").alias("value"), F.col("revised_at").alias("superseded_at"))


def observation_store(spark: SparkSession, path: str, buckets: int = 64) -> BucketStore:
    """A store of observations, in buckets by series: what a record is measured against is in the bucket it goes to."""
    return BucketStore(spark, path, STATE, ["series_id"], buckets)
