"""Small helpers shared by the operators: stable storage between stages and size-checked joins."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or the checkpoint folder that was set on the context. Where both
    are unset, a temporary one on a local master, where there is one machine only; on a cluster that is an error."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        known = sc._jsc.sc().getCheckpointDir()
        if not known.isDefined() and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = known.get() if known.isDefined() else tempfile.mkdtemp(prefix="ledgerline-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(where)
    return where


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint; rows survive the loss of an executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write a table in the shared folder and read it back: compressed, columnar, and safe from lost executors."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/ledgerline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1000):
    """Rows of whole texts go to Python so many at a time at most, in what runs inside; the session's setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows) if int(before) <= 0 else str(min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def join_sized(left: DataFrame, right: DataFrame, on: list[str], how: str, most_rows: int) -> DataFrame:
    """Join with a counted right side: broadcast up to most_rows rows, else shuffled (and split by AQE where skewed). The right
    side is checkpointed first, so that counting and joining do not compute it twice."""
    right = checkpoint(right)
    return left.join(F.broadcast(right) if right.count() <= most_rows else right, on, how)


def held_out(doc_id: Column) -> Column:
    """The fold that no model may learn from: crc32 of the id as text, modulo 3, is 1 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of what runs inside go when its result is written, not when the driver next collects its garbage; the
    session's setting comes back. Only for results that stored() or checkpoint() keep: a frame run again would shuffle again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


_KEPT: dict[str, Callable[[], None]] = {}


def give_back() -> None:
    """Return what this worker has freed to the system; otherwise an idle worker keeps its largest task's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def freeing(step, clear: Callable[[], None] = lambda: None):
    """The step on a task's batches; where the task ends its tables are emptied by `clear`, and what was freed goes back to the
    system. Idle workers are taken in turn, so what one keeps between tasks is held by every worker that the executor ever had."""

    def run(batches):
        try:
            yield from step(batches)
        finally:
            clear()
            give_back()

    return run


def only_cache(name: str, clear: Callable[[], None]) -> None:
    """A worker process outlives its tasks, and so do the look-up tables of the operators it ran. Called where a task
    begins: the tables of other operators are emptied, so that at most one operator's bounded tables are held at a time."""
    others = [k for k in _KEPT if k != name]
    for k in others:
        _KEPT.pop(k)()
    if others:
        give_back()
    _KEPT[name] = clear
