"""A keyed table kept in hash buckets of Parquet: a merge writes only the buckets that a batch touches, and commits once.

`path/rows/batch=<n>/bucket=<b>` holds what batch n wrote of bucket b, `path/log/batch=<n>` what it appended, and
`path/manifests/<n>.json` names the batch that each bucket was last written by. A batch counts from the moment its manifest
is there, which is its last step; one that broke off is written over when it comes again, and one that is there is left
alone. Buckets that a batch does not touch keep their files.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class BucketStore:
    """One table with the key columns `keys`. `buckets` is fixed when the store is made."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets
        jvm = spark.sparkContext._jvm
        self._at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where = self._at(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []

    def batches(self) -> list[int]:
        """The numbers of the batches that count, in order."""
        return sorted(int(n[: -len(".json")]) for n in self._names("manifests") if n.endswith(".json"))

    def _manifest(self, number: int) -> dict:
        text = self.spark.read.text(f"{self.path}/manifests/{number}.json", wholetext=True).first()[0]
        return json.loads(text)

    def current(self) -> dict[int, int]:
        """bucket -> the batch that wrote it last."""
        done = self.batches()
        return {int(b): n for b, n in self._manifest(done[-1])["buckets"].items()} if done else {}

    def read(self, only: list[int] | None = None) -> DataFrame:
        """The table, or only some of its buckets."""
        at = {b: n for b, n in self.current().items() if only is None or b in only}
        paths = [f"{self.path}/rows/batch={n}/bucket={b}" for b, n in sorted(at.items())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def log(self) -> DataFrame | None:
        """What all batches appended, None if nothing."""
        paths = [f"{self.path}/log/batch={n}" for n in self.batches() if f"batch={n}" in self._names("log")]
        return self.spark.read.parquet(*paths) if paths else None

    def merge(self, batch: DataFrame, number: int, apply: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame | None]], facts: dict | None = None) -> bool:
        """Bring a batch in: apply(stored rows of the touched buckets, batch) gives these buckets' new rows and rows to append.
        False, and nothing is done, where the batch was merged before. The batch is read twice, so it should be cheap to
        read (a table, or a cached micro-batch). facts go into the manifest."""
        if number in self.batches():
            return False
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))
        touched = sorted(r[0] for r in batch.select(bucket.alias("b")).distinct().collect())  # at most `buckets` numbers
        before = self.current()
        rows, appended = apply(self.read(touched), batch)
        names = [c.name for c in self.spark.createDataFrame([], self.schema).schema]
        # dealt by bucket, but a bucket that holds much is written by several tasks
        out = rows.select(*names).withColumn("bucket", bucket)
        out.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/rows/batch={number}")
        if appended is not None:
            appended.write.mode("overwrite").parquet(f"{self.path}/log/batch={number}")
        written = {int(n.split("=")[1]) for n in self._names(f"rows/batch={number}") if n.startswith("bucket=")}
        after = {b: n for b, n in before.items() if b not in touched} | {b: number for b in written}
        self._commit(number, {"buckets": after, **(facts or {})})
        return True

    def facts(self, number: int) -> dict:
        """What was said of a batch when it was committed."""
        return {k: v for k, v in self._manifest(number).items() if k != "buckets"}

    def _commit(self, number: int, manifest: dict) -> None:
        """Write the manifest beside its place and rename it, so that it is there as a whole or not at all."""
        self._fs.mkdirs(self._at(f"{self.path}/manifests"))
        beside = self._at(f"{self.path}/manifests/_{number}.new")
        stream = self._fs.create(beside, True)
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        stream.close()
        if not self._fs.rename(beside, self._at(f"{self.path}/manifests/{number}.json")):
            raise OSError(f"batch {number} was committed by another run")
