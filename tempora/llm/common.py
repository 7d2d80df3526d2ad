"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.session import scratch_path

#: Words are runs of anything but ASCII white space; as a splitting pattern.
SPACES = r"[\x20\x09-\x0D]+"
#: Whether a query's shuffle files go when it ends, and not when the driver happens to collect garbage.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of rows that Spark hands to Python at once (outside the heap, for each task).
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Parquet options for wide rows: a row group is read whole, and page sizes are looked at from the first row on.
WIDE = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1}
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str):
    """A column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name


class Recent(dict):
    """Values made when first asked for; the older half goes when ``limit``
    entries are reached, but what is asked for again meanwhile stays."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, max(1, limit // 2), {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def take(self, values: dict) -> None:
        """Values made elsewhere."""
        if len(self) + len(values) > self.limit:
            self.old = dict(self)
            self.clear()
        self.update(values)

    def lacking(self, keys: set) -> set:
        """The keys without a value; what the older half has of the others stays."""
        keys = keys.difference(self)
        again = keys.intersection(self.old)
        if again:
            self.take({key: self.old[key] for key in again})
        return keys - again


class Scratch:
    """Tables written under the shared checkpoint folder.

    Written tables cut lineage and survive a lost executor.  ``drop`` frees
    a table once a later written table no longer needs it.  With ``free`` the
    shuffle files behind a table go as soon as it is written.  With
    ``batch_bytes`` rows reach Python in batches of about so many bytes (one row at
    least) and tables have small row groups, so that memory doesn't grow with the width of rows."""

    def __init__(self, spark: SparkSession, name: str, free: bool = False, batch_bytes: int | None = None):
        self.spark, self.free, self.batch_bytes = spark, free, batch_bytes
        self.base = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
        self.paths: dict[int, str] = {}

    def path(self, name: str) -> str:
        return f"{self.base}/{name}-{uuid.uuid4().hex[:6]}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        before = {k: self.spark.conf.get(k) for k in (FREE, BATCH)}
        self.spark.conf.set(FREE, self.free or before[FREE] == "true")
        if self.batch_bytes:
            self.spark.conf.set(BATCH, self.batch_bytes)
        try:
            df.write.options(**(WIDE if self.batch_bytes else {})).parquet(path)
        finally:
            for k, v in before.items():
                self.spark.conf.set(k, v)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        out._scratch = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df._scratch)
            path.getFileSystem(conf).delete(path, True)
