"""A keyed table that a stream changes batch by batch and readers can use at any time.

The table is cut into buckets by a hash of its key.  A batch (a *version*)
rewrites the buckets that hold its keys and no others:

    changes/version=7/bucket=3/...   the batch's rows, as they came
    data/version=7/bucket=3/...      the whole bucket after the batch
    manifest/version=7/...           which version of every bucket counts

A version counts once its manifest is complete (Spark marks a finished folder),
and readers take the last one that is, so they see a whole batch or nothing of
it, and a crash in between loses nothing.  A batch that runs again writes the
same version again.  A lookup reads the buckets of its keys alone.

Equal keys in one batch: the last by ``order`` counts, or any one without it.
Null keys are keys.  An empty batch makes no version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET = "__bucket"
_GONE = "__gone"


class PublishedTable:
    def __init__(self, spark: SparkSession, path: str, key: list[str], schema: T.StructType, buckets: int = 32):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), list(key), buckets
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        """All complete versions, in order."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest/version=*/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    def _manifest(self, version: int | None) -> dict[int, int]:
        """Version by bucket: at most one row for each bucket."""
        if version is None:
            return {}
        rows = self.spark.read.schema("bucket int, version long").parquet(f"{self.path}/manifest/version={version}")
        return {r.bucket: r.version for r in rows.collect()}

    def _rows(self, manifest: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/data/version={v}/{_BUCKET}={b}" for b, v in sorted(manifest.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def merge(self, rows: DataFrame, version: int, gone: DataFrame | None = None, order: str | None = None) -> None:
        """Put ``rows`` in the place of those of their keys, and take out the keys of ``gone``."""
        names = self.schema.fieldNames()
        all_rows = rows.select(*names, F.lit(False).alias(_GONE), *([F.col(order).alias("__order")] if order else []))
        if gone is not None:
            lost = gone.select(*[F.col(c) if c in self.key else F.lit(None).cast(self.schema[c].dataType).alias(c)
                                 for c in names], F.lit(True).alias(_GONE))
            all_rows = all_rows.unionByName(lost, allowMissingColumns=True)
        changes = f"{self.path}/changes/version={version}"
        # a stream's batch is worked out once: what follows reads the written rows
        all_rows.withColumn(_BUCKET, self._bucket()).write.mode("overwrite").partitionBy(_BUCKET).parquet(changes)
        written = self.spark.read.schema(T.StructType(
            [*all_rows.schema.fields, T.StructField(_BUCKET, T.IntegerType())])).parquet(changes)
        touched = [r[0] for r in written.select(_BUCKET).distinct().collect()]
        if not touched:
            return
        earlier = [v for v in self.versions() if v < version]
        manifest = self._manifest(earlier[-1] if earlier else None)
        by = F.struct("__order") if order else F.struct(F.lit(0))
        one = (written.groupBy(*self.key, _BUCKET).agg(F.max_by(F.struct(*names, _GONE), by).alias("x"))
               .select("x.*", _BUCKET))
        old = self._rows({b: v for b, v in manifest.items() if b in touched}).alias("old")
        same = None
        for c in self.key:
            equal = F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
            same = equal if same is None else same & equal
        kept = old.join(one.select(*self.key).alias("new"), same, "left_anti").withColumn(_BUCKET, self._bucket())
        now = kept.unionByName(one.where(~F.col(_GONE)).drop(_GONE))
        data = f"{self.path}/data/version={version}"
        now.write.mode("overwrite").partitionBy(_BUCKET).parquet(data)
        left = {r[0] for r in self.spark.read.schema(f"{_BUCKET} int").parquet(data).select(_BUCKET).distinct().collect()}
        manifest = {b: v for b, v in manifest.items() if b not in touched} | {b: version for b in left}
        (self.spark.createDataFrame(sorted(manifest.items()), "bucket int, version long").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}"))

    def read(self, version: int | None = None) -> DataFrame:
        """The whole table, as of the last complete version or of ``version``."""
        found = self.versions()
        return self._rows(self._manifest(version if version is not None else found[-1] if found else None))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of the keys of a request list; only their buckets are read."""
        found = self.versions()
        manifest = self._manifest(found[-1] if found else None)
        wanted = {r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect()}
        rows = self._rows({b: v for b, v in manifest.items() if b in wanted})
        return keys.select(*self.key).distinct().join(rows, self.key, "left")

    def vacuum(self) -> None:
        """Delete changes and buckets that the last complete version does not need."""
        found = self.versions()
        if not found:
            return
        needed = {f"version={v}/{_BUCKET}={b}" for b, v in self._manifest(found[-1]).items()}
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for f in fs.globStatus(path(f"{self.path}/data/version=*/{_BUCKET}=*")) or []:
            at = f.getPath()
            if f"{at.getParent().getName()}/{at.getName()}" not in needed and \
                    int(at.getParent().getName().split("=")[1]) <= found[-1]:
                fs.delete(at, True)
        for f in fs.globStatus(path(f"{self.path}/changes/version=*")) or []:
            if int(f.getPath().getName().split("=")[1]) <= found[-1]:
                fs.delete(f.getPath(), True)


def publish_state(table: PublishedTable, checkpoint: str, columns: dict[str, Column], state_var: str | None = None) -> int:
    """Bring ``table`` up to a stream's last batch by what changed in its state since the table's last version.

    ``columns``: the table's columns as expressions of the state's ``key`` and
    ``value``.  Returns the table's version, the id of the stream's last batch
    that changed it.
    """
    spark = table.spark
    last = table.versions()
    reader = (spark.read.format("statestore").option("readChangeFeed", True)
              .option("changeStartBatchId", last[-1] + 1 if last else 0))
    if state_var:
        reader = reader.option("stateVarName", state_var)
    committed = _last_commit(spark, checkpoint)
    if last and committed <= last[-1]:
        return last[-1]
    feed = reader.option("changeEndBatchId", committed).load(checkpoint)
    changes = feed.select("batch_id", "change_type", *[c.alias(n) for n, c in columns.items()])
    newest = (changes.groupBy(*table.key).agg(F.max_by(F.struct(*changes.columns), F.col("batch_id")).alias("x"))
              .select("x.*"))
    update = F.col("change_type") == "update"
    table.merge(newest.where(update), committed, gone=newest.where(~update))
    return committed


def _last_commit(spark: SparkSession, checkpoint: str) -> int:
    """The id of a stream's last committed batch."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return max((int(f.getPath().getName()) for f in found if f.getPath().getName().isdigit()), default=-1)
