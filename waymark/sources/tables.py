"""Tables: reading, storing intermediate results in the shared folder, keyed merges, and the two-phase delete."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.functions.scalars import field, seconds


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share. Where none is set a temporary one is made if all run on one machine
    (as in tests); on a cluster that is an error."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="waymark-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder, where its lineage ends."""
    path = f"{shared_dir(df.sparkSession)}/waymark-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def query_scan(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Rows of SQL text over the given tables; the optimizer pushes its filters into their scans."""
    return spark.sql(sql, **tables)


def ids(df: DataFrame, id_col: str) -> DataFrame:
    """Ids alone, blanks out: the scan reads that one column. Complete, so there is no unknown state of a cut-off read."""
    return df.select(field(id_col).alias(id_col)).filter(F.trim(field(id_col).cast("string")) != "").distinct()


def freshest(df: DataFrame, by: str, n: int) -> DataFrame:
    """The n rows updated last: a top-n without a full sort."""
    return df.orderBy(field(by).desc_nulls_last()).limit(n)


def top_by_group(df: DataFrame, group: Column, by: Column, now: Column, look_back: dict[str, float], default_hours: float, n: int) -> DataFrame:
    """Of each group the n newest rows within its own look-back of hours. The optimizer limits groups before the shuffle."""
    hours = F.lit(default_hours)
    for name, value in look_back.items():
        hours = F.when(group == name, F.lit(float(value))).otherwise(hours)
    recent = df.withColumn("__wm_group", group).filter(seconds(by) >= seconds(now) - hours * 3600)
    ranked = recent.withColumn("__wm_rank", F.row_number().over(Window.partitionBy("__wm_group").orderBy(by.desc(), F.xxhash64(*[field(c) for c in df.columns]))))
    return ranked.filter(F.col("__wm_rank") <= n).drop("__wm_rank", "__wm_group")


def since(df: DataFrame, by: str, id_col: str, cursor: tuple | None, overlap_seconds: float = 0.0) -> DataFrame:
    """Rows after a cursor (time, id), or all from `overlap_seconds` before its time on when reads may lag."""
    if cursor is None:
        return df
    at, last = F.lit(cursor[0]).cast("timestamp"), F.lit(cursor[1])
    if overlap_seconds:
        return df.filter(seconds(field(by)) >= seconds(at) - overlap_seconds)
    return df.filter((field(by) > at) | ((field(by) == at) & (field(id_col) > last)))


def next_cursor(df: DataFrame, by: str, id_col: str) -> tuple | None:
    last = df.agg(F.max(F.struct(field(by).alias("at"), field(id_col).alias("id"))).alias("c")).first()["c"]
    return (last["at"], last["id"]) if last else None


def upsert(base: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """All of base with whole rows replaced by key, and new rows added. One row per key on both sides."""
    kept = base.join(rows.select(key), key, "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def partial_update(base: DataFrame, patch: DataFrame, key: str, create_missing: bool = False) -> DataFrame:
    """Non-null values of the patch win; columns and rows it doesn't have stay. Keys not in base are dropped or made."""
    new = [c for c in patch.columns if c not in base.columns]
    named = patch.select(F.col(key), *[F.col(c).alias(f"__wm_{c}") for c in patch.columns if c != key], F.lit(True).alias("__wm_in"))
    joined = base.join(named, key, "full" if create_missing else "left")
    columns = [F.coalesce(f"__wm_{c}", c).alias(c) if c != key and c in patch.columns else F.col(c) for c in base.columns]
    return joined.select(*columns, *[F.col(f"__wm_{c}").alias(c) for c in new])


def delete(base: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return base.join(gone.select(key), key, "left_anti")


def two_phase_delete(base: DataFrame, stale: Column, key: str, status: str, source: str = "MANAGER") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows marked DROPPED, rows left, DELETE events): first mark, so that readers of the table drop what they hold, then delete and tell."""
    going = base.filter(F.coalesce(stale, F.lit(False)))
    marked = going.withColumn(status, F.lit("DROPPED"))
    events = going.select(F.col(key).alias("objectId"), F.lit("DELETE").alias("action"), F.lit(None).cast("string").alias("supersededBy"), F.lit(source).alias("source"))
    return marked, base.filter(~F.coalesce(stale, F.lit(False))), events


class KeyedSink:
    """Keeps a keyed table of Parquet files for `foreachBatch`: each batch is merged once, by its number.

    Keys lie in buckets by their hash, and a batch re-writes the buckets that it touches, no others. A version is a small file that
    says which write each bucket's rows are in; it is made by one rename after all rows are written, so readers see a version whole or
    not at all. A batch that is run again after a failure finds its version and changes nothing. The number of buckets can't change
    later. What no kept version refers to is deleted."""

    def __init__(self, folder: str, key: str, merge: Callable[[DataFrame, DataFrame, str], DataFrame] | None = None, keep: int = 3, buckets: int = 64) -> None:
        self.folder, self.key, self.keep, self.buckets = folder.rstrip("/"), key, max(1, keep), buckets
        self.merge = merge or (lambda base, rows, k: partial_update(base, rows, k, create_missing=True))

    def _files(self, spark: SparkSession):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return path, path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, spark: SparkSession) -> Sequence[int]:
        path, fs = self._files(spark)
        folder = path(f"{self.folder}/versions")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()) if fs.exists(folder) else []

    def manifest(self, spark: SparkSession, version: int) -> dict[int, int]:
        """Bucket to the number of the write that has its rows."""
        text = spark.read.text(f"{self.folder}/versions/{version}").collect()
        return {int(k): n for r in text for k, n in json.loads(r[0]).items()}

    def _read(self, spark: SparkSession, manifest: dict[int, int]) -> DataFrame | None:
        paths = [f"{self.folder}/rows/write={n}/bucket={k}" for k, n in sorted(manifest.items())]
        return spark.read.option("mergeSchema", "true").parquet(*paths) if paths else None

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """The last version; before: the last one of an earlier batch, for a batch that may have been written in part."""
        versions = [v for v in self.versions(spark) if before is None or v < before]
        return self._read(spark, self.manifest(spark, versions[-1])) if versions else None

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        versions = self.versions(spark)
        if versions and versions[-1] >= number:
            return
        before = self.manifest(spark, versions[-1]) if versions else {}
        bucket = F.pmod(F.xxhash64(field(self.key)), F.lit(self.buckets)).cast("int")
        touched = {r[0] for r in batch.select(bucket).distinct().collect()}  # `buckets` numbers at most
        base = self._read(spark, {k: n for k, n in before.items() if k in touched})
        merged = batch if base is None else self.merge(base, batch, self.key)
        merged = merged.withColumn("bucket", bucket)
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/rows/write={number}")
        path, fs = self._files(spark)
        written = [s.getPath().getName() for s in fs.listStatus(path(f"{self.folder}/rows/write={number}"))]
        now = {k: n for k, n in before.items() if k not in touched} | {int(w.removeprefix("bucket=")): number for w in written if w.startswith("bucket=")}
        draft = path(f"{self.folder}/versions/_{number}")
        out = fs.create(draft, True)
        out.write(json.dumps(now).encode())
        out.close()
        fs.rename(draft, path(f"{self.folder}/versions/{number}"))
        self._clean(spark, [*versions, number])

    def _clean(self, spark: SparkSession, versions: list[int]) -> None:
        path, fs = self._files(spark)
        kept = [self.manifest(spark, v) for v in versions[-self.keep :]]
        needed = {(n, k) for m in kept for k, n in m.items()}
        for old in versions[: -self.keep]:
            for k, n in self.manifest(spark, old).items():
                if (n, k) not in needed:
                    fs.delete(path(f"{self.folder}/rows/write={n}/bucket={k}"), True)
            fs.delete(path(f"{self.folder}/versions/{old}"), True)
