"""What several operators share: reading the tables, and tables written to the cluster's shared folder."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which every executor and the driver can reach. Where none is set a temporary folder is
    made if all run on one machine (as in tests); on a cluster that is an error."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="waymark-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: its lineage ends there, and a lost executor loses none of it. The table
    stays until `discard` or until the caller clears the folder, as a result that is read later may depend on it."""
    path = f"{shared_dir(df.sparkSession)}/waymark-{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.waymark_path = path
    return found


def discard(table: DataFrame) -> None:
    """Deletes the table of a frame that `stored` gave, once nothing depends on it."""
    context = table.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(table.waymark_path)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: What operators remember in a worker from task to task, by owner: how to forget it.
_REMEMBERED: dict[str, Callable[[], object]] = {}


def remember(owner: str, forget: Callable[[], object]) -> None:
    _REMEMBERED[owner] = forget


def tidy(run: Callable[[Iterable], Iterator], owner: str = "") -> Callable[[Iterable], Iterator]:
    """Of a function on batches: other owners' memories are forgotten and given back to the system when a task begins, as
    its own memory is when it ends, as workers live on and share a machine."""

    @wraps(run)
    def tidied(batches: Iterable) -> Iterator:
        others = [o for o in _REMEMBERED if o != owner]
        for other in others:
            _REMEMBERED.pop(other)()
        if others:
            release()
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def release() -> None:
    """Gives a worker's free memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def give_back(spark: SparkSession) -> None:
    """Lets executors collect their garbage. A heap grows towards its limit with what is dead already and keeps that size, beside the Python
    workers; a full collection shrinks it and frees direct buffers. A task a core, so that every executor gets some; one that
    gets none keeps its memory, and no result depends on it. For the end of a step of a long job, not for small ones."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.expr("reflect('java.lang.System', 'gc')").alias("done")).write.format("noop").mode("overwrite").save()


#: Bytes of a batch of rows for Python. By default a batch has 10 000 rows and up to 64 MB, which with long texts is held several times over.
BATCH = "4m"


def in_small_batches(df: DataFrame) -> DataFrame:
    """Sets the session's batch size for Python, unless its user has set one."""
    name, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if conf.get(name, "67108864b") in ("67108864b", "67108864", "64m", "64MB"):
        conf.set(name, BATCH)
    return df


def mapped(df: DataFrame, run: Callable[[Iterable], Iterator], schema: str, owner: str = "") -> DataFrame:
    """mapInArrow with `tidy` and small batches, for DataFrame.transform."""
    return in_small_batches(df).mapInArrow(tidy(run, owner), schema)


#: Bits of a bitmap: 2**26 bits are 8 MiB, the most that is ever broadcast.
BITS = 1 << 26


def slot(*parts: Column, bits: int = BITS) -> Column:
    """Where a key has its bit; from 1, as the bitmap functions count."""
    return F.pmod(F.xxhash64(*parts), F.lit(bits)) + 1


def bitmap(slots: DataFrame) -> DataFrame:
    """Buckets (b, map) with the bits of all values of column s set. Of a fixed size at most, whatever the rows."""
    return slots.groupBy(F.bitmap_bucket_number("s").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("map"))


def marked(rows: DataFrame, bits_set: DataFrame, at: Column) -> DataFrame:
    """Adds `may`: whether the bit at `at` is set, so that the key may be one of those in the bitmap. No shuffle. Rows have no columns
    named may, slot, bucket or bits."""
    named = bits_set.select(F.col("b").alias("bucket"), F.col("map").alias("bits"))
    joined = rows.withColumn("slot", at).join(F.broadcast(named), F.bitmap_bucket_number("slot") == F.col("bucket"), "left")
    place = F.bitmap_bit_position("slot")
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1))
    return joined.withColumn("may", F.coalesce(bit == 1, F.lit(False))).drop("slot", "bucket", "bits")


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Of an array, at each place the join (associative) of all elements up to it.

    By doubling: a pass over the array for each power of two below its size, so n elements cost n log n joins. (A fold that
    appends to an array copies it for each element.)"""
    n = F.size(values)
    steps = F.when(n > 1, F.sequence(F.lit(0), F.ceil(F.log2(n)).cast("int") - 1)).otherwise(F.array().cast("array<int>"))

    def double(a: Column, k: Column) -> Column:
        gap = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(a, lambda x, i: F.when(i >= gap, join(F.get(a, i - gap), x)).otherwise(x))

    return F.aggregate(steps, values, double)


#: Rows of a stored table up to which it is broadcast (a few hundred bytes each).
FEW = 50_000


def small(table: DataFrame) -> DataFrame:
    """A stored table with the hint to broadcast it if it has few rows, else as it is, for a join that shuffles."""
    return F.broadcast(table) if table.limit(FEW + 1).count() <= FEW else table


#: A key with no more rows than this is never divided.
LIGHT = 200


def even_join(rows: DataFrame, unique: DataFrame, key: str, counts: DataFrame, salt: Column, how: str = "left") -> DataFrame:
    """`rows` joined with `unique`, which has one row a key, where one key may have any share of the rows.

    counts: (key, n), how many rows a key has; only keys that have many need be in it. Keys with more than a `FEW`-th of
    all rows counted (fewer than `FEW` keys, which bounds what is broadcast) are divided: their rows are dealt over parts by the
    hash of `salt`, and their unique row is copied to each part. No part has more than about max(LIGHT, rows / FEW) rows,
    and no adaptive rule is needed. Rows of a null key find nothing."""
    many = stored(counts.select(F.col(key).alias("__wm_key"), F.col("n").alias("__wm_n")).filter(F.col("__wm_n") > LIGHT), "heavy")
    total, most = many.agg(F.sum("__wm_n"), F.max("__wm_n")).first()
    part = max(LIGHT, (total or 0) // FEW)
    if not most or most <= part:
        discard(many)
        return rows.join(unique, key, how)
    heavy = F.broadcast(many.filter(F.col("__wm_n") > part).select("__wm_key", F.ceil(F.col("__wm_n") / part).cast("int").alias("__wm_parts")))
    parts = F.coalesce(F.col("__wm_parts"), F.lit(1))
    dealt = rows.join(heavy, rows[key] == F.col("__wm_key"), "left").withColumn("__wm_part", F.pmod(F.xxhash64(salt), parts).cast("int"))
    copied = unique.join(heavy, unique[key] == F.col("__wm_key"), "left").withColumn("__wm_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.drop("__wm_key", "__wm_parts").join(copied.drop("__wm_key", "__wm_parts"), [key, "__wm_part"], how).drop("__wm_part")


def hashable(df: DataFrame) -> list[Column]:
    """All columns in a form that can be hashed: those that hold a map as JSON text."""

    def has_map(kind: DataType) -> bool:
        if isinstance(kind, StructType):
            return any(has_map(f.dataType) for f in kind.fields)
        return isinstance(kind, MapType) or isinstance(kind, ArrayType) and has_map(kind.elementType)

    return [F.to_json(F.struct(c)) if has_map(f.dataType) else c for c, f in zip(columns_of(df), df.schema.fields, strict=True)]


def columns_of(df: DataFrame) -> list[Column]:
    """All columns by exact name, dots included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
