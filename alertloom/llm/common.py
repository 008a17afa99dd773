"""Shared helpers: scratch tables in the shared folder, hashing, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null id inside the operators: a null id counts as the smallest one.
NULL_ID = -(2**63)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Scratch tables by application, for `clear_scratch`.
_MADE: dict[str, list[str]] = {}


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, wherever they start."""
    import shutil
    from pathlib import Path

    sc = spark.sparkContext
    if getattr(sc, "_alertloom_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    to = tempfile.mkdtemp(prefix="package-")
    sc.addPyFile(shutil.make_archive(f"{to}/alertloom", "zip", root, "alertloom"))
    sc._alertloom_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only where that setting is unset and the session is local (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="scratch-")
        spark.sparkContext.setCheckpointDir(f"file://{named}")
    return named.rstrip("/")


def cut(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write df once to the shared scratch folder and read it back, so that later jobs don't run its plan again."""
    path = path or scratch_path(df.sparkSession)
    _MADE.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/tables/{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> int:
    """Remove what this application has written by `cut`, once results that read it are written; how many tables there were."""
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    for path in made:
        drop_scratch(spark, path)
    return len(made)


def drop_scratch(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_column(name: str) -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def id_back(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(NULL_ID))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def mix(a: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor, shift, multiply) on uint64 arrays."""
    a = a ^ (a >> np.uint64(32))
    a = a * np.uint64(0xD6E8FEB86659FD93)
    a = a ^ (a >> np.uint64(32))
    a = a * np.uint64(0xD6E8FEB86659FD93)
    return a ^ (a >> np.uint64(32))


def runs_of(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """64-bit hashes of every run of n consecutive entries, by doubling; empty if there are fewer than n."""
    if len(hashes) < n:
        return hashes[:0]
    odd = np.uint64(0x9E3779B97F4A7C15 + 2 * seed)
    out, have, level, width, left = None, 0, mix(hashes + np.uint64(seed)), 1, n
    count = len(hashes) - n + 1
    while left:
        if left & 1:
            part = level[have : have + count]
            out = part if out is None else mix(out * odd + part)
            have += width
        left >>= 1
        if left:
            level = mix(level[: len(level) - width] * odd + level[width:])
            width *= 2
    return out


def dealt(bucket: np.ndarray, shares: int, columns: list[np.ndarray], packs: list) -> list[tuple]:
    """(share, packed columns) for rows sorted by bucket."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(shares + 1))
    columns = [c[order] for c in columns]
    return [(p, *(f(c[lo:hi]) for f, c in zip(packs, columns, strict=True))) for p, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)) if hi > lo]


def raw(dtype: str):
    return lambda a: a.astype(dtype).tobytes()


def trim() -> None:
    """Give memory that a worker has freed back to the system; idle workers stay beside those of later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def trimmed(run):
    """run, a function over batches, that trims when it has ended."""

    @functools.wraps(run)
    def whole(batches):
        yield from run(batches)
        trim()

    return whole


KINDS = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}


def packed_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, (_, k) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


def flat(schema: str, *columns: np.ndarray) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({n: pa.array(c.astype({"long": np.int64, "int": np.int32}[k])) for (n, k), c in zip(fields, columns, strict=True)})


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that an edge names.

    Alternates large-star and small-star steps until a round changes nothing; every round is a
    grouped minimum and a join, written to the shared scratch folder, and nothing is collected but
    two sums. Nulls and self loops link nothing; repeated edges count once.
    """
    spark = edges.sparkSession
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u > v").distinct()
    before, old = None, None
    path = scratch_path(spark)
    e = cut(e, path)
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(joined.select("u", F.col("m").alias("v")))
        old, path = path, scratch_path(spark)
        e = cut(small.where("u > v").distinct(), path)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_scratch(spark, old)
        if now == before or now[0] == 0:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


FILTER_BITS = 1 << 23


def id_filter(ids: DataFrame, column: str, bits: int = FILTER_BITS):
    """A predicate Column maker for long ids, from a bitmap of fixed size: true for every id in `ids`, and for few others.

    It only spares later joins rows; where it fills up, it lets more through and results stay the same.
    """
    slot = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(bits))
    rows = ids.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m")).collect()
    whole = np.zeros(bits // 8 + 8192, np.uint8)
    for r in rows:  # bucket 1 holds the values 1 to 32768; bucket 0 only the value 0
        at = 4096 * r["b"]
        whole[at : at + 4096] = np.frombuffer(r["m"], np.uint8)
    shared = ids.sparkSession.sparkContext.broadcast(whole.tobytes())

    @F.pandas_udf("boolean")
    def hit(bucket: pd.Series, position: pd.Series) -> pd.Series:
        held = np.frombuffer(shared.value, np.uint8)
        b, p = bucket.to_numpy().astype(np.int64), position.to_numpy().astype(np.int64)
        return pd.Series((held[4096 * b + p // 8] >> (p % 8).astype(np.uint8) & 1).astype(bool))

    def test(name: str) -> Column:
        s = F.pmod(F.xxhash64(F.col(name).cast("long")), F.lit(bits))
        return hit(F.bitmap_bucket_number(s), F.bitmap_bit_position(s))

    return test
