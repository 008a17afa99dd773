r"""Line dedup in DataFrame functions only.

Every line's key is hashed (two 64-bit xxhash values); the hashes are range-partitioned and sorted by
document and position, so that one pass over a partition meets the first holder of each key first. The
result of the operator is not text but a run-length-compressed keep bitmap per document: `keep`, the runs
(start, len) of lines that stay.

A key that holds a quarter of what a range holds on average, or one part in HEAVY of all lines, can't stand in one
range: such keys, at most the greater of HEAVY and 4 * ranges of them, so a broadcast of a proven size, get their
first holder by a grouped minimum with partial sums instead, and the rows of a hot key never move to one task.

Defined cases: null text is one empty line; a null doc_id counts as the smallest id; rows that repeat a
doc_id are one document for the count of holders, and each row is returned; an empty table gives an empty
result; other columns are ignored, or kept by `dedup_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut, id_column, parts, table

MIN_CHARS = 10
HEAVY = 1024
BLANK = r"[\x20\x09-\x0D]+"


def line_key(line: Column) -> Column:
    return ascii_lower(F.regexp_replace(F.regexp_replace(line, f"^{BLANK}", ""), f"(?<![\\x20\\x09-\\x0D]){BLANK}\\z", ""))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_runs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(_id, _row, drops): for each document row that loses lines, the sorted runs (start, len) that go; _row is a hash of the text."""
    spark = docs.sparkSession
    rows = docs.select(id_column("doc_id").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_row"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keyed = rows.select("_id", "_row", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    lines = cut(keyed.select("_id", "_row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2")))
    total, most = lines.count(), max(HEAVY, 4 * parts(spark))
    heavy = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("_id").alias("first")).where(F.col("n") * most > total).select("h1", "h2", "first")
    heavy = F.broadcast(cut(heavy))
    cold = lines.join(heavy, ["h1", "h2"], "left_anti").repartitionByRange(parts(spark), "h1", "h2")
    order = Window.partitionBy("h1", "h2").orderBy("_id", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cold = cold.withColumn("first", F.first("_id").over(order))
    lost = cold.select("_id", "_row", "pos", "first").unionAll(lines.join(heavy, ["h1", "h2"]).select("_id", "_row", "pos", "first")).where("_id > first").select("_id", "_row", "pos").distinct()
    at = F.row_number().over(Window.partitionBy("_id", "_row").orderBy("pos"))
    runs = lost.withColumn("island", F.col("pos") - at).groupBy("_id", "_row", "island").agg(F.min("pos").alias("start"), F.count("*").cast("int").alias("len"))
    return runs.groupBy("_id", "_row").agg(F.array_sort(F.collect_list(F.struct("start", "len"))).alias("drops"))


def with_keep(docs: DataFrame, min_chars: int = MIN_CHARS, columns: list[str] | None = None) -> DataFrame:
    """docs with _n_lines, _n_dropped and _keep, the runs of lines that stay, in order."""
    drops = drop_runs(docs, min_chars)
    out = docs.select(*[F.col(f"`{c}`") for c in columns or docs.columns], id_column("doc_id").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_row"))
    out = out.join(drops, ["_id", "_row"], "left").withColumn("_n_lines", F.size(_lines(F.col("text"))))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("_n_lines").alias("len")))
    end = F.array(F.struct(F.col("_n_lines").alias("start"), F.lit(0).alias("len")))
    stops = F.concat("drops", end)
    gaps = F.transform(stops, lambda d, i: F.struct(F.when(i == 0, 0).otherwise(F.get("drops", i - 1)["start"] + F.get("drops", i - 1)["len"]).alias("start"), d["start"].alias("stop")))
    keep = F.transform(F.filter(gaps, lambda g: g["stop"] > g["start"]), lambda g: F.struct(g["start"].alias("start"), (g["stop"] - g["start"]).alias("len")))
    return out.withColumns({"_n_dropped": F.coalesce(F.aggregate("drops", F.lit(0), lambda s, d: s + d["len"]), F.lit(0)), "_keep": F.when(F.col("drops").isNull(), whole).otherwise(keep)}).drop("drops", "_id", "_row")


def kept_text() -> Column:
    lines = _lines(F.col("text"))
    return F.when(F.col("_n_dropped") == 0, F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.flatten(F.transform("_keep", lambda r: F.slice(lines, r["start"] + 1, r["len"]))), "\n"))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The operator: doc_id, n_lines, n_dropped, keep (array of start, len) for every row of docs."""
    got = with_keep(docs, min_chars, ["doc_id", "text"])
    return got.select("doc_id", F.col("_n_lines").cast("long").alias("n_lines"), F.col("_n_dropped").cast("long").alias("n_dropped"), F.col("_keep").alias("keep"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with the kept text and its n_chars, all columns of docs."""
    inner = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # own names, so that none of docs can clash
    at = {c: F.col(f"c{k}") for k, c in enumerate(docs.columns)}
    got = with_keep(inner.withColumns({"doc_id": at["doc_id"], "text": at["text"]}), min_chars)
    same = F.col("_n_dropped") == 0
    new = {"text": F.when(same, at["text"]).otherwise(kept_text())}
    if "n_chars" in at:
        new["n_chars"] = F.when(same, at["n_chars"]).otherwise(F.length(kept_text()).cast("long"))
    return got.select(*[new.get(c, at[c]).alias(c) for c in docs.columns])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = with_keep(table(spark, sf_dir, "documents"), MIN_CHARS, ["doc_id", "text"])
    return got.select("doc_id", F.col("_n_lines").cast("long").alias("n_lines"), F.col("_n_dropped").cast("long").alias("n_dropped"), F.sha2(kept_text(), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
m AS (SELECT key, min(doc_id) AS first, count(DISTINCT doc_id) AS n FROM k WHERE length(key) >= 10 GROUP BY key),
j AS (SELECT k.*, coalesce(m.n >= 2 AND k.doc_id <> m.first, false) AS gone FROM k LEFT JOIN m ON k.key = m.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
