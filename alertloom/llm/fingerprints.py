"""Document fingerprints: a canonical exact digest.

The canonical text is Unicode-normalised (NFKC), case-folded and has each run of blanks as one space; its
128-bit xxhash names a bucket. Texts of one bucket are then compared byte by byte, by the least and the
greatest canonical text of each bucket (partial minima, so a bucket of many copies is summed up before it
moves). Should a bucket hold different texts, edited ones included, each but the first gets a number behind the hash.

Neighbours in descending doc_id come from id ranges: a range keeps its documents, and the first document
of the next range is sent along, so each text moves once.

Defined cases: null text is empty; a null doc_id counts as the smallest; equal ids are ordered by text; a
single document is its own next; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, id_back, id_column, id_filter, parts, table

FOUND = "_id long, n_chars long, edited_sha256 string, h string, d string, eh string, ed string, near_edited double, near_next double"


def canonical(text: str) -> bytes:
    if text.isascii():
        text = text.lower()
    else:
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(text.split()).encode("utf-8", "surrogatepass")


def bucket(canon: bytes, bits: int = 128) -> str:
    """The wide hash in hex; fewer bits serve to test what happens when different texts meet."""
    return f"{xxhash.xxh3_128_intdigest(canon) >> (128 - bits):032x}"


def _digest(canon: bytes) -> str:
    return hashlib.sha256(canon).hexdigest()[:32]


def with_next(docs: DataFrame) -> DataFrame:
    """(bucket, tail, _id, text) where each partition, sorted by bucket, tail, _id descending and text, holds ranges of ids and, as tail, the document that follows each range."""
    spark = docs.sparkSession
    ids = docs.select(id_column("doc_id").alias("_id"))
    n = parts(spark)
    bounds = np.unique(np.array(ids.approxQuantile("_id", [i / n for i in range(1, n)], 0.002) or [0.0]))

    @F.pandas_udf("int")
    def range_of(i: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, i.to_numpy().astype(np.float64), "right").astype(np.int32))

    heads = sorted(ids.groupBy(range_of("_id").alias("b")).agg(F.max("_id").alias("top")).collect(), key=lambda r: -r["top"])
    before = {heads[k]["top"]: heads[k - 1]["b"] for k in range(len(heads))}  # the first one follows the last
    tops, goes = np.array(sorted(before), np.int64), np.array([before[k] for k in sorted(before)], np.int32)

    @F.pandas_udf("int")
    def also(i: pd.Series) -> pd.Series:
        x = i.to_numpy()
        at = np.minimum(np.searchsorted(tops, x), max(0, len(tops) - 1))
        return pd.Series(np.where(tops[at] == x, goes[at], -1) if len(tops) else np.full(len(x), -1, np.int32)).astype("int32")

    rows = docs.select(id_column("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("b", range_of("_id")).withColumn("a", also("_id"))
    to = F.when(F.col("a") < 0, F.array(F.struct("b", F.lit(False).alias("tail")))).otherwise(F.array(F.struct("b", F.lit(False).alias("tail")), F.struct(F.col("a").alias("b"), F.lit(True).alias("tail"))))
    rows = rows.select("_id", "text", F.inline(to))
    return rows.repartitionById(len(bounds) + 1, F.col("b")).sortWithinPartitions("b", "tail", F.desc("_id"), "text")


def _pairs(batches: Iterator[pa.RecordBatch]):
    """(id, text, next text) for each document that isn't a tail."""
    held, over = None, None  # the document that waits for its next; the range that has met its tail
    for batch in batches:
        for b, tail, i, text in zip(batch.column("b").to_pylist(), batch.column("tail").to_pylist(), batch.column("_id").to_pylist(), batch.column("text"), strict=True):
            if tail and over == b:
                continue
            text = text.as_py()
            if held is not None:
                yield (*held, text)
            held, over = (None, b) if tail else ((i, text), None)


def fingerprint_rows(docs: DataFrame, bits: int = 128) -> DataFrame:
    def run(batches):
        out: list[tuple] = []

        def flush():
            cols = list(zip(*out, strict=True)) or [[]] * 9
            s, g, f = pa.string(), pa.int64(), pa.float64()
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (g, g, s, s, s, s, s, f, f), strict=True)], names=[x.split()[0] for x in FOUND.split(", ")])
            out.clear()
            return made

        for i, text, after in _pairs(batches):
            n = len(text)
            edited = text[: n - n // 2] + after[: n // 2]
            c, e, a = canonical(text), canonical(edited), canonical(after)
            out.append((i, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), bucket(c, bits), _digest(c), bucket(e, bits), _digest(e), float(c == e), float(c == a)))
            if len(out) == 4096:
                yield flush()
        yield flush()

    return with_next(docs).mapInArrow(run, FOUND)


def clashing(docs: DataFrame, found: DataFrame, bits: int = 128) -> DataFrame:
    """(h): buckets in which documents' canonical texts differ, compared byte by byte."""
    shared = found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    ids = cut(found.join(shared, "h", "left_semi").select("_id").distinct())
    rows = docs.select(id_column("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text")).where(id_filter(ids, "_id")("_id"))

    def run(batches):
        for b in batches:
            canon = [canonical(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array([bucket(c, bits) for c in canon], pa.string()), pa.array(canon, pa.binary())], names=["_id", "h", "canon"])

    texts = rows.mapInArrow(run, "_id long, h string, canon binary").join(ids, "_id", "left_semi")
    return texts.groupBy("h").agg(F.min("canon").alias("lo"), F.max("canon").alias("hi")).where("lo <> hi").select("h")


def numbers(docs: DataFrame, found: DataFrame, bits: int = 128) -> DataFrame:
    """(h, d, k): for buckets that hold different texts, edited ones included, each text's number k > 0 behind the first. Usually empty."""
    every = found.select("h", "d").unionAll(found.select(F.col("eh").alias("h"), F.col("ed").alias("d")))
    others = every.groupBy("h").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).where("lo <> hi").select("h")
    clash = cut(clashing(docs, found, bits).unionAll(others).distinct())
    if clash.isEmpty():
        return clash.select("h", F.lit("").alias("d"), F.lit(0).alias("k"))
    k = F.row_number().over(Window.partitionBy("h").orderBy("d")) - 1
    return every.join(clash, "h", "left_semi").distinct().withColumn("k", k).where("k > 0")


def fingerprints(docs: DataFrame, bits: int = 128) -> DataFrame:
    found = cut(fingerprint_rows(docs, bits))
    clash = cut(numbers(docs, found, bits))
    named = found.withColumns({"k": F.lit(None).cast("int"), "ek": F.lit(None).cast("int")})
    if not clash.isEmpty():
        named = found.join(clash, ["h", "d"], "left").join(clash.select(F.col("h").alias("eh"), F.col("d").alias("ed"), F.col("k").alias("ek")), ["eh", "ed"], "left")
    name = lambda h, k: F.when(F.col(k).isNull(), F.col(h)).otherwise(F.concat(h, F.lit("."), F.col(k).cast("string")))
    return named.select(id_back("_id").alias("doc_id"), "n_chars", "edited_sha256", name("h", "k").alias("fingerprint"), name("eh", "ek").alias("edited_fingerprint"), "near_edited", "near_next")


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
