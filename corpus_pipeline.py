"""Corpus pipeline: toxicity, line dedup, near-duplicates, substring dedup, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is written as Parquet and
read again before the next. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertloom.llm import lines, packing, similar, substrings, toxicity
from alertloom.llm.common import cut, scratch_path, ship, table

#: Words of the shortest passage that substring dedup removes: what repeats over 50 words goes, stock phrases stay.
PASSAGE = 50
#: Likewise for the near-duplicate stage: five words, a similarity of 0.8 or more.
SHINGLE, SIMILAR = 5, (80, 100)
#: Rows of a batch that goes to Python, at most.
ARROW_ROWS, BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
#: SQL can't express the trained classifier of the first stage.
ORACLE_SQL = None


def begin(spark: SparkSession) -> None:
    """Ship the package; rows go to Python at most BATCH at a time, as a batch of whole texts is held by the JVM and by its worker."""
    ship(spark)
    rows = int(spark.conf.get(ARROW_ROWS))
    if not 0 < rows <= BATCH:
        spark.conf.set(ARROW_ROWS, str(BATCH))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; its labels are those of sf_dir. Null and empty texts are scored like others; without labels all stay."""
    begin(spark)
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    inner = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    at = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    kept = toxicity.with_score(inner.withColumn("text", F.col(at["text"])), model).where(F.col("score") < toxicity.THRESHOLD)
    return kept.select(*[F.col(at[c]).alias(c) for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines of 10 characters or more that a smaller id holds. Null texts stay null; rows of one id keep their common lines."""
    begin(spark)
    return lines.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id. Null and blank texts have no copies and stay; rows that repeat an id go only by their own texts."""
    begin(spark)
    return similar.keep_one(docs, SHINGLE, *SIMILAR)


def dedup_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without passages of PASSAGE words or more that a smaller id holds; texts that lose none, null ones among them, are unchanged."""
    begin(spark)
    return substrings.dedup_substrings(docs, PASSAGE)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; a null text is one piece, the closing id; an empty table gives no rows."""
    begin(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("substring_dedup", dedup_substrings),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"{scratch_path(spark)}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
