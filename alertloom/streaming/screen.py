"""Structured Streaming: folders of name files in, audited alerts out, each pair once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import vocab as v
from ..operators.mutate import candidates
from ..plans.assign import as_alerts, pair_key
from ..sources.names import clean, write_alerts


def name_stream(spark: SparkSession, folder: str, column: str = "name") -> DataFrame:
    """Cleaned names from CSV files with one name column, as they arrive."""
    raw = spark.readStream.schema(f"`{column}` string").option("header", True).option("escape", '"').csv(folder)
    return raw.select(clean(F.col(column)).alias("client_name")).where("client_name is not null")


def alert_stream(names: DataFrame, codes: list[str], event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Candidates of stateless codes; pairs met before are dropped.

    With an event time what was seen is kept for the delay only; without one it is kept for good, so a stream without
    end needs an event time.
    """
    whole = None
    for code in codes:
        one = candidates(names, code)
        whole = one if whole is None else whole.unionByName(one)
    keyed = whole.withColumn("pair_key", pair_key(F.col("client_name"), F.col("hit_name")))
    if event_time:
        return as_alerts(keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["pair_key"]))
    return as_alerts(keyed.dropDuplicates(["pair_key"]))


def write_stream(alerts: DataFrame, folder: str, checkpoint: str, rows_per_file: int = 250) -> StreamingQuery:
    """Each micro-batch as CSV files of at most rows_per_file rows in a folder of its own, named by its number: a batch that runs again after a restart takes its own place."""

    def emit(df: DataFrame, batch: int) -> None:
        write_alerts(df, f"{folder}/batch={batch}", rows_per_file=rows_per_file)

    return alerts.select(*v.OUTPUT).writeStream.foreachBatch(emit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
