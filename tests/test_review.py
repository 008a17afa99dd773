"""Reviews cost the same for each row: no step is made more than once a row, and rows go to all tasks."""

import re

from pyspark.sql import functions as F

from alertloom import queries
from alertloom.functions import strings as s
from alertloom.operators import review

SMALL = "/root/testdata/sf0.001"
ANSWER = "client_name string, hit_name string, content string, target_decision string, fallback_code string, enforce_code string, enforce_decision string"


def calls(df, name):
    return len(re.findall(rf"\b{name}\(", df._jdf.queryExecution().optimizedPlan().toString()))


def test_each_step_of_a_review_is_in_the_plan_once(spark, tmp_path):
    spark.createDataFrame([("Ali Khan", "Ali Kahn", "{}", None, None, None, None)], ANSWER).write.parquet(str(tmp_path / "t"))
    got = review.normalise(spark.read.parquet(str(tmp_path / "t")))
    assert calls(got, "try_variant_get") == len({*review.THINKING_NAMES, *review.CODE_NAMES, *review.MATCHING_NAMES, "decision"})
    # one of the content, two of its fence, three of the code, two of the reasoning
    assert calls(got, "regexp_replace") == 8
    assert calls(got, "upper") == 1 and calls(got, "regexp_extract_all") == 2


def test_overlap_of_repeated_words_names_each_text_once(spark):
    df = spark.createDataFrame([("Ali ali KHAN", "Khan Ali KHAN Osei ali", "Khan Ali"), ("A B", "C D", "C D"), (None, "C D", "C D"), ("A", None, None), ("A", "", "")], "c string, h string, want string")
    got = df.select("want", s.overlap(F.col("c"), F.col("h")).alias("o"))
    assert calls(got, "regexp_extract_all") == 2
    assert all(r.want == r.o for r in got.collect())


def test_pairs_of_one_small_file_go_to_all_tasks(spark):
    rows = queries.pairs(spark, SMALL)
    used = rows.groupBy(F.spark_partition_id().alias("task")).count()
    assert used.count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "Broadcast" not in rows._jdf.queryExecution().executedPlan().toString()


def test_pairs_keep_their_rows(spark):
    names = {r.k: r.client_name for r in queries.pool(spark, SMALL).collect()}
    got = {r.k: r for r in queries.pairs(spark, SMALL).collect()}
    assert set(got) == {k for k in names if k + 1 in names}
    assert all(r.client_name == names[k] and (k % 7 < 6 or r.hit_name == names[k + 1]) for k, r in got.items())


def test_a_fallback_makes_each_step_of_its_review_once(spark, tmp_path):
    spark.createDataFrame([("Ali Khan", "Ali Kahn", "{}", None, "DISP_MINOR_TYPO", None, None, "rule", "rule text")], f"{ANSWER}, rule_matching string, rule_thinking string").write.parquet(str(tmp_path / "t"))
    got = review.or_fallback(spark.read.parquet(str(tmp_path / "t")))
    assert calls(got, "regexp_replace") == 8 and calls(got, "upper") == 1 and calls(got, "regexp_extract_all") == 2
    assert [(r.created_by, r.disposition_code, r.matching_text) for r in got.collect()] == [("rule_based", "DISP_MINOR_TYPO", "rule")]
