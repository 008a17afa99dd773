import pytest
from pyspark.sql import functions as F

from alertloom.functions import vocab as v
from alertloom.operators import audit, review
from alertloom.plans import assign, pipeline, quotas
from alertloom.plans.quotas import Options
from alertloom.sources import model
from alertloom.sources.names import read_alerts, world_names, write_alerts


def plan(spark, *a, **k):
    return {r.code: r.quota for r in quotas.plan_quotas(spark, *a, **k).collect()}


def test_quotas(spark):
    even = plan(spark, 250, 0)
    assert sorted(even[c] for c in v.TRUE_POSITIVE) == [27] * 2 + [28] * 7 and sum(even.values()) == 250
    run = plan(spark, 50, 50, floors={"DISP_EXACT_NAME_MATCH": 2, "DISP_GIVEN_NAME_GENDER_VARIANT": 2})
    assert {c for c in v.TRUE_POSITIVE if run[c] == 6} == {"DISP_COMPOUND_NAME_RESTRUCTURED", "DISP_DIACRITIC_STRIPPED", "DISP_EXACT_NAME_MATCH", "DISP_MIDDLE_INITIAL_EXPANDED", "DISP_MIDDLE_NAME_ABBREVIATED"}
    assert run["DISP_GIVEN_NAME_GENDER_VARIANT"] == run["DISP_MIDDLE_NAME_CONFLICT"] == 13
    pin = plan(spark, 90, 0, floors={"DISP_EXACT_NAME_MATCH": 30})
    assert pin["DISP_EXACT_NAME_MATCH"] == 30 and sorted(pin[c] for c in v.TRUE_POSITIVE if c != "DISP_EXACT_NAME_MATCH") == [7] * 4 + [8] * 4
    for bad in ({"weights": {"X": 1.0}}, {"weights": {"DISP_MINOR_TYPO": -1.0}}, {"excludes": set(v.TRUE_POSITIVE)}, {"floors": {"DISP_EXACT_NAME_MATCH": 90, "DISP_MINOR_TYPO": 80}}):
        with pytest.raises(ValueError):
            plan(spark, 90, 10, **bad)


def test_counts():
    c = quotas.resolve_counts(Options())
    assert (c.num_tp, c.num_fp, c.exact, c.gender) == (50, 50, 2, 2)
    assert quotas.resolve_counts(Options(total_samples=25)).exact == 0 and quotas.resolve_counts(Options(total_samples=125)).exact == 2
    assert quotas.resolve_counts(Options(num_true_positives=7)).num_fp == 93
    for bad in (Options(ollama_percentage=80.0), Options(total_samples=0), Options(num_exact_matches=60), Options(num_true_positives=200)):
        with pytest.raises(ValueError):
            quotas.resolve_counts(bad)
    assert quotas.parse_weights('{"DISP_MINOR_TYPO": 2}') == {"DISP_MINOR_TYPO": 2.0}
    with pytest.raises(ValueError):
        quotas.parse_weights("{")


def test_estimate():
    assert quotas.estimate(1000, 100, 0, 20)[1] in ("0.1s", "0.05s", "0.0s")
    assert quotas.estimate(100, 26, 74, 20)[1] == "4.9s"
    assert quotas.estimate(90000, 0, 100, 20)[1] == "1.7h 40m"


def test_balanced_alerts_hold_every_promise(spark, tmp_path):
    names = world_names(spark).selectExpr("name AS client_name")
    wanted = quotas.plan_quotas(spark, 27, 12)
    alerts = pipeline.balanced(names, wanted)
    assert alerts.columns == v.OUTPUT
    r = pipeline.report(alerts, wanted)
    assert r["labels"].count() == 0 and r["closure"].count() == 0 and r["balance"].where("not ok").count() == 0
    u = r["unique"].first()
    assert u.n == u.distinct_pairs == 39
    write_alerts(alerts, str(tmp_path / "out"))
    assert sorted(read_alerts(spark, str(tmp_path / "out")).collect()) == sorted(alerts.collect())


def test_legacy_alerts_meet_their_counts_or_raise(spark):
    names = spark.createDataFrame([("Wei Zhang",), ("Ana María López",), ("Omar Haddad",), ("John Fitzgerald Smith",)], "client_name string")
    alerts = assign.legacy_alerts(names, 120, 60, 3)
    n = {(r.decision, r.exact): r["count"] for r in alerts.groupBy("decision", (F.col("client_name") == F.col("hit_name")).alias("exact")).count().collect()}
    assert n == {(v.ESCALATE, True): 3, (v.ESCALATE, False): 117, (v.DISQUALIFY, False): 60}
    assert audit.uniqueness(alerts).first().distinct_pairs == 180
    with pytest.raises(RuntimeError):
        assign.legacy_alerts(spark.createDataFrame([("Cher",)], "client_name string"), 0, 5)


def test_free_running_holds_reserved_genders_and_asks_the_model(spark):
    names = world_names(spark).selectExpr("name AS client_name")
    counts = quotas.resolve_counts(Options(total_samples=60, num_gender_variants=4, num_exact_matches=2, disposition_balance="off"))
    chat = lambda s, u: '{"thinking":"t","decision":"' + ("disqualify" if "conclude with 'disqualify'" in u else "escalate") + '"}'
    gender = F.col("disposition_code") == "DISP_GIVEN_NAME_GENDER_VARIANT"
    for asks in (None, chat):
        got = pipeline.free_running(names, counts, asks).cache()
        assert got.where(gender).count() == 4 and got.where("decision = 'escalate to analyst'").count() == 30 and got.count() == 60
        asked = got.where("created_by = 'ollama'")
        # floor(0.3 * 28) and floor(0.3 * 26) pairs stay with the rules
        assert asked.count() == (28 - 8 + 26 - 7 + 4 if asks else 0) and asked.where(gender).count() == (4 if asks else 0)


def test_balanced_takes_the_rest_of_a_pool_that_was_thinned_too_far(spark, monkeypatch):
    made = [f"{chr(65 + i)}lan {chr(65 + j)}ubin{chr(97 + k)}" for i in range(26) for j in range(26) for k in range(2)]
    names = spark.createDataFrame([(n,) for n in made], "client_name string")
    wanted = spark.createDataFrame([("DISP_TOKEN_ORDER_SWAP", 400)], "code string, quota long")
    few = spark.createDataFrame([(n,) for n in made[:200] * 40], "client_name string")
    assert assign.all_candidates(few.withColumn("code", F.lit("DISP_TOKEN_ORDER_SWAP")), {"DISP_TOKEN_ORDER_SWAP": 40}).count() >= 150
    monkeypatch.setattr(assign, "SPARE", 0)
    assert pipeline.balanced(names, wanted).count() == 400


def test_review(spark):
    rows = [
        (1, "Ali Kan", "Ali Khan", '```json\n{"thinking":"Ok.","decision":"Escalate","disposition_code":"minor typo","matching_text":"Ali"}\n```', None, None),
        (2, "Ali Khan", "Ali Smith", 'Sure! {"reasoning":"Different surnames","decision":"reject"}', None, None),
        (3, "Ali Khan", "Ali Kahn", '{"thinking":"x","decision":"escalate","disposition_code":"DISP_EXACT_NAME_MATCH"}', None, None),
        (4, "Ali Khan", "Ali Kahn", '{"thinking":"x","decision":"disqualify","disposition_code":"DISP_MINOR_TYPO"}', None, None),
        (5, "Ali Khan", "Ali Kahn", '{"thinking":"x","decision":"escalate","disposition_code":"middle-name"}', None, None),
        (6, "Ali Khan", "Ali Kahn", "no", None, None),
        (7, "Ali Khan", "Ali Kahn", None, None, None),
    ]
    df = spark.createDataFrame(rows, "k int, client_name string, hit_name string, content string, fallback_code string, target_decision string").selectExpr("*", "cast(null as string) enforce_code", "cast(null as string) enforce_decision")
    got = {r.k: r for r in review.normalise(df).collect()}
    assert (got[1].disposition_code, got[1].thinking) == ("DISP_MINOR_TYPO", "Ok. Therefore: DISP_MINOR_TYPO -> escalate to analyst.")
    assert (got[2].disposition_code, got[2].matching_text) == ("DISP_SURNAME_CONFLICT", "Ali")
    assert got[2].thinking == "Different surnames. Therefore: DISP_SURNAME_CONFLICT -> disqualify."
    assert (got[3].disposition_code, got[3].plausibility) == ("DISP_MINOR_TYPO", 1)
    assert (got[4].decision, got[4].decision_fixed) == (v.ESCALATE, 1)
    assert got[5].disposition_code == "DISP_MIDDLE_NAME_ABBREVIATED"
    assert got[6].error == got[7].error == "no JSON"


def test_model(spark):
    assert model.choose_model("Gemma4:31b Cloud", ["x", "gemma4:31b-cloud"]) == "gemma4:31b-cloud"
    with pytest.raises(ValueError):
        model.choose_model("y", ["x"])
    with pytest.raises(ConnectionError):
        model.discover("x", lambda: 1 / 0)
    waits = []
    assert model.ask(lambda s, u: 1 / 0, "", "", waits.append) is None and waits == [1.0, 2.0, 3.0]
    pairs = spark.createDataFrame([("Ali Kan", "Ali Khan", v.ESCALATE, "DISP_MINOR_TYPO"), ("A B", "a b", v.ESCALATE, "DISP_MINOR_TYPO")], "client_name string, hit_name string, target_decision string, enforce_code string")
    got = model.answers(pairs, lambda s, u: '{"thinking":"t","decision":"escalate"}').collect()
    assert len(got) == 1 and got[0].content.startswith("{")


def test_stream(spark, tmp_path):
    from alertloom.streaming import screen

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("name\nWei Zhang\nwei zhang\nACME LLC\n")
    alerts = screen.alert_stream(screen.name_stream(spark, str(tmp_path / "in")), ["DISP_TOKEN_ORDER_SWAP", "DISP_EXACT_NAME_MATCH"])
    screen.write_stream(alerts, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    got = read_alerts(spark, str(tmp_path / "out"))
    assert {(r.client_name, r.hit_name) for r in got.collect()} == {("Wei Zhang", "Zhang Wei"), ("Wei Zhang", "Wei Zhang")}
    assert audit.label_report(got).count() == 0


def test_entry_without_llm():
    import __spark_entry__ as e

    assert "balanced_alerts" in e.queries() and set(e.oracle_sql()) <= set(e.queries())
