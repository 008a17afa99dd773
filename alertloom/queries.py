"""Queries over the driver's tables, one per operator; their SQL twins are in `oracle`."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import strings as s
from .functions import vocab as v
from .operators import audit, capability, mutate, review
from .oracle import GIVEN, MIDDLE, ORACLE_SQL, SURNAME
from .plans import assign, pipeline, quotas
from .sources import model
from .sources import names as src
from .sources.scratch import cut, scratch_dir


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k"))


def name_of(k: Column) -> Column:
    at = lambda xs, i: F.get(s.words(xs), (i % len(xs)).cast("int"))
    mid = F.when(k % 12 == 0, F.concat(at(v.ALPHABET, F.floor(k / 12)), F.lit(". "))).when(k % 3 == 0, F.concat(at(MIDDLE, F.floor(k / 3)), F.lit(" "))).otherwise("")
    return F.concat(at(GIVEN, k), F.lit(" "), mid, at(SURNAME, 7 * k + 3))


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, client_name): a name for each customer, as a pure function of its key."""
    return keys(spark, sf_dir).select("k", name_of(F.col("k")).alias("client_name"))


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pool(spark, sf_dir).select("client_name").distinct()


def raw_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, raw): the pool as sources write it: inverted, titled, in one case, or as a firm."""
    n, k = F.col("client_name"), F.col("k")
    t = s.tokens(n)
    raw = F.when(k % 6 == 0, F.concat(F.upper(s.last(t)), F.lit(", "), s.joined(s.before_last(t)))).when(k % 6 == 1, F.concat(F.lit("Dr. "), n, F.lit(" Jr."))).when(k % 6 == 2, F.lower(n)).when(k % 6 == 3, F.concat(n, F.lit(" Trading LLC"))).when(k % 6 == 4, F.concat(F.lit('  "'), n, F.lit('" '))).otherwise(n)
    return pool(spark, sf_dir).select("k", raw.alias("raw"))


def _on(make: Callable[[DataFrame], DataFrame], source=pool):
    return lambda spark, sf_dir: make(source(spark, sf_dir))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, client_name, hit_name, disposition_code, decision): labelled pairs, some of them wrongly, for audits.

    A pair costs far more than its key, so keys are dealt to all tasks, however many the file splits into, and names made after.
    """
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = keys(spark, sf_dir).repartition(n, "k")
    nxt = keys(spark, sf_dir).select((F.col("k") - 1).alias("k")).repartition(n, "k")
    rows = rows.join(nxt.hint("merge"), "k").select("k", name_of(F.col("k")).alias("client_name"), name_of(F.col("k") + 1).alias("other"))
    t = s.tokens(F.col("client_name"))
    hit = F.when(F.col("k") % 7 == 0, F.col("client_name")).when(F.col("k") % 7 == 1, s.joined(F.concat(F.slice(t, -1, 1), s.before_last(t)))).when(F.col("k") % 7 == 2, F.concat("client_name", F.lit("e"))).when(F.col("k") % 7 == 3, F.replace("client_name", F.lit("-"), F.lit(" "))).when(F.col("k") % 7 == 4, F.concat(s.joined(s.before_last(t)), F.lit(" Osei"))).when(F.col("k") % 7 == 5, F.concat_ws(" ", t[0], s.last(t))).otherwise(F.col("other"))
    code = F.get(s.words([*v.CODES, "X"]), (F.floor(F.col("k") / 7) % 14).cast("int"))
    return rows.select("k", "client_name", hit.alias("hit_name"), code.alias("disposition_code"), F.coalesce(s.decision_of(code), F.lit(v.DISQUALIFY)).alias("decision"))


def _mutation(code: str):
    return _on(lambda df: mutate.candidates(df, code), clients)


def balanced_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: pool -> plan -> pools -> candidates -> audited, unique, ranked -> alerts."""
    return pipeline.balanced(clients(spark, sf_dir), quotas.plan_quotas(spark, 260, 120))


def deterministic_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three codes of one variant each, in quotas by largest remainder, pairs unique, ranked by hash."""
    wanted = {"DISP_EXACT_NAME_MATCH": 20, "DISP_TOKEN_ORDER_SWAP": 20, "DISP_GIVEN_NAME_GENDER_VARIANT": 15}
    names = clients(spark, sf_dir)
    found = None
    for code in wanted:
        one = assign.audited(mutate.candidates(names, code), code)
        found = one if found is None else found.unionAll(one)
    plan = spark.createDataFrame(sorted(wanted.items()), "code string, quota long")
    return assign.as_alerts(assign.fill(cut(assign.unique_pairs(cut(found), wanted)), plan))


def weighted(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, float(1 + k % 4)) for k, c in enumerate(v.CODES)], "code string, weight double")


def apportion_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.count("*").alias("n"))
    even = spark.createDataFrame([(c, 1.0) for c in v.TRUE_POSITIVE], "code string, weight double")
    return quotas.apportion(even.crossJoin(n), F.col("n")).select("code", "quota")


def apportion_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = spark.read.parquet(f"{sf_dir}/customer.parquet").groupBy((F.col("c_nationkey") % 5).alias("grp")).agg(F.count("*").alias("n"))
    return quotas.apportion(weighted(spark).crossJoin(n), F.col("n"), "grp").select("grp", "code", "quota")


def quota_floors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotas.plan_quotas(spark, 90, 60, {"DISP_MINOR_TYPO": 2.0}, {"DISP_SURNAME_CONFLICT"}, {"DISP_EXACT_NAME_MATCH": 30, "DISP_GIVEN_NAME_GENDER_VARIANT": 5})


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.reserved_exact(clients(spark, sf_dir), 40)


def gender_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capability.gender_clients(clients(spark, sf_dir), 30).where("tier = 1").select("client_name", "gender", F.col("turn").cast("long").alias("turn"))


def model_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as a model may write them, made from the pairs."""
    p = pairs(spark, sf_dir)
    k = F.col("k")
    code = F.get(s.words(["DISP_MINOR_TYPO", "minor typo", "surname-conflict", "middle-name", "typo", "DISP_EXACT_NAME_MATCH"]), (k % 6).cast("int"))
    said = F.get(s.words(["Escalate", "reject", "unsure"]), (k % 3).cast("int"))
    name = F.get(s.words(["thinking", "reasoning", "analysis"]), (F.floor(k / 2) % 3).cast("int"))
    body = F.concat(F.lit('{"'), name, F.lit('":"Names compared'), F.when(k % 4 == 0, ". Therefore: something").otherwise(""), F.lit('","decision":"'), said, F.lit('","disposition_code":"'), code, F.lit('"'), F.when(k % 2 == 0, ',"matching_text":"Ali"').otherwise(""), F.lit("}"))
    content = F.when(k % 10 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k % 10 == 1, F.concat(F.lit("Sure! "), body)).when(k % 10 == 2, "no idea").otherwise(body)
    target = F.when(k % 2 == 0, v.ESCALATE).otherwise(v.DISQUALIFY)
    fallback = F.when(k % 2 == 0, "DISP_MINOR_TYPO").otherwise("DISP_SURNAME_CONFLICT")
    return p.select("k", "client_name", "hit_name", content.alias("content"), target.alias("target_decision"), fallback.alias("fallback_code"), F.when(k % 5 == 0, fallback).alias("enforce_code"), F.when(k % 5 == 0, target).alias("enforce_decision"))


def llm_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = review.normalise(model_answers(spark, sf_dir))
    return got.select("k", "matching_text", "disposition_code", "thinking", "decision", F.col("plausibility").cast("long").alias("plausibility"), F.col("code_fixed").cast("long").alias("code_fixed"), F.col("decision_fixed").cast("long").alias("decision_fixed"), "error")


def llm_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = model_answers(spark, sf_dir).withColumns({"rule_matching": F.lit("rule"), "rule_thinking": F.lit("rule text")})
    return review.or_fallback(rows)


def llm_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.tallies(review.normalise(model_answers(spark, sf_dir)))


def estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return pool(spark, sf_dir).select("k", F.round(quotas.estimate_columns(k * 100, (k % 101).cast("double"), (100 - k % 101).cast("double"), k % 40), 6).alias("seconds"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts written as CSV and read again, through the shared folder."""
    path = f"{scratch_dir(spark)}/csv-{uuid.uuid4().hex}"
    src.write_alerts(deterministic_alerts(spark, sf_dir), path)
    return src.read_alerts(spark, path)


#: Odd entries of a file of names, by the key's remainder.
ODD = ["NA", "", "null", 'Ana "Bo" Li', "Ana, Li\nZoe", "#N/A", "ACME, LLC"]


def csv_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names written as a CSV file with other columns, missing values, quotes and line ends, read by the resolved name column, cleaned, first spelling kept."""
    path = f"{scratch_dir(spark)}/names-{uuid.uuid4().hex}"
    k = F.col("k")
    odd = F.when(k % 11 == 0, F.get(s.words(ODD), (F.floor(k / 11) % len(ODD)).cast("int"))).otherwise(F.col("raw"))
    raw_names(spark, sf_dir).select(k.alias("id"), odd.alias(" Full_Name "), F.lit("x").alias("name2")).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    found = src.read_names(spark, path)
    return found.select(src.clean(F.col("raw")).alias("name")).where("name is not null").groupBy(F.lower("name").alias("folded")).agg(F.count("*").alias("n"))


def streamed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of one code, appended in three parts as a stream's batches are, read again."""
    path = f"{scratch_dir(spark)}/parts-{uuid.uuid4().hex}"
    made = assign.as_alerts(mutate.candidates(clients(spark, sf_dir), "DISP_TOKEN_ORDER_SWAP"))
    for part in range(3):
        src.append_alerts(made.where(F.pmod(F.crc32("client_name"), F.lit(3)) == part), path)
    return src.read_alerts(spark, path).select("client_name", "hit_name", "disposition_label", "thinking")


OPTION_GRID = [
    {}, {"total_samples": 101}, {"total_samples": 33, "tp_percentage": 25.0, "fp_percentage": None}, {"num_true_positives": 40}, {"num_false_positives": 7, "total_samples": 50},
    {"num_true_positives": 12, "num_false_positives": 30, "num_exact_matches": 5, "num_gender_variants": 0}, {"total_samples": 250, "exact_match_percentage": 1.0, "gender_variant_percentage": 3.0},
    {"ollama_percentage": None, "fuzzy_percentage": None, "total_samples": 5}, {"total_samples": 0}, {"tp_percentage": 60.0, "fp_percentage": 60.0}, {"num_true_positives": 3, "num_false_positives": 3, "num_exact_matches": 9},
]


def option_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a grid of options comes to: counts and shares, or an error."""
    rows = []
    for k, told in enumerate(OPTION_GRID):
        try:
            c = quotas.resolve_counts(quotas.Options(**told))
            rows.append((k, c.num_tp, c.num_fp, round(c.tp_pct, 6), c.llm_pct, c.exact, c.gender, False))
        except ValueError:
            rows.append((k, None, None, None, None, None, None, True))
    return spark.createDataFrame(rows, "k long, num_tp long, num_fp long, tp_pct double, llm_pct double, exact long, gender long, error boolean")


def option_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of a weighted run whose weights and excludes come as text, for as many records as there are customers."""
    n = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    o = quotas.Options(total_samples=n, disposition_balance="weighted", disposition_weights='{"DISP_MINOR_TYPO": 3, "DISP_SURNAME_CONFLICT": 0.5}', disposition_exclude=" disp_exact_name_match ,,", num_exact_matches=0, num_gender_variants=0)
    return quotas.resolve_plan(spark, o, quotas.resolve_counts(o)).select("code", "family", "quota")


COLUMN_CASES = [
    (["id", " Client_Name ", "name"], None), (["id", "x"], "x"), (["id", "x"], None), (["a", "FULL_NAME"], "b"), (["HitName", "Individual_Name"], "Individual_Name"), (["name"], "Name"),
]
MODEL_CASES = [
    ("Gemma4:31b Cloud", ["x", "gemma4:31b-cloud"]), ("gemma4:9b", ["llama:1b", "gemma4:31b"]), ("phi", ["tiny-phi:2", "x"]), ("y", ["x"]), ("llama:1b", ["llama:2b", "llama:1b"]),
]
WEIGHTS = '{"DISP_MINOR_TYPO": 3, "DISP_SURNAME_CONFLICT": 0.5}'
LISTS = [" disp_minor_typo, DISP_EXACT_NAME_MATCH ,,", "", "cs_CZ", " fr_FR ,de_DE"]


def _or_null(make: Callable[[], str]) -> str | None:
    try:
        return make()
    except ValueError:
        return None


def column_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(k, src.name_column(columns, wanted)) for k, (columns, wanted) in enumerate(COLUMN_CASES)], "k long, chosen string")


def model_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(k, _or_null(lambda w=wanted, m=models: model.choose_model(w, m))) for k, (wanted, models) in enumerate(MODEL_CASES)], "k long, chosen string")


def parsed_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(sorted(quotas.parse_weights(WEIGHTS).items()), "code string, weight double")


def parsed_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(k, ",".join(sorted(quotas.parse_excludes(x))), ",".join(quotas.parse_locales(x)) if x else None) for k, x in enumerate(LISTS)]
    return spark.createDataFrame(rows, "k long, excludes string, locales string")


def unknown_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether asking for a code's capability is an error."""
    rows = [(c, _or_null(lambda c=c: str(capability.capable(F.col("client_name"), c))) is None) for c in [*v.CODES, "DISP_OTHER", "", "disp_minor_typo"]]
    return spark.createDataFrame(rows, "code string, error boolean")


def merge_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pairs(spark, sf_dir).select("client_name", "hit_name", "disposition_code")
    return audit.merge_first(p.where("disposition_code like 'DISP_M%'"), p).groupBy("disposition_code").agg(F.count("*").alias("n"))


def _lookup(column: str, table: dict) -> Callable:
    """Names whose given name or surname a curated list knows, with each form it lists."""

    def make(df: DataFrame) -> DataFrame:
        t = s.tokens(F.col("client_name"))
        token = t[0] if column == "given" else s.last(t)
        return df.select("client_name", token.alias("token"), F.explode(s.lookup(table, F.lower(token))).alias("form"))

    return _on(make, clients)


def _translit(df: DataFrame) -> DataFrame:
    rows = df.select("client_name", F.posexplode(s.tokens(F.col("client_name"))).alias("pos", "token"))
    return rows.select("client_name", F.col("pos").cast("long").alias("pos"), "token", F.explode(s.lookup(v.ROMANISED, F.lower("token"))).alias("form"))


def C() -> Column:
    return F.col("client_name")


def H() -> Column:
    return F.col("hit_name")


def T() -> Column:
    return s.tokens(C())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "name_clean": _on(lambda d: d.select("k", src.clean(F.col("raw")).alias("name")), raw_names),
    "entity_filter": _on(lambda d: d.select("k", src.is_entity(F.col("raw")).alias("entity")), raw_names),
    "surname_first": _on(lambda d: d.select("k", src.inverted(F.col("raw")).alias("name")), raw_names),
    "title_strip": _on(lambda d: d.select("k", src.without_titles(F.col("raw")).alias("name")), raw_names),
    "case_normalise": _on(lambda d: d.select("p_partkey", s.joined(F.transform(s.tokens(F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))), src.cased)).alias("name")), lambda spark, d: spark.read.parquet(f"{d}/part.parquet")),
    "ci_dedupe": _on(lambda d: src.first_wins(d.select(F.when(F.col("k") % 2 == 0, F.upper(C())).otherwise(C()).alias("name"), F.col("k").alias("ord")), "ord")),
    "pool_union": lambda spark, d: src.first_wins(pool(spark, d).select(C().alias("name"), F.lit(0).alias("rank"), F.col("k").alias("ord")).unionByName(src.world_names(spark).select("name", F.lit(1).alias("rank"), "ord")), "rank", "ord").select("name", F.col("rank").cast("long").alias("rank")),
    "generated_name_accept": _on(lambda d: d.select("k", src.well_formed(F.when(F.col("k") % 3 == 0, F.concat(C(), F.lit(" 2"))).when(F.col("k") % 3 == 1, F.concat(C(), F.lit(" Th.S."))).otherwise(C())).alias("ok"))),
    "label_lookup": _on(lambda d: d.select("k", s.label_of(F.col("disposition_code")).alias("label"), s.decision_of(F.col("disposition_code")).alias("family_decision")), pairs),
    "phonetic_lookup": _lookup("surname", v.PHONETIC),
    "translit_lookup": _on(_translit, clients),
    "gender_lookup": _on(lambda d: d.select("client_name", s.lookup(v.COUNTERPART, s.folded(T()[0])).alias("counterpart"), capability.gender_of(C()).alias("gender")), clients),
    "ascii_fold": _on(lambda d: d.select("client_name", s.folded(C()).alias("folded"), s.strip_marks(C()).alias("stripped")), clients),
    "levenshtein_filter": _on(lambda d: d.select("k", F.levenshtein(s.folded(C()), s.folded(H())).cast("long").alias("distance"), (F.levenshtein(s.folded(C()), s.folded(H()), 2) >= 0).alias("near")), pairs),
    "token_diff": _on(lambda d: d.select("k", F.array_join(F.transform(s.differing(s.tokens(C()), s.tokens(H())), lambda i: i.cast("string")), ",").alias("at"), F.size(s.differing(s.tokens(C()), s.tokens(H()))).cast("long").alias("n")), pairs),
    "overlap_tokens": _on(lambda d: d.select("k", s.overlap(s.strip_marks(C()), s.strip_marks(H())).alias("overlap")), pairs),
    "walk_note": _on(lambda d: d.select("k", s.walk_note(s.tokens(C())[0], s.tokens(H())[0]).alias("given"), s.walk_note(s.last(s.tokens(C())), s.last(s.tokens(H()))).alias("surname"), F.when(F.size(s.tokens(C())) == F.size(s.tokens(H())), s.walk_middle(s.tokens(C()), s.tokens(H()))).alias("middle")), pairs),
    "compose_trace": _on(lambda d: d.select("k", s.compose(C(), H(), F.lit("g"), F.lit("m"), F.lit("s"), F.lit("B."), F.lit("P."), F.col("disposition_code"), F.col("decision")).alias("thinking")), pairs),
    "closure_check": _on(lambda d: d.select("k", audit.closes(F.when(F.col("k") % 2 == 0, s.closure(F.col("disposition_code"), F.col("decision"))).otherwise("Therefore: nothing."), F.col("disposition_code"), F.col("decision")).alias("closes")), pairs),
    "mut_typo": _mutation("DISP_MINOR_TYPO"),
    "mut_order_swap": _mutation("DISP_TOKEN_ORDER_SWAP"),
    "mut_middle_abbrev": _mutation("DISP_MIDDLE_NAME_ABBREVIATED"),
    "mut_middle_expand": _mutation("DISP_MIDDLE_INITIAL_EXPANDED"),
    "mut_middle_omit": _mutation("DISP_MIDDLE_NAME_OMITTED"),
    "mut_phonetic": _mutation("DISP_PHONETIC_SURNAME_DIVERGENCE"),
    "mut_middle_conflict": _mutation("DISP_MIDDLE_NAME_CONFLICT"),
    "mut_surname_swap": _mutation("DISP_SURNAME_CONFLICT"),
    "mut_translit": _mutation("DISP_TRANSLITERATION_VARIANT"),
    "mut_diacritic": _mutation("DISP_DIACRITIC_STRIPPED"),
    "mut_compound": _mutation("DISP_COMPOUND_NAME_RESTRUCTURED"),
    "mut_gender": _mutation("DISP_GIVEN_NAME_GENDER_VARIANT"),
    "mut_exact": _mutation("DISP_EXACT_NAME_MATCH"),
    "gender_pairs": _on(lambda d: d.select("k", mutate.is_gender_pair(C(), F.when(F.col("k") % 2 == 0, F.regexp_replace(C(), "^Daniel ", "Daniela ")).otherwise(H())).alias("gender_pair")), pairs),
    "capability_matrix": _on(lambda d: capability.capability_matrix(d), clients),
    "capacity_report": lambda spark, d: capability.capacity(capability.capability_matrix(clients(spark, d)), quotas.plan_quotas(spark, 9000, 4000)),
    "apportion_even": apportion_even,
    "apportion_weighted": apportion_weighted,
    "quota_floors": quota_floors,
    "pipeline_split": lambda spark, d: quotas.split_sources(quota_floors(spark, d), 0.29).select("code", "quota", "a", "b"),
    "slot_expand": lambda spark, d: quotas.slots(quota_floors(spark, d)),
    "family_totals": lambda spark, d: quotas.split_sources(quota_floors(spark, d), 0.3).groupBy("family").agg(F.sum("quota").alias("quota"), F.sum("a").alias("a"), F.sum("b").alias("b")),
    "sample_without_replacement": sample,
    "gender_interleave": gender_interleave,
    "unique_pairs": deterministic_alerts,
    "balanced_alerts": balanced_alerts,
    "legacy_alerts": lambda spark, d: assign.legacy_alerts(clients(spark, d), 60, 40, 10, num_gender=2),
    "synthesised_names": lambda spark, d: capability.synthesised(spark, clients(spark, d), "DISP_DIACRITIC_STRIPPED", 50),
    "generated_names": lambda spark, d: src.generated_names(spark, 40),
    "csv_names": csv_names,
    "appended_alerts": streamed_names,
    "option_counts": option_counts,
    "column_choice": column_choice,
    "model_choice": model_choice,
    "parsed_weights": parsed_weights,
    "parsed_lists": parsed_lists,
    "unknown_codes": unknown_codes,
    "option_plan": option_plan,
    "audit_pairs": _on(lambda d: audit.audit_pairs(d).select("k", "disposition_code", "problem"), pairs),
    "audit_summary": _on(lambda d: audit.label_report(d).select("disposition_code", "n"), pairs),
    "balance_check": lambda spark, d: audit.balance(pairs(spark, d), quota_floors(spark, d)),
    "category_integrity": _on(audit.integrity, pairs),
    "integrity_verdict": lambda spark, d: audit.integrity_verdict(deterministic_alerts(spark, d), 20, 15),
    "closure_report": _on(lambda d: audit.closure_report(d.withColumn("thinking", F.when(F.col("k") % 3 == 0, "x").otherwise(s.closure(F.col("disposition_code"), F.col("decision"))))), pairs),
    "model_load": lambda spark, d: quotas.split_sources(quota_floors(spark, d), 0.3).agg(F.sum("b").alias("asked")).select("asked", F.lit(quotas.model_load(quotas.resolve_counts(quotas.Options(total_samples=201, disposition_balance="off")), None)).cast("long").alias("free_running")),
    "distribution": _on(audit.distribution, pairs),
    "unique_check": _on(audit.uniqueness, pairs),
    "merge_dedupe": merge_dedupe,
    "llm_normalise": llm_normalise,
    "llm_fallback": llm_fallback,
    "llm_tallies": llm_tallies,
    "llm_prompt": _on(lambda d: d.select("k", review.user_prompt(C(), H(), F.col("decision"), F.when(F.col("disposition_code") != "X", F.col("disposition_code"))).alias("prompt")), pairs),
    "generation_estimate": estimate,
    "csv_roundtrip": csv_roundtrip,
    "distinct_parts": _on(lambda d: d.select(T()[0].alias("part")).distinct().unionAll(d.select(s.last(T()).alias("part")).distinct()).groupBy("part").agg(F.count("*").alias("lists")), clients),
    "first_match": _on(lambda d: d.withColumn("at", F.row_number().over(Window.partitionBy(s.last(T())).orderBy("k"))).where("at = 1").select(s.last(T()).alias("surname"), "k"), pool),
}
__all__ = ["ORACLE_SQL", "QUERIES", "balanced_alerts", "clients", "pairs", "pool"]
