"""End to end: names -> plan -> pools -> candidates -> alerts, with reports; and the command line."""

from __future__ import annotations

import argparse
import dataclasses
import math
import time
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab as v
from ..functions.strings import lookup
from ..operators import audit, capability
from ..operators.review import normalise, or_fallback, tallies
from ..sources.model import Chat, HttpChat, answers, discover, list_models
from ..sources.names import load_names, write_alerts
from ..sources.scratch import clear, cut
from . import assign, quotas
from .quotas import Counts, Options


def balanced(names: DataFrame, plan: DataFrame, alpha: float = 1.0, chat: Chat | None = None, batch_size: int = 20, allow_short: bool = False, seed: str = "42", kept: dict | None = None) -> DataFrame:
    """Alerts in the plan's exact numbers. Of each code the first floor(alpha * quota) ranks are rule-based, the rest goes to the model, if there is one."""
    spark = names.sparkSession
    wanted = {r["code"]: r["quota"] for r in plan.collect() if r["quota"] > 0}  # a row per code
    if not wanted:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in v.OUTPUT))
    pool = cut(capability.pools(spark, names, wanted, seed=seed))
    whole: set[str] = set()
    while True:
        found = cut(assign.all_candidates(pool, wanted, seed, whole))
        filled = cut(assign.fill(cut(assign.unique_pairs(found, wanted, seed)), plan))
        missing = assign.shortfall(filled, plan)
        if missing.keys() <= whole:
            break
        whole |= missing.keys()  # short of a part of its clients: take all
    if kept is not None:
        kept["short"] = missing
    if missing and not allow_short:
        raise RuntimeError(f"quotas can't be filled: {', '.join(missing.values())}")
    if chat is None:
        return assign.as_alerts(filled)
    split = F.broadcast(quotas.split_sources(plan, alpha).select("code", "a"))
    placed = filled.join(split, "code")
    ruled = assign.as_alerts(placed.where("slot <= a"))
    asked = placed.where("slot > a").select("client_name", "hit_name", F.col("code").alias("fallback_code"), F.col("code").alias("enforce_code"), F.col("matching_text").alias("rule_matching"), F.col("thinking").alias("rule_thinking"))
    decision = assign.decision_of(F.col("fallback_code"))
    asked = asked.withColumns({"target_decision": decision, "enforce_decision": decision})
    told = cut(normalise(answers(asked, chat, batch_size)))  # once: a model may answer otherwise when asked again
    _keep(kept, told)
    return ruled.unionByName(or_fallback(told, strict=True))


def free_running(names: DataFrame, counts: Counts, chat: Chat | None = None, batch_size: int = 20, seed: str = "42", kept: dict | None = None) -> DataFrame:
    """Alerts of the free-running mode. Of either decision's pairs the first floor(rule share) are rule-based; the rest, with any code of its decision,
    and the reserved cross-gender ones, pinned to theirs, go to the model, if there is one."""
    rows = assign.legacy_rows(names, counts.num_tp, counts.num_fp, counts.exact, seed, counts.gender)
    if chat is None:
        return assign.as_alerts(rows)
    rows = cut(rows)
    alpha = counts.rule_pct / 100.0
    own = lookup({-1: 0, 0: counts.exact, 1: math.floor(alpha * (counts.num_tp - counts.exact)), 2: math.floor(alpha * (counts.num_fp - counts.gender))}, F.col("want"))
    code, decision, pinned = F.col("code"), assign.decision_of(F.col("code")), F.col("want") == -1
    asked = rows.where(F.col("slot") > own).select("client_name", "hit_name", code.alias("fallback_code"), F.when(pinned, code).alias("enforce_code"), F.when(pinned, decision).alias("enforce_decision"), decision.alias("target_decision"), F.col("matching_text").alias("rule_matching"), F.col("thinking").alias("rule_thinking"))
    told = cut(normalise(answers(asked, chat, batch_size)))
    _keep(kept, told)
    return assign.as_alerts(rows.where(F.col("slot") <= own)).unionByName(or_fallback(told, strict=False))


def _keep(kept: dict | None, told: DataFrame) -> None:
    if kept is not None:
        kept["answers"] = told


def run(spark: SparkSession, options: Options, names_csv: str | None = None, column: str | None = None, chat: Chat | None = None, per_locale: int = 150, augment: bool = True, generate: bool = True, kept: dict | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(alerts, plan) for the options; plan is None in free-running mode. Into kept go the answers of the model and the quotas that stay short.

    Without a client all records are rule-based, with a warning if the options leave some to a model.
    """
    counts = quotas.resolve_counts(options)
    plan = quotas.resolve_plan(spark, options, counts)
    names = load_names(spark, names_csv, column, augment, generate, per_locale, quotas.parse_locales(options.faker_locales), options.seed).select(F.col("name").alias("client_name"))
    if names.isEmpty():
        raise ValueError("no usable name in any source")
    if chat is None and (asked := quotas.model_load(counts, plan)):
        warnings.warn(f"no model client: {asked} records that the options leave to a model are rule-based", stacklevel=2)
    if plan is None:
        return free_running(names, counts, chat, options.batch_size, options.seed, kept), None
    return balanced(names, plan, counts.rule_pct / 100.0, chat, options.batch_size, options.allow_disposition_rebalance, options.seed, kept), plan


def verdicts(alerts: DataFrame, counts: Counts, plan: DataFrame | None = None, short: int = 0) -> list[tuple[str, bool, str]]:
    """(audit, passed, details) of a run: a line each. short: records that a run allowed to be short has left out, the tolerance of the balance."""
    n = alerts.count()
    out = [("Strict global uniqueness", (u := audit.uniqueness(alerts).first()).n == u.distinct_pairs, f"{u.distinct_pairs} of {n} pairs")]
    planned = {r["code"]: r["quota"] for r in plan.collect()} if plan is not None else {"DISP_EXACT_NAME_MATCH": counts.exact, "DISP_GIVEN_NAME_GENDER_VARIANT": counts.gender}
    i = audit.integrity_verdict(alerts, planned.get("DISP_EXACT_NAME_MATCH", 0), planned.get("DISP_GIVEN_NAME_GENDER_VARIANT", 0)).first()
    out.append(("Category integrity", i.ok, f"exact {i.exact_planned}/{i.exact_emitted}, cross-gender {i.gender_planned}/{i.gender_emitted} (planned/emitted)"))
    if plan is not None:
        off = [f"{r.disposition_code} {r.planned}/{r.emitted}" for r in audit.balance(alerts, plan, short).where("not ok").collect()]
        out.append(("Disposition balance", not off, ", ".join(off) or (f"{short} records short, as allowed" if short else "as planned")))
    for name, found in (("Label semantics", audit.label_report(alerts)), ("Thinking closure", audit.closure_report(alerts))):
        bad = [f"{r.disposition_code}: {r.n} (e.g. {r.example})" for r in found.collect()]  # a row per code
        out.append((name, not bad, "; ".join(bad)))
    return out


def metrics(alerts: DataFrame, seconds: float, kept: dict, strict: bool = True) -> dict[str, float]:
    """Figures of a run: records by origin, fallbacks, corrections of labels, records left out, records a second."""
    by = {r["created_by"]: r["count"] for r in alerts.groupBy("created_by").count().collect()}
    n, asked = sum(by.values()), kept.get("answers")
    out = {"records": n, "seconds": round(seconds, 2), "records_per_second": round(n / max(seconds, 1e-9), 2), "rule_based": by.get("rule_based", 0), "model": by.get("ollama", 0)}
    if asked is not None:
        out |= {"fallbacks": asked.count() - by.get("ollama", 0)} | tallies(asked, strict).first().asDict()
    return out | {"short": sum(int(x.split(": ")[1].split(" of ")[1]) - int(x.split(": ")[1].split(" of ")[0]) for x in kept.get("short", {}).values())}


def report(alerts: DataFrame, plan: DataFrame | None = None) -> dict[str, DataFrame]:
    out = {"labels": audit.label_report(alerts), "closure": audit.closure_report(alerts), "integrity": audit.integrity(alerts), "distribution": audit.distribution(alerts), "unique": audit.uniqueness(alerts)}
    return out | ({"balance": audit.balance(alerts, plan)} if plan is not None else {})


#: Options under which more than one name is known.
ALIASES = {"total_samples": ["-n"], "num_true_positives": ["-tp"], "num_false_positives": ["-fp"]} | {f"{k}_percentage": [f"--{k}_pct"] for k in ("tp", "fp", "ollama", "fuzzy", "exact_match", "gender_variant")}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="alertloom", description="Build name-screening alerts.")
    for f in dataclasses.fields(Options):
        kind = str if "str" in str(f.type) else float if "float" in str(f.type) else int
        if f.name == "allow_disposition_rebalance":
            p.add_argument("--allow_disposition_rebalance", action=argparse.BooleanOptionalAction, default=f.default)
        else:
            p.add_argument(f"--{f.name}", *ALIASES.get(f.name, []), type=kind, default=f.default, choices=("even", "weighted", "off") if f.name == "disposition_balance" else None)
    p.add_argument("--input_csv_path", default="sdn.csv")
    p.add_argument("--name_column")
    p.add_argument("--augment_diversity", action=argparse.BooleanOptionalAction, default=True)
    p.add_argument("--faker_names", action=argparse.BooleanOptionalAction, default=True)
    p.add_argument("--faker_names_per_locale", type=int, default=150)
    p.add_argument("--ollama_model", default="gemma4:31b Cloud")
    p.add_argument("--model_url", default="http://localhost:11434")
    p.add_argument("--output_csv_path", "-o", default="synthetic_screening_alerts.csv")
    p.add_argument("--single_file", action=argparse.BooleanOptionalAction, default=True, help="one CSV file, written by one task; off for large outputs")
    return p


def main(argv: list[str] | None = None) -> None:
    """One run of the command line: pre-flight checks, alerts, reports. Exits with 1 if records need a model that can't be reached."""
    a = vars(parser().parse_args(argv))
    spark = SparkSession.builder.appName("alertloom").getOrCreate()
    options = Options(**{f.name: a[f.name] for f in dataclasses.fields(Options)})
    counts = quotas.resolve_counts(options)
    plan = quotas.resolve_plan(spark, options, counts)
    total, asked = counts.num_tp + counts.num_fp, quotas.model_load(counts, plan)
    share = 100.0 * asked / total
    print(f"{total} alerts: {counts.num_tp} true and {counts.num_fp} false positives; {asked} for the model ({share:.1f}%), {total - asked} rule-based; about {quotas.estimate(total, 100.0 - share, share, options.batch_size)[1]}")
    chat = None
    if asked:
        try:
            chat = HttpChat(a["model_url"], discover(a["ollama_model"], lambda: list_models(a["model_url"])))
        except (ConnectionError, ValueError) as e:
            print(f"Pre-flight: {e}\nTo go on without a model: --ollama_percentage 0 --fuzzy_percentage 100" + (" --num_gender_variants 0" if counts.gender else ""))
            raise SystemExit(1) from e
    if plan is not None:
        names = load_names(spark, a["input_csv_path"], a["name_column"], a["augment_diversity"], a["faker_names"], a["faker_names_per_locale"], quotas.parse_locales(options.faker_locales), options.seed)
        wanted = {r["code"]: r["quota"] for r in plan.collect()}
        pools = capability.pools(spark, names.select(F.col("name").alias("client_name")), wanted, seed=options.seed)
        thin = capability.capacity(pools, plan).where("short").orderBy("code").collect()  # a row per code
        for r in thin:
            print(f"Pre-flight: {r.code} wants {r.quota}, its {r.pool_size} names yield about {r.capacity}")
        print("" if thin else "Pre-flight: every quota fits its pool")
    kept: dict = {}
    began = time.time()
    alerts, plan = run(spark, options, a["input_csv_path"], a["name_column"], chat, a["faker_names_per_locale"], a["augment_diversity"], a["faker_names"], kept)
    alerts = cut(alerts)
    figures = metrics(alerts, time.time() - began, kept, plan is not None)
    write_alerts(alerts, a["output_csv_path"], a["single_file"])
    for k, x in figures.items():
        print(f"{k}: {x}")
    for name, passed, details in verdicts(alerts, counts, plan, figures["short"]):
        print(f"{name}: {'PASSED' if passed else 'FAILED'}  {details}")
    audit.distribution(alerts).show(50, truncate=100)
    clear(spark)


if __name__ == "__main__":
    main()
