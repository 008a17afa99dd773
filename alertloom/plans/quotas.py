"""Quota planning: counts from options, largest-remainder apportionment, pinned floors, the A/B split."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vocab as v
from ..sources.names import local_weights

RULES_PER_SECOND = 20_000.0


@dataclass(frozen=True)
class Options:
    """What a run may be told; names follow the command line."""

    total_samples: int | None = None
    num_true_positives: int | None = None
    num_false_positives: int | None = None
    tp_percentage: float | None = 50.0
    fp_percentage: float | None = 50.0
    ollama_percentage: float | None = 70.0
    fuzzy_percentage: float | None = 30.0
    num_exact_matches: int | None = None
    num_gender_variants: int | None = None
    exact_match_percentage: float = 2.0
    gender_variant_percentage: float = 2.0
    disposition_balance: str = "even"
    disposition_weights: str | None = None
    disposition_exclude: str | None = None
    faker_locales: str | None = None
    batch_size: int = 20
    allow_disposition_rebalance: bool = False
    seed: str = "42"


@dataclass(frozen=True)
class Counts:
    num_tp: int
    num_fp: int
    tp_pct: float
    fp_pct: float
    llm_pct: float
    rule_pct: float
    exact: int
    gender: int


def _complement(one: float | None, other: float | None, default: tuple[float, float], what: str) -> tuple[float, float]:
    if one is not None and other is not None:
        if abs(one + other - 100.0) > 0.01:
            raise ValueError(f"{what} percentages {one} and {other} must sum to 100")
        pair = float(one), float(other)
    elif one is not None:
        pair = float(one), 100.0 - one
    elif other is not None:
        pair = 100.0 - other, float(other)
    else:
        pair = default
    if not all(0.0 <= x <= 100.0 for x in pair):
        raise ValueError(f"{what} percentages must be between 0 and 100")
    return pair


def resolve_counts(o: Options) -> Counts:
    """Explicit counts win over percentages; a single one leaves the rest of the total (100 by default) to the other side."""
    llm, rule = _complement(o.ollama_percentage, o.fuzzy_percentage, (10.0, 90.0), "source")
    tp, fp = o.num_true_positives, o.num_false_positives
    if (tp or 0) < 0 or (fp or 0) < 0:
        raise ValueError("explicit counts cannot be negative")
    if tp is None or fp is None:
        total = 100 if o.total_samples is None else o.total_samples
        if total < 0:
            raise ValueError("total_samples cannot be negative")
        if max(tp or 0, fp or 0) > total:
            raise ValueError("an explicit count exceeds total_samples")
        if tp is None and fp is None:
            tp = round(_complement(o.tp_percentage, o.fp_percentage, (50.0, 50.0), "decision")[0] / 100.0 * total)
        tp = total - fp if tp is None else tp
        fp = total - tp
    total = tp + fp
    if total <= 0:
        raise ValueError("nothing to generate: both counts are 0")
    exact = o.num_exact_matches if o.num_exact_matches is not None else round(float(o.exact_match_percentage) / 100.0 * total)
    gender = o.num_gender_variants if o.num_gender_variants is not None else round(float(o.gender_variant_percentage) / 100.0 * total)
    if exact < 0 or gender < 0:
        raise ValueError("reserved counts cannot be negative")
    if exact > tp or gender > fp:
        raise ValueError("a reserved count exceeds the budget of its decision")
    return Counts(tp, fp, tp / total * 100.0, fp / total * 100.0, llm, rule, exact, gender)


def parse_weights(raw: str | None) -> dict[str, float]:
    """An inline JSON object of code -> weight, or the path of a file with one."""
    text = local_weights(raw)
    if not text:
        return {}
    try:
        found = json.loads(text)
    except json.JSONDecodeError as e:
        raise ValueError(f"weights are not valid JSON: {e}") from e
    if not isinstance(found, dict):
        raise ValueError("weights must be a JSON object")
    return {str(k): float(x) for k, x in found.items()}


def parse_excludes(raw: str | None) -> set[str]:
    return {c.strip().upper() for c in (raw or "").split(",") if c.strip()}


def parse_locales(raw: str | None) -> list[str]:
    return [x.strip() for x in raw.split(",") if x.strip()] if raw else list(v.LOCALES)


def apportion(weights: DataFrame, total: Column, *by: str) -> DataFrame:
    """weights (code, weight, ...) with quota: largest remainders by (fraction, code) within each `by`; codes of no weight go, unless the total is 0.

    `total` is a column, constant within `by`. A plan has a row per code, so the unpartitioned window is small.
    """
    family = Window.partitionBy(*by)
    rows = weights.withColumn("_total", total.cast("long"))
    none = rows.where("_total <= 0").withColumn("quota", F.lit(0).cast("long"))
    rows = rows.where("_total > 0 and weight > 0").withColumn("_exact", F.col("_total") * (F.col("weight") / F.sum("weight").over(family)))
    rows = rows.withColumn("quota", F.floor("_exact")).withColumn("_left", F.col("_total") - F.sum("quota").over(family))
    rank = F.row_number().over(family.orderBy(F.desc(F.col("_exact") - F.col("quota")), "code"))
    size = F.count("*").over(family)
    rows = rows.withColumn("quota", (F.col("quota") + F.floor(F.col("_left") / size) + F.when(rank <= F.col("_left") % size, 1).otherwise(0)).cast("long"))
    return rows.drop("_exact", "_left").unionByName(none).drop("_total")


def plan_quotas(spark: SparkSession, num_tp: int, num_fp: int, weights: dict[str, float] | None = None, excludes: set[str] | None = None, floors: dict[str, int] | None = None) -> DataFrame:
    """(code, family, quota): each decision's budget over its codes; a floor above a code's share pins it and the rest is apportioned anew."""
    weights, excludes, floors = dict(weights or {}), set(excludes or ()), dict(floors or {})
    unknown = (set(weights) | excludes | set(floors)) - set(v.CODES)
    if unknown:
        raise ValueError(f"unknown disposition codes: {', '.join(sorted(unknown))}")
    if any(w < 0 for w in weights.values()) or any(f < 0 for f in floors.values()):
        raise ValueError("weights and floors cannot be negative")
    budgets = {"TP": int(num_tp), "FP": int(num_fp)}
    rows = []
    for family, codes in (("TP", v.TRUE_POSITIVE), ("FP", v.FALSE_POSITIVE)):
        own = [(c, family, float(weights.get(c, 1.0)), int(floors.get(c, 0)), budgets[family]) for c in codes if c not in excludes and weights.get(c, 1.0) > 0]
        if not own and budgets[family] > 0:
            raise ValueError(f"the {family} budget is {budgets[family]} but none of its codes is enabled")
        rows += own
    frame = spark.createDataFrame(rows, "code string, family string, weight double, floor long, budget long")
    shared = apportion(frame, F.col("budget"), "family")
    shared = shared.withColumn("pinned", F.when(F.col("floor") > F.col("quota"), F.least("floor", "budget")))
    family = Window.partitionBy("family")
    shared = shared.withColumn("_pins", F.coalesce(F.sum("pinned").over(family), F.lit(0)))
    over = shared.where("_pins > budget").select("family").distinct().collect()
    if over:
        raise ValueError(f"floors exceed the budget of {', '.join(r['family'] for r in over)}")
    kept = shared.where("_pins = 0").select("code", "family", "quota")
    pinned = shared.where("pinned is not null").select("code", "family", F.col("pinned").alias("quota"))
    rest = shared.where("_pins > 0 and pinned is null").select("code", "family", "weight", (F.col("budget") - F.col("_pins")).alias("room"))
    again = apportion(rest, F.col("room"), "family").select("code", "family", "quota")
    return kept.unionByName(pinned).unionByName(again)


def resolve_plan(spark: SparkSession, o: Options, c: Counts) -> DataFrame | None:
    """The plan of a balance mode; None where it is off."""
    mode = str(o.disposition_balance).lower()
    if mode not in ("even", "weighted", "off"):
        raise ValueError(f"unknown balance mode {mode!r}")
    if mode == "off":
        return None
    weights = parse_weights(o.disposition_weights) if mode == "weighted" else {}
    return plan_quotas(spark, c.num_tp, c.num_fp, weights, parse_excludes(o.disposition_exclude), {"DISP_EXACT_NAME_MATCH": c.exact, "DISP_GIVEN_NAME_GENDER_VARIANT": c.gender})


def split_sources(plan: DataFrame, alpha: float) -> DataFrame:
    """plan with a (rule-based) and b (model-narrated): exact matches all to a, else floor(alpha * quota)."""
    a = F.when(F.col("code") == "DISP_EXACT_NAME_MATCH", F.col("quota")).otherwise(F.floor(F.lit(float(alpha)) * F.col("quota")))
    return plan.withColumn("a", a.cast("long")).withColumn("b", (F.col("quota") - F.col("a")).cast("long"))


def model_load(c: Counts, plan: DataFrame | None) -> int:
    """Records that a run sends to the model: what the plan's codes leave to it, or, without a plan, what the two decisions do and the reserved cross-gender records."""
    alpha = c.rule_pct / 100.0
    if plan is not None:
        return split_sources(plan, alpha).agg(F.coalesce(F.sum("b"), F.lit(0))).first()[0]
    return c.num_tp + c.num_fp - c.exact - math.floor(alpha * (c.num_tp - c.exact)) - math.floor(alpha * (c.num_fp - c.gender))


def slots(plan: DataFrame) -> DataFrame:
    """One row per record to make: (code, slot from 1)."""
    return plan.where("quota > 0").select("code", F.explode(F.sequence(F.lit(1).cast("long"), F.col("quota"))).alias("slot"))


def estimate(n: int, rule_pct: float, llm_pct: float, batch: int) -> tuple[float, str]:
    """Seconds and their text: rules at a fixed rate, the model at 0.8 records a second per concurrent request, between 5 and 15."""
    seconds = n * (rule_pct / 100.0) / RULES_PER_SECOND + n * (llm_pct / 100.0) / max(5.0, min(15.0, batch * 0.8))
    if seconds < 60:
        return seconds, f"{seconds:.1f}s"
    if seconds < 3600:
        return seconds, f"{seconds / 60.0:.1f}m"
    return seconds, f"{seconds / 3600.0:.1f}h {math.fmod(seconds, 3600) / 60.0:.0f}m"


def estimate_columns(n: Column, rule_pct: Column, llm_pct: Column, batch: Column) -> Column:
    rate = F.greatest(F.lit(5.0), F.least(F.lit(15.0), batch * 0.8))
    return n * (rule_pct / 100.0) / RULES_PER_SECOND + n * (llm_pct / 100.0) / rate
