"""Model reviews: the prompt, the normaliser of a model's JSON answer, acceptance, and the rule-based fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as v
from ..functions.strings import closure, decision_of, label_of, overlap, says, trimmed_lower
from .mutate import is_gender_pair

#: The model's fields, with the names they may also come under.
FIELDS = ["matching_text", "disposition_code", "thinking", "decision", "created_by"]
THINKING_NAMES = ["thinking", "reasoning", "rationale", "explanation", "analysis", "thought_process"]
MATCHING_NAMES = ["matching_text", "matching_tokens", "matched_text", "match", "overlap"]
CODE_NAMES = ["disposition_code", "key_reason"]
CLOSURE_REACH = 100


BLANK_ENDS = r"(?U)^\s+|\s+$"


def unfenced(text: Column) -> Column:
    """The content of a fenced answer; text has no blanks at its ends."""
    inner = F.regexp_replace(F.regexp_replace(text, r"(?iU)^```(?:json)?\s*", ""), r"(?U)\s*```$", "")
    return F.when(text.startswith("```"), inner).otherwise(text)


def parsed(text: Column) -> Column:
    """The answer as a variant: the text itself, else what stands between its first and last brace; null if neither is JSON."""
    braced = F.when(text.contains("{"), F.regexp_extract(text, r"(?s)(\{.*\})", 1))
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(braced))


def _first_of(names: list[str]) -> Column:
    return F.coalesce(*[F.when(F.col(f"_f_{n}") != "", F.col(f"_f_{n}")) for n in names])


def cleaned_code(raw: Column) -> Column:
    """A code as written, in capitals, with underscores for blanks and hyphens."""
    code = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(raw, F.lit("")), BLANK_ENDS, ""), r"(?U)[\s\-]+", "_"), r"^[_.:]+|[_.:]+$", "")
    return F.upper(code)


def prefixed(code: Column) -> Column:
    return F.when((code != "") & ~code.startswith("DISP_"), says("DISP_", code)).otherwise(code)


def vocabulary_code(code: Column, fallback: Column, decision: Column) -> Column:
    """A vocabulary code: itself, else the first that contains it or is contained (8 characters or more), else the fallback, else by decision."""
    near = F.coalesce(*[F.when(code.contains(k) | F.lit(k).contains(code), k) for k in v.CODES])
    return F.when(code.isin(v.CODES), code).otherwise(F.coalesce(F.when(F.length(code) >= 8, near), _else(fallback, decision)))


def _else(fallback: Column, decision: Column) -> Column:
    return F.when(fallback.isin(v.CODES), fallback).when(decision == v.ESCALATE, "DISP_MINOR_TYPO").otherwise("DISP_SURNAME_CONFLICT")


def _closed(df: DataFrame) -> DataFrame:
    """df with _closed: _thinking with its closing line, as it is if it ends so, else repaired."""
    text, head, body, end = (F.col(c) for c in ("_text", "_head", "_body", "_end"))
    df = df.withColumns({"_text": F.regexp_replace("_thinking", BLANK_ENDS, ""), "_end": closure(F.col("disposition_code"), F.col("decision"))})
    df = df.withColumn("_head", F.when(text.contains("Therefore:"), F.regexp_extract(text, r"(?s)^(.*)Therefore:", 1)))
    late = F.length(head) >= F.length(text) - CLOSURE_REACH
    df = df.withColumn("_body", F.when(late, F.regexp_replace(head, r"(?U)\s+$", "")).otherwise(text))
    whole = F.when((body != "") & ~body.endswith("."), says(body, ". ", end)).otherwise(says(body, " ", end))
    return df.withColumn("_closed", F.when(text.endswith(end), F.col("_thinking")).otherwise(F.trim(whole)))


def normalise(df: DataFrame) -> DataFrame:
    """Rows (client_name, hit_name, content, target_decision, fallback_code, enforce_code, enforce_decision) with the normalised fields.

    Adds matching_text, disposition_code, thinking, decision, the tallies plausibility, decision_fixed, code_fixed (0 or more)
    and error, which names what makes the answer unusable (then the fields are null). What a later step names more than once is
    a column of its own: Spark makes such a column once a row, but an expression as often as it is named, in a lambda per element.
    """
    others = [c for c in df.columns if c not in ("matching_text", "disposition_code", "thinking", "decision", "plausibility", "code_fixed", "decision_fixed", "error")]
    df = df.withColumn("_text", F.regexp_replace("content", BLANK_ENDS, "")).withColumn("_text", unfenced(F.col("_text")))
    df = df.withColumn("_data", parsed(F.col("_text")))
    names = dict.fromkeys([*THINKING_NAMES, *CODE_NAMES, *MATCHING_NAMES, "decision"])
    df = df.withColumns({f"_f_{n}": F.try_variant_get("_data", f"$.{n}", "string") for n in names})
    df = df.withColumns({"_thinking": _first_of(THINKING_NAMES), "_matching": _first_of(MATCHING_NAMES), "_raw": _first_of(CODE_NAMES), "_said": F.lower(F.trim(F.coalesce("_f_decision", F.lit(""))))})
    said = F.col("_said")
    stated = F.when(said.contains("escalat") | said.contains("true"), v.ESCALATE).when(said.contains("disqualif") | said.contains("false") | said.contains("reject"), v.DISQUALIFY)
    df = df.withColumns({"_decision": stated.otherwise(F.coalesce("target_decision", F.lit(v.ESCALATE))), "_code": cleaned_code(F.col("_raw"))})
    df = df.withColumn("_code", prefixed(F.col("_code")))
    df = df.withColumn("_code", vocabulary_code(F.col("_code"), F.col("fallback_code"), F.col("_decision")))
    df = df.withColumn("_odd", (F.col("_code") == "DISP_EXACT_NAME_MATCH") & (trimmed_lower(F.col("client_name")) != trimmed_lower(F.col("hit_name"))))
    df = df.withColumn("_code", F.when(F.col("_odd"), _else(F.col("fallback_code"), F.col("_decision"))).otherwise(F.col("_code")))
    df = df.withColumn("_family", decision_of(F.col("_code")))
    pin = F.col("enforce_code").isNotNull() & (F.col("enforce_code") != F.col("_code"))
    force = F.col("enforce_decision").isNotNull() & (F.col("enforce_decision") != F.col("_family"))
    df = df.withColumns({
        "disposition_code": F.when(pin, F.col("enforce_code")).otherwise(F.col("_code")),
        "decision": F.when(force, F.col("enforce_decision")).otherwise(F.col("_family")),
        "plausibility": F.when(F.col("_odd"), 1).otherwise(0),
        "code_fixed": F.when(pin, 1).otherwise(0),
        "decision_fixed": F.when(F.col("_family") != F.col("_decision"), 1).otherwise(0) + F.when(force, 1).otherwise(0),
        "error": F.when(F.col("_data").isNull(), "no JSON").when(F.col("_thinking").isNull(), "no reasoning"),
    })
    df, ok = _closed(df), F.col("error").isNull()
    text = F.coalesce("_matching", overlap(F.col("client_name"), F.col("hit_name")))
    made = {"matching_text": text, "disposition_code": F.col("disposition_code"), "thinking": F.col("_closed"), "decision": F.col("decision")}
    counts = [F.when(ok, F.col(c)).otherwise(0).alias(c) for c in ("plausibility", "code_fixed", "decision_fixed")]
    return df.select(*others, *[F.when(ok, c).alias(n) for n, c in made.items()], *counts, "error")


def accepted(strict: bool = True) -> Column:
    """Whether a normalised answer stands: usable, of the wanted decision, with no decision corrected and, if strict, no pinned code."""
    agrees = F.col("target_decision").isNull() | (F.col("decision") == F.col("target_decision"))
    kept = F.col("error").isNull() & agrees & (F.col("decision_fixed") == 0)
    if strict:
        kept = kept & (F.col("enforce_code").isNull() | (F.col("code_fixed") == 0))
    return F.coalesce(kept, F.lit(False))


def or_fallback(answers: DataFrame, strict: bool = True) -> DataFrame:
    """Alerts: the model's record where its answer stands, else the rule-based one (rule_matching, fallback_code, rule_thinking, target_decision)."""
    answers = normalise(answers) if "error" not in answers.columns else answers
    ok = accepted(strict)
    code = F.when(ok, F.col("disposition_code")).otherwise(F.col("fallback_code"))
    return answers.select(
        "client_name", "hit_name", F.when(ok, F.col("matching_text")).otherwise(F.col("rule_matching")).alias("matching_text"),
        code.alias("disposition_code"), label_of(code).alias("disposition_label"), F.when(ok, F.col("thinking")).otherwise(F.col("rule_thinking")).alias("thinking"),
        F.when(ok, F.col("decision")).otherwise(F.col("target_decision")).alias("decision"), F.when(ok, "ollama").otherwise("rule_based").alias("created_by"),
    )


def tallies(answers: DataFrame, strict: bool = True) -> DataFrame:
    """One row: corrections of labels, answers of another decision than asked for, of another code than assigned (if strict), and unusable ones."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    usable = F.col("error").isNull()
    other = usable & F.col("target_decision").isNotNull() & (F.col("decision") != F.col("target_decision"))
    code = usable & ~other & (F.col("decision_fixed") == 0) & F.col("enforce_code").isNotNull() & (F.col("code_fixed") > 0) & F.lit(strict)
    return answers.agg(
        total("plausibility").alias("plausibility"), total("decision_fixed").alias("decision"), total("code_fixed").alias("disposition_code"),
        F.count_if(F.coalesce(other, F.lit(False))).alias("decision_mismatch"), F.count_if(F.coalesce(code, F.lit(False))).alias("code_mismatch_discards"), F.count_if(~usable).alias("errors"),
    )


def system_prompt() -> str:
    """What the model is told to be: a name reviewer who answers in JSON by the controlled vocabulary."""
    codes = "\n".join(f"  {k}: {x}" for k, x in v.LABELS.items())
    return (
        "You review name-screening alerts as an experienced sanctions analyst: compare a client name with a candidate hit, token by token, "
        "in plain words, without formulas, scores or distances. Weigh typos, token order, initials, omitted middle names, transliteration, "
        "marks, hyphens, gendered given names, and surnames or middle names that conflict. Answer with one JSON object of the fields "
        f"matching_text, disposition_code, thinking and decision ('{v.ESCALATE}' or '{v.DISQUALIFY}'). disposition_code is one of:\n{codes}\n"
        "thinking ends with: Therefore: <disposition_code> -> <decision>."
    )


def user_prompt(client: Column, hit: Column, target: Column, code: Column) -> Column:
    gender = "The names differ by one token, and it is the gendered counterpart of the other; judge whether one person can bear both, and conclude with 'disqualify'."
    likely = "The hit is likely the same person with a difference in recording; conclude with 'escalate to analyst'."
    other = "The hit is another person despite some overlap; conclude with 'disqualify'."
    context = F.when(is_gender_pair(client, hit), gender).when(target == v.ESCALATE, likely).otherwise(other)
    mandate = F.when(code.isNotNull(), says("\nThe difference to explain is ", code, " (", label_of(code), "); disposition_code must be it.")).otherwise("")
    return says('Client Name: "', client, '"\nCandidate Hit Name: "', hit, '"\n', context, mandate, f"\nAnswer in JSON with exactly the fields {', '.join(FIELDS[:4])}.")


def reviewable(pairs: DataFrame) -> DataFrame:
    """Pairs that may go to a model: identical ones are for rules alone."""
    return pairs.where(trimmed_lower(F.col("client_name")) != trimmed_lower(F.col("hit_name")))
