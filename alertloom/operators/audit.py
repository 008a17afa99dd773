"""Independent audits: labels, closures, balance, category integrity, uniqueness, distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab as v
from ..functions.strings import closure, differing, joined, label_of, last, lookup, strip_marks, tokens, trimmed_lower, words
from .mutate import is_gender_pair


def problem_under(client: Column, hit: Column, code: str, c: Column | None = None, h: Column | None = None, diffs: Column | None = None) -> Column:
    """What is wrong with a pair under one code, or null; only that code's rule is in the plan.

    c, h and diffs: the tokens of both names and where they differ, if a caller has them.
    """
    c, h = tokens(client) if c is None else c, tokens(hit) if h is None else h
    diffs = differing(c, h) if diffs is None else diffs
    even, n = F.size(c) == F.size(h), F.size(c)
    one = even & (F.size(diffs) == 1)
    at = F.get(diffs, F.lit(0))
    only = lambda k: one & (at == k)
    same = lambda: trimmed_lower(client) == trimmed_lower(hit)
    cx, hx = F.get(c, at), F.get(h, at)
    c0, h0, c1, h1 = (F.get(a, F.lit(k)) for k in (0, 1) for a in (c, h))
    lower_all = lambda a: F.array_sort(F.transform(a, F.lower))
    first_same = lambda: F.lower(c0) == F.lower(h0)
    rest = lambda a, k: F.slice(a, k, F.greatest(F.size(a), F.lit(1)))
    removed = lambda: (F.size(h) == n - 1) & first_same() & (rest(c, 3) == rest(h, 2))
    added = lambda: (F.size(h) == n + 1) & h1.rlike(r"^[A-Za-z]\.$") & first_same() & (rest(c, 2) == rest(h, 3))
    forms = lambda table, key: F.transform(F.coalesce(lookup(table, key), F.array().cast("array<string>")), F.lower)
    roman = lambda: F.array_contains(forms(v.ROMANISED, F.lower(cx)), F.lower(hx)) | F.array_contains(forms(v.ROMANISED, F.lower(hx)), F.lower(cx))
    accents = lambda: words([f"{a}|{b}" for x, y in v.ACCENTED for a, b in ((x, y), (y, x))])
    marks = lambda: F.array_contains(accents(), F.concat_ws("|", cx, hx)) | (strip_marks(cx) == strip_marks(hx))
    plain = lambda x: F.lower(joined(tokens(F.replace(x, F.lit("-"), F.lit(" ")))))
    cl, hl = last(c), last(h)
    tail = lambda form: F.lower(joined(F.slice(h, -F.least(F.size(F.split(form, " ")), F.size(h)), F.size(F.split(form, " ")))))
    curated = lambda: F.exists(forms(v.PHONETIC, F.lower(cl)), lambda f: (F.lower(hl) == f) | (tail(f) == f))
    middle_new = lambda: (F.size(h) == n + 1) & (n >= 2) & first_same() & (F.lower(cl) == F.lower(hl)) & h1.isin(v.MIDDLE_NAMES)
    test = lambda problem, text: F.when(F.coalesce(problem, F.lit(True)), F.lit(text))  # noqa: E731  an open question counts as a problem
    rules = {
        "DISP_EXACT_NAME_MATCH": lambda: [test(~same(), "not an identical name pair")],
        "DISP_GIVEN_NAME_GENDER_VARIANT": lambda: [test(~is_gender_pair(client, hit, c, h, diffs), "tokens do not differ by a single curated gendered given name")],
        "DISP_MINOR_TYPO": lambda: [
            test(same(), "pair is identical"),
            test(is_gender_pair(client, hit, c, h, diffs), "pair is a curated cross-gender variant (belongs to DISP_GIVEN_NAME_GENDER_VARIANT)"),
            test(F.levenshtein(F.lower(client), F.lower(hit)) > 2, "edit distance exceeds the documented <= 2 typo contract"),
        ],
        "DISP_TOKEN_ORDER_SWAP": lambda: [test(lower_all(c) != lower_all(h), "token multisets differ (not a pure reordering)"), test(same(), "no reordering occurred")],
        "DISP_MIDDLE_NAME_ABBREVIATED": lambda: [
            test(~only(1), "more than the middle token changed"),
            test((F.length(c1) <= 2) | (h1 != F.concat(F.upper(F.substring(c1, 1, 1)), F.lit("."))), "middle token was not shortened to its initial"),
        ],
        "DISP_MIDDLE_INITIAL_EXPANDED": lambda: [
            test(~only(1), "more than the middle token changed"),
            test((F.length(c1) > 2) | (F.length(h1) <= 2), "middle initial was not expanded"),
            test(~h1.isin(v.MIDDLE_NAMES), "expanded middle token is not from the curated middle-name pool"),
        ],
        "DISP_MIDDLE_NAME_OMITTED": lambda: [F.when(~(F.coalesce(removed(), F.lit(False)) | F.coalesce(added(), F.lit(False))), "neither a middle-name omission nor an added middle initial")],
        "DISP_TRANSLITERATION_VARIANT": lambda: [test(~one, "more than one token differs"), test(~roman(), "differing token is not a known cross-standard transliteration variant")],
        "DISP_DIACRITIC_STRIPPED": lambda: [test(~one, "more than one token differs"), test(~marks(), "differing token is not a diacritic-only variant")],
        "DISP_COMPOUND_NAME_RESTRUCTURED": lambda: [test(same(), "pair is identical"), test(plain(client) != plain(hit), "a hyphen split/merge does not account for the difference")],
        "DISP_SURNAME_CONFLICT": lambda: [test(~only(n - 1), "only the surname may differ for this code"), test(~hl.isin(v.SURNAMES), "replacement surname is not from the curated distinct-surname pool")],
        "DISP_MIDDLE_NAME_CONFLICT": lambda: [F.when(even & ~F.coalesce(only(1), F.lit(False)), "only the middle token may differ for this code").when(~even & ~F.coalesce(middle_new(), F.lit(False)), "neither a conflicting middle token nor an introduced middle name")],
        "DISP_PHONETIC_SURNAME_DIVERGENCE": lambda: [
            test(same(), "pair is identical"),
            test((n < 2) | (F.size(h) < 2), "pair is not a multi-token record"),
            F.when(~curated(), F.coalesce(
                test(strip_marks(cl) == strip_marks(hl), "surnames differ only by diacritics (belongs to DISP_DIACRITIC_STRIPPED)"),
                test(F.levenshtein(F.lower(cl), F.lower(hl)) <= 1, "surnames differ by a single character (belongs to DISP_MINOR_TYPO)"),
                test(~hl.rlike(r"^[\p{L}'\- ]*$"), "replacement surname is not a well-formed name token"),
            )),
        ],
    }
    return F.coalesce(*rules[code]())


def pair_problem(client: Column, hit: Column, code: Column) -> Column:
    """What is wrong with a pair under its code, or null."""
    out = F.when(~code.isin(v.CODES), F.concat(F.lit("unknown disposition code '"), code, F.lit("'")))
    for name in v.CODES:
        out = out.when(code == name, problem_under(client, hit, name))
    return out


def audit_pairs(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("problem", pair_problem(F.col("client_name"), F.col("hit_name"), F.col("disposition_code")))


def label_report(alerts: DataFrame) -> DataFrame:
    """(disposition_code, n, example) of the rows whose label doesn't hold; empty if all do."""
    example = F.concat(F.col("problem"), F.lit(" (e.g. '"), F.col("client_name"), F.lit("' vs '"), F.col("hit_name"), F.lit("')"))
    bad = audit_pairs(alerts).where("problem is not null")
    return bad.groupBy("disposition_code").agg(F.count("*").alias("n"), F.min_by(example, F.struct("client_name", "hit_name")).alias("example")).orderBy("disposition_code")


def closes(thinking: Column, code: Column, decision: Column) -> Column:
    return F.coalesce(F.endswith(F.regexp_replace(thinking, r"(?U)^\s+|\s+$", ""), closure(code, decision)), F.lit(False))


def closure_report(alerts: DataFrame) -> DataFrame:
    bad = alerts.where(~closes(F.col("thinking"), F.col("disposition_code"), F.col("decision")))
    return bad.groupBy("disposition_code").agg(F.count("*").alias("n"), F.min_by("thinking", F.struct("client_name", "hit_name")).alias("example")).orderBy("disposition_code")


def balance(alerts: DataFrame, plan: DataFrame, tolerance: int = 0) -> DataFrame:
    """(disposition_code, planned, emitted, delta, ok) for every code planned or emitted; a code that wasn't planned is never ok."""
    got = alerts.groupBy("disposition_code").agg(F.count("*").alias("emitted"))
    both = plan.select(F.col("code").alias("disposition_code"), F.col("quota").cast("long").alias("planned"), F.lit(True).alias("_in")).join(got, "disposition_code", "full_outer")
    n = F.coalesce("emitted", F.lit(0))
    want = F.coalesce("planned", F.lit(0))
    return both.select("disposition_code", want.alias("planned"), n.alias("emitted"), (n - want).alias("delta"), (F.col("_in").isNotNull() & (F.abs(n - want) <= tolerance)).alias("ok")).orderBy("disposition_code")


def integrity(alerts: DataFrame) -> DataFrame:
    """One row of counts: identical pairs and their labels, gender pairs and theirs, typos that are gender pairs."""
    code, same = F.col("disposition_code"), F.col("client_name") == F.col("hit_name")
    pair = is_gender_pair(F.col("client_name"), F.col("hit_name"))
    gender = code == "DISP_GIVEN_NAME_GENDER_VARIANT"
    return alerts.agg(
        F.count_if(same).alias("identical"),
        F.count_if(same & (code == "DISP_EXACT_NAME_MATCH") & (F.col("decision") == v.ESCALATE)).alias("identical_labelled"),
        F.count_if(gender).alias("gender"),
        F.count_if(gender & pair & (F.col("decision") == v.DISQUALIFY)).alias("gender_labelled"),
        F.count_if((code == "DISP_MINOR_TYPO") & pair).alias("typos_that_are_gender_pairs"),
    )


def integrity_verdict(alerts: DataFrame, exact: int, gender: int) -> DataFrame:
    """One row: what was planned of the two reserved kinds, what there is, and whether all of it holds."""
    ok = (F.col("identical") == exact) & (F.col("identical_labelled") == F.col("identical")) & (F.col("gender") == gender) & (F.col("gender_labelled") == F.col("gender")) & (F.col("typos_that_are_gender_pairs") == 0)
    return integrity(alerts).select(F.lit(exact).cast("long").alias("exact_planned"), F.col("identical").alias("exact_emitted"), F.lit(gender).cast("long").alias("gender_planned"), F.col("gender").alias("gender_emitted"), ok.alias("ok"))


def distribution(alerts: DataFrame) -> DataFrame:
    """(disposition_code, disposition_label, n, percent) by code."""
    counts = alerts.groupBy("disposition_code").agg(F.count("*").alias("n"))
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())  # a row per code
    return counts.select("disposition_code", label_of(F.col("disposition_code")).alias("disposition_label"), "n", F.round(share, 4).alias("percent")).orderBy("disposition_code")


def uniqueness(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("*").alias("n"), F.countDistinct("client_name", "hit_name").alias("distinct_pairs"))


def merge_first(*frames: DataFrame) -> DataFrame:
    """All rows, one per (client_name, hit_name): that of the earliest frame."""
    whole = None
    for k, f in enumerate(frames):
        f = f.withColumn("_from", F.lit(k))
        whole = f if whole is None else whole.unionByName(f)
    at = F.row_number().over(Window.partitionBy("client_name", "hit_name").orderBy("_from", *[c for c in frames[0].columns if c not in ("client_name", "hit_name")]))
    return whole.withColumn("_at", at).where("_at = 1").drop("_at", "_from")
