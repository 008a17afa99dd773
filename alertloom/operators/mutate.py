"""Pair generation: one function per code, names in, candidates out.

Each takes a DataFrame with client_name and returns (code, client_name, variant_ix, hit_name, matching_text,
thinking): every hit that the code allows, or as many as its curated lists give. Random choice becomes
enumeration here and a hash rank in `plans.assign`, so results don't depend on partitions or retries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as v
from ..functions.strings import ABSENT, before_last, compose, differing, folded, joined, last, lookup, middle, pick_from, says, strip_marks, tokens, walk_middle, walk_note, with_at, without, words

CANDIDATE = ["code", "client_name", "variant_ix", "hit_name", "matching_text", "thinking"]


def _names(names: DataFrame, at_least: int = 2) -> DataFrame:
    return names.select("client_name", tokens(F.col("client_name")).alias("t")).where(F.size("t") >= at_least)


def _worded(kind: str, code: str) -> Column:
    return pick_from(v.WORDING[kind], F.concat_ws("|", "client_name", F.col("variant_ix").cast("string")), f"{code}/{kind}")


def _emit(df: DataFrame, code: str, matching: Column, given: Column, mid: Column, surname: Column, boundary: Column, principle: str) -> DataFrame:
    thinking = compose(F.col("client_name"), F.col("hit_name"), given, mid, surname, boundary, _worded(principle, code), F.lit(code), F.lit(v.DECISIONS[code]))
    return df.select(F.lit(code).alias("code"), "client_name", F.col("variant_ix").cast("long").alias("variant_ix"), "hit_name", matching.alias("matching_text"), thinking.alias("thinking"))


def _walked(df: DataFrame, code: str, matching: Column, boundary: Column, principle: str, extra: Column | None = None) -> DataFrame:
    """For hits (token array h) of as many tokens as the client."""
    t, h = F.col("t"), F.col("h")
    surname = walk_note(last(t), last(h))
    return _emit(df, code, matching, walk_note(t[0], h[0]), walk_middle(t, h), surname if extra is None else says(surname, " (", extra, ")"), boundary, principle)


def _hit(df: DataFrame) -> DataFrame:
    return df.withColumn("hit_name", joined(F.col("h")))


def _once(df: DataFrame) -> DataFrame:
    """df behind a generator, so that what it computes is made once and not in each expression that names it."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def exact(names: DataFrame) -> DataFrame:
    code, t = "DISP_EXACT_NAME_MATCH", F.col("t")
    df = _names(names).withColumns({"hit_name": F.col("client_name"), "variant_ix": F.lit(0)})
    mid = F.when(F.size(t) > 2, walk_note(joined(middle(t)), joined(middle(t)))).otherwise(ABSENT)
    return _emit(df, code, F.col("client_name"), walk_note(t[0], t[0]), mid, walk_note(last(t), last(t)), _worded("BOUNDARY_EXACT_MATCH", code), "PRINCIPLE_ANALYST_REVIEW")


def order_swap(names: DataFrame) -> DataFrame:
    code, t = "DISP_TOKEN_ORDER_SWAP", F.col("t")
    df = _hit(_names(names).withColumns({"h": F.concat(F.slice(t, -1, 1), before_last(t)), "variant_ix": F.lit(0)}))
    what = F.when(F.size(t) == 2, "reversal of first name and family name order").otherwise("placement of the family name at the beginning of the name")
    return _walked(df, code, joined(t), says("The variation is ", what, " under ", _worded("ORDER_MECHANISMS", code), "; ", _worded("BOUNDARY_TOKEN_ORDER_SWAP", code)), "PRINCIPLE_TP_IDENTITY")


def middle_abbreviated(names: DataFrame) -> DataFrame:
    code, t = "DISP_MIDDLE_NAME_ABBREVIATED", F.col("t")
    df = _names(names, 3).where(F.length(t[1]) > 2).withColumn("short", says(F.substring(t[1], 1, 1), "."))
    df = _hit(df.withColumns({"h": with_at(t, F.lit(1), F.col("short")), "variant_ix": F.lit(0)}))
    mid = says("'", t[1], "' shortened to initial '", F.col("short"), "' (", _worded("MIDDLE_ABBREV_MECHANISMS", code), ")")
    return _emit(df, code, F.concat_ws(" ", t[0], last(t)), walk_note(t[0], t[0]), mid, walk_note(last(t), last(t)), _worded("BOUNDARY_MIDDLE_ABBREVIATED", code), "PRINCIPLE_TP_IDENTITY")


def middle_expanded(names: DataFrame) -> DataFrame:
    code, t = "DISP_MIDDLE_INITIAL_EXPANDED", F.col("t")
    df = _names(names, 3).where(F.length(t[1]) <= 2).select("*", F.posexplode(words(v.MIDDLE_NAMES)).alias("variant_ix", "full"))
    df = _hit(df.withColumn("h", with_at(t, F.lit(1), F.col("full"))))
    mid = says("middle initial '", t[1], "' spelled out as '", F.col("full"), "' (", _worded("MIDDLE_EXPAND_MECHANISMS", code), ")")
    return _emit(df, code, F.concat_ws(" ", t[0], last(t)), walk_note(t[0], t[0]), mid, walk_note(last(t), last(t)), _worded("BOUNDARY_MIDDLE_EXPANDED", code), "PRINCIPLE_TP_IDENTITY")


def middle_omitted(names: DataFrame) -> DataFrame:
    """Three tokens or more lose the second; two gain an initial."""
    code, t = "DISP_MIDDLE_NAME_OMITTED", F.col("t")
    df = _names(names).select("*", F.posexplode(F.when(F.size(t) > 2, words([""])).otherwise(words(v.ALPHABET))).alias("variant_ix", "initial"))
    h = F.when(F.size(t) > 2, F.concat(F.slice(t, 1, 1), F.slice(t, 3, F.size(t)))).otherwise(F.array(t[0], says(F.col("initial"), "."), last(t)))
    df = _hit(df.withColumn("h", h))
    mid = F.when(F.size(t) > 2, says("middle name '", t[1], "' omitted from the hit (")).otherwise(says("middle initial '", F.col("initial"), ".' present only in the hit ("))
    return _emit(df, code, F.concat_ws(" ", t[0], last(t)), walk_note(t[0], F.col("h")[0]), says(mid, _worded("OMISSION_MECHANISMS", code), ")"), walk_note(last(t), last(F.col("h"))), _worded("BOUNDARY_MIDDLE_OMITTED", code), "PRINCIPLE_TP_IDENTITY")


def middle_conflict(names: DataFrame) -> DataFrame:
    code, t = "DISP_MIDDLE_NAME_CONFLICT", F.col("t")
    df = _names(names).select("*", F.posexplode(words(v.MIDDLE_NAMES)).alias("variant_ix", "other")).where((F.size(t) == 2) | (F.lower("other") != F.lower(t[1])))
    df = _hit(df.withColumn("h", F.when(F.size(t) > 2, with_at(t, F.lit(1), F.col("other"))).otherwise(F.array(t[0], F.col("other"), t[1]))))
    replaced = says("conflicting middle name '", F.col("other"), "' replacing '", t[1], "' (", _worded("MIDDLE_ABBREV_MECHANISMS", code), ")")
    mid = F.when(F.size(t) > 2, replaced).otherwise(says("introduction of a distinct middle name '", F.col("other"), "' (", _worded("OMISSION_MECHANISMS", code), ")"))
    return _emit(df, code, F.concat_ws(" ", t[0], last(t)), walk_note(t[0], F.col("h")[0]), mid, walk_note(last(t), last(F.col("h"))), _worded("BOUNDARY_MIDDLE_CONFLICT", code), "PRINCIPLE_FP_DISTINCT")


def surname_swap(names: DataFrame) -> DataFrame:
    code, t = "DISP_SURNAME_CONFLICT", F.col("t")
    df = _names(names).select("*", F.posexplode(words(v.SURNAMES)).alias("variant_ix", "other")).where(F.lower("other") != F.lower(last(t)))
    df = _hit(df.withColumn("h", F.concat(before_last(t), F.array("other"))))
    rest = joined(before_last(t))
    return _emit(df, code, rest, walk_note(rest, rest), F.lit(ABSENT), says("'", last(t), "' recorded as '", F.col("other"), "'"), _worded("BOUNDARY_SURNAME_CONFLICT", code), "PRINCIPLE_FP_DISTINCT")


def phonetic(names: DataFrame) -> DataFrame:
    """Curated variants of the surname; else the first of three spelling rules that applies; else any other surname."""
    code, t = "DISP_PHONETIC_SURNAME_DIVERGENCE", F.col("t")
    df = _names(names).withColumn("old", last(t)).withColumn("curated", lookup(v.PHONETIC, F.lower("old")))
    old = F.col("old")
    cut = lambda n: F.substring(old, F.lit(1), F.length(old) - n)
    rule = F.when(old.endswith("son"), says(cut(3), "sen")).when(old.endswith("y"), says(cut(1), "ey")).when(F.lower(old).contains("ff"), F.regexp_replace(old, "[fF]{2}", "ph"))
    others = F.filter(words(v.SURNAMES), lambda s: F.lower(s) != F.lower(old))
    df = df.select("*", F.posexplode(F.coalesce("curated", F.when(rule.isNotNull(), F.array(rule)), others)).alias("variant_ix", "new"))
    df = _hit(df.withColumn("h", F.concat(before_last(t), F.split("new", " "))))
    what = says(F.when(F.col("curated").isNotNull(), "phonetic variation of surname from '").otherwise("surname substitution from '"), old, "' to '", F.col("new"), "'")
    return _walked(df, code, joined(before_last(t)), _worded("BOUNDARY_PHONETIC_DIVERGENCE", code), "PRINCIPLE_FP_DISTINCT", what)


def transliterated(names: DataFrame) -> DataFrame:
    code, t = "DISP_TRANSLITERATION_VARIANT", F.col("t")
    df = _names(names).select("*", F.posexplode(t).alias("at", "old")).withColumn("forms", lookup(v.ROMANISED, F.lower("old"))).where("forms is not null")
    df = df.select("client_name", "t", "at", "old", F.posexplode("forms").alias("form", "new")).withColumn("variant_ix", F.col("at") * 10 + F.col("form"))
    df = _hit(df.withColumn("h", with_at(t, F.col("at"), F.col("new"))))
    return _walked(df, code, joined(without(t, F.col("at"))), says("'", F.col("old"), "' rendered as '", F.col("new"), "' under ", _worded("TRANSLITERATION_MECHANISMS", code), "; ", _worded("BOUNDARY_TRANSLITERATION", code)), "PRINCIPLE_TP_IDENTITY")


def _first(t: Column, test: Callable[[Column, Column], Column]) -> Column:
    """The least value that test(token, index) gives, nulls left out."""
    return F.array_min(F.transform(t, test))


def diacritic(names: DataFrame) -> DataFrame:
    """A curated pair either way (lowest pair, then position); else the first token that folding changes."""
    code, t = "DISP_DIACRITIC_STRIPPED", F.col("t")
    rank: dict[str, int] = {}
    other: dict[str, str] = {}
    for k, (x, y) in enumerate(v.ACCENTED):
        for a, b in ((x, y), (y, x)):
            rank.setdefault(a, k)
            other.setdefault(a, b)
    curated = _first(t, lambda x, i: F.when(lookup(rank, x).isNotNull(), F.struct(lookup(rank, x).alias("rank"), i.alias("at"), lookup(other, x).alias("new"))))
    plain = _first(t, lambda x, i: F.when((strip_marks(x) != x) & (strip_marks(x) != ""), F.struct(F.lit(0).alias("rank"), i.alias("at"), strip_marks(x).alias("new"))))
    df = _names(names).withColumn("c", F.coalesce(curated, plain)).where("c is not null").select("client_name", "t", "c.at", "c.new", F.lit(0).alias("variant_ix"))
    df = _hit(df.withColumn("h", with_at(t, F.col("at"), F.col("new"))))
    return _walked(df, code, joined(without(t, F.col("at"))), says("'", F.get(t, F.col("at")), "' rendered as '", F.col("new"), "' under ", _worded("DIACRITIC_MECHANISMS", code), "; ", _worded("BOUNDARY_DIACRITIC", code)), "PRINCIPLE_TP_IDENTITY")


def compound(names: DataFrame) -> DataFrame:
    """A hyphenated form split, else two adjoining tokens merged (lowest pair, then position)."""
    code, t = "DISP_COMPOUND_NAME_RESTRUCTURED", F.col("t")
    rank = {h: k for k, (h, _) in enumerate(v.COMPOUND)}
    parts = dict(v.COMPOUND)
    pair_rank = {s: k for k, (_, s) in enumerate(v.COMPOUND) if len(s.split()) == 2}
    merged = {s: h for h, s in v.COMPOUND}
    split_at = _first(t, lambda x, i: F.when(lookup(rank, x).isNotNull(), F.struct(lookup(rank, x).alias("rank"), i.alias("at"), F.lit(1).alias("n"), x.alias("old"), lookup(parts, x).alias("new"))))
    pairs = F.zip_with(before_last(t), F.slice(t, 2, F.size(t)), lambda a, b: F.concat_ws(" ", a, b))
    merge_at = _first(pairs, lambda x, i: F.when(lookup(pair_rank, x).isNotNull(), F.struct(lookup(pair_rank, x).alias("rank"), i.alias("at"), F.lit(2).alias("n"), x.alias("old"), lookup(merged, x).alias("new"))))
    df = _names(names).withColumn("c", F.coalesce(split_at, merge_at)).where("c is not null").select("client_name", "t", "c.at", "c.n", "c.old", "c.new", F.lit(0).alias("variant_ix"))
    h = F.concat(F.slice(t, F.lit(1), F.col("at")), F.split("new", " "), F.slice(t, F.col("at") + F.col("n") + 1, F.size(t)))
    df = _hit(df.withColumn("h", h))
    hit = F.col("h")
    mid = F.when((F.size(t) > 2) | (F.size(hit) > 2), walk_note(joined(middle(t)), joined(middle(hit)))).otherwise(ABSENT)
    boundary = says("'", F.col("old"), "' recorded as '", F.col("new"), "' under ", _worded("COMPOUND_MECHANISMS", code), "; ", _worded("BOUNDARY_COMPOUND", code))
    kept = F.filter(t, lambda x, i: (i < F.col("at")) | (i >= F.col("at") + F.col("n")))
    return _emit(df, code, joined(kept), walk_note(t[0], hit[0]), mid, walk_note(last(t), last(hit)), boundary, "PRINCIPLE_TP_IDENTITY")


def gender(names: DataFrame) -> DataFrame:
    code, t = "DISP_GIVEN_NAME_GENDER_VARIANT", F.col("t")
    df = names.select("client_name", tokens(F.col("client_name")).alias("t")).where(F.size("t") >= 1)
    df = df.withColumn("new", lookup(v.COUNTERPART, folded(t[0]))).where(F.col("new").isNotNull() & ~F.exists(F.slice(t, 2, F.size(t)), lambda x: folded(x) == folded(F.col("new"))))
    df = _hit(df.withColumns({"h": with_at(t, F.lit(0), F.col("new")), "variant_ix": F.lit(0)}))
    kind = lambda c: F.coalesce(lookup(v.GENDER, folded(c)), F.lit("gendered"))
    given = says("client carries the ", kind(t[0]), " form '", t[0], "', hit carries its ", kind(F.col("new")), " counterpart '", F.col("new"), "'")
    mid = F.when(F.size(t) > 2, walk_note(joined(middle(t)), joined(middle(t)))).otherwise(ABSENT)
    rest = joined(F.slice(t, 2, F.size(t)))
    return _emit(df, code, F.when(rest == "", F.col("hit_name")).otherwise(rest), given, mid, walk_note(last(t), last(F.col("h"))), _worded("BOUNDARY_GENDER_VARIANT", code), "PRINCIPLE_GENDER_MISMATCH")


def is_gender_pair(client: Column, hit: Column, a: Column | None = None, b: Column | None = None, at: Column | None = None) -> Column:
    """Equal token counts, one differing token, and that one the curated counterpart of the other (a, b, at: tokens of both and where they differ, if known)."""
    a, b = tokens(client) if a is None else a, tokens(hit) if b is None else b
    at = differing(a, b) if at is None else at
    x, y = folded(F.get(a, F.get(at, F.lit(0)))), folded(F.get(b, F.get(at, F.lit(0))))
    swaps = F.coalesce(folded(lookup(v.COUNTERPART, x)) == y, F.lit(False)) | F.coalesce(folded(lookup(v.COUNTERPART, y)) == x, F.lit(False))
    return F.coalesce((F.size(a) == F.size(b)) & (F.size(at) == 1) & swaps, F.lit(False))


#: Folded given name -> the folded names that are its counterpart, or whose counterpart it is.
PARTNERS: dict[str, list[str]] = {}
for _a, _b in v.COUNTERPART.items():
    if _a != v.fold(_a):
        continue
    for _x, _y in ((v.fold(_a), v.fold(_b)), (v.fold(_b), v.fold(_a))):
        PARTNERS[_x] = sorted({*PARTNERS.get(_x, []), _y})


def typo(names: DataFrame) -> DataFrame:
    """Every single slip of each token (swap of neighbours, a neighbouring key, an omission; `n` behind short tokens) that stays a typo."""
    code, t, old, at = "DISP_MINOR_TYPO", F.col("t"), F.col("old"), F.col("at")
    df = _names(names).select("*", F.posexplode(t).alias("tok", "old"))
    places = F.when(F.length(old) > 3, F.sequence(F.lit(1), F.length(old) - 2)).otherwise(F.array(F.lit(0)))
    df = df.withColumn("at", F.explode(places)).withColumns({"c": F.substring(old, at + 1, F.lit(1)), "d": F.substring(old, at + 2, F.lit(1))})
    c, d = F.col("c"), F.col("d")
    head, tail, behind = F.substring(old, F.lit(1), at), F.substring(old, at + 2, F.length(old)), F.substring(old, at + 3, F.length(old))
    keys = F.split(F.coalesce(lookup(v.NEIGHBOURS, F.lower(c)), F.lit("aeiou")), "")
    made = lambda new, what: F.struct(new.alias("new"), what.alias("what"))
    swap = F.when(c != d, F.array(made(F.concat(head, d, c, behind), says("adjacent character transposition ('", c, d, "' -> '", d, c, "')")))).otherwise(F.array().cast("array<struct<new:string,what:string>>"))
    upper = (F.upper(c) == c) & (F.lower(c) != c)
    keyed = F.transform(F.filter(keys, lambda k: k != ""), lambda k: F.when(upper, F.upper(k)).otherwise(k))
    slips = F.transform(keyed, lambda k: made(F.concat(head, k, tail), says("single typographical substitution ('", c, "' -> '", k, "')")))
    drop = F.array(made(F.concat(head, tail), says("single typographical omission of character '", c, "'")))
    append = F.array(made(F.concat(old, F.lit("n")), F.lit("single typographical character append")))
    edits = F.when(F.length(old) > 3, F.concat(swap, slips, drop)).otherwise(append)
    # a slip is at most two edits by its making, so only equal spellings and counterparts of the token have to go
    forms = F.coalesce(lookup(PARTNERS, folded(old)), F.array().cast("array<string>"))
    df = df.select("client_name", "t", "tok", "at", "old", forms.alias("forms"), edits.alias("edits"))
    df = df.select("client_name", "t", "tok", "at", "old", "forms", F.posexplode("edits").alias("edit", "e")).withColumn("variant_ix", (F.col("tok") * 1000 + F.col("at")) * 100 + F.col("edit"))
    df = df.where((F.lower(old) != F.lower("e.new")) & ~F.when(F.size("forms") > 0, F.array_contains("forms", folded(F.col("e.new")))).otherwise(False))
    df = _once(_hit(df.withColumn("h", with_at(t, F.col("tok"), F.col("e.new")))))
    left = joined(without(t, F.col("tok")))
    return _walked(df, code, F.when(left == "", F.substring("client_name", 1, 3)).otherwise(left), says("The affected token shows ", F.col("e.what"), "; ", _worded("BOUNDARY_MINOR_TYPO", code)), "PRINCIPLE_TP_IDENTITY")


#: code -> generator.
GENERATORS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "DISP_MINOR_TYPO": typo,
    "DISP_TOKEN_ORDER_SWAP": order_swap,
    "DISP_MIDDLE_NAME_ABBREVIATED": middle_abbreviated,
    "DISP_MIDDLE_INITIAL_EXPANDED": middle_expanded,
    "DISP_MIDDLE_NAME_OMITTED": middle_omitted,
    "DISP_TRANSLITERATION_VARIANT": transliterated,
    "DISP_DIACRITIC_STRIPPED": diacritic,
    "DISP_COMPOUND_NAME_RESTRUCTURED": compound,
    "DISP_EXACT_NAME_MATCH": exact,
    "DISP_SURNAME_CONFLICT": surname_swap,
    "DISP_MIDDLE_NAME_CONFLICT": middle_conflict,
    "DISP_PHONETIC_SURNAME_DIVERGENCE": phonetic,
    "DISP_GIVEN_NAME_GENDER_VARIANT": gender,
}


def candidates(names: DataFrame, code: str) -> DataFrame:
    if code not in GENERATORS:
        raise ValueError(f"unknown disposition code {code!r}")
    return GENERATORS[code](names)
