"""Which names can yield which code, pools per code, and names made up where a pool is thin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vocab as v
from ..functions.strings import SEED, before_last, folded, last, lookup, pick, strip_marks, tokens, words
from ..sources.scratch import cut

ACCENT_FORMS = sorted({x for pair in v.ACCENTED for x in pair})
HYPHENATED = sorted({h for h, _ in v.COMPOUND})
SPLIT_PAIRS = sorted({s for _, s in v.COMPOUND if len(s.split()) == 2})


def capable(name: Column, code: str) -> Column:
    """Whether a name can yield a code; raises ValueError for a code that isn't known."""
    if code not in v.LABELS:
        raise ValueError(f"unknown disposition code {code!r}")
    t = tokens(name)
    second = F.get(t, F.lit(1))
    if code in v.ANY_NAME:
        test = F.lit(True)
    elif code == "DISP_MIDDLE_NAME_ABBREVIATED":
        test = (F.size(t) >= 3) & (F.length(second) > 2)
    elif code == "DISP_MIDDLE_INITIAL_EXPANDED":
        test = (F.size(t) >= 3) & (F.length(second) <= 2)
    elif code == "DISP_TRANSLITERATION_VARIANT":
        test = F.exists(t, lambda x: F.lower(x).isin(list(v.ROMANISED)))
    elif code == "DISP_DIACRITIC_STRIPPED":
        test = F.exists(t, lambda x: x.isin(ACCENT_FORMS) | (strip_marks(x) != "") & (strip_marks(x) != x))
    elif code == "DISP_COMPOUND_NAME_RESTRUCTURED":
        pairs = F.zip_with(before_last(t), F.slice(t, 2, F.size(t)), lambda a, b: F.concat_ws(" ", a, b))
        test = F.arrays_overlap(t, words(HYPHENATED)) | F.exists(pairs, lambda x: x.isin(SPLIT_PAIRS))
    elif code == "DISP_PHONETIC_SURNAME_DIVERGENCE":
        test = F.lower(last(t)).isin(list(v.PHONETIC))
    else:
        new = folded(lookup(v.COUNTERPART, folded(F.get(t, F.lit(0)))))
        test = new.isNotNull() & ~F.exists(F.slice(t, 2, F.size(t)), lambda x: folded(x) == new)
    return F.coalesce((F.size(t) >= 2) & test, F.lit(False))


def capability_matrix(names: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """(code, client_name) for every code that a name can yield: one pass over the names."""
    can = F.array_compact(F.array(*[F.when(capable(F.col("client_name"), c), F.lit(c)) for c in codes or v.CODES]))
    return names.select("client_name", F.explode(can).alias("code")).select("code", "client_name")


def gender_of(name: Column) -> Column:
    """masculine or feminine by the given name, null for others."""
    return lookup(v.GENDER, folded(F.get(tokens(name), F.lit(0))))


def numbered(tokens: DataFrame, seed: str = SEED) -> tuple[DataFrame, int]:
    """(x, ix) of the distinct values of x, numbered from 0 by hash, and their number: ranks within buckets of the hash, behind the buckets before."""
    rows = cut(tokens.distinct().withColumn("hash", F.md5(F.concat("x", F.lit(seed)))).withColumn("bucket", F.substring("hash", 1, 3)))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"))  # at most 4096 rows
    before = sizes.withColumn("before", F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).select("bucket", "before")
    at = F.row_number().over(Window.partitionBy("bucket").orderBy("hash"))
    return rows.withColumn("at", at).join(F.broadcast(before), "bucket").select("x", (F.col("before") + F.col("at") - 1).alias("ix")), rows.count()


def synthesised(spark: SparkSession, names: DataFrame, code: str, needed: int, seed: str = SEED) -> DataFrame:
    """Up to `needed` made-up client names for a code: a curated token with a pooled given name or surname; three draws each."""
    recipes = {"DISP_DIACRITIC_STRIPPED", "DISP_COMPOUND_NAME_RESTRUCTURED", "DISP_TRANSLITERATION_VARIANT", "DISP_MIDDLE_INITIAL_EXPANDED", "DISP_MIDDLE_NAME_ABBREVIATED", "DISP_PHONETIC_SURNAME_DIVERGENCE"}
    empty = spark.createDataFrame([], "client_name string")
    if needed <= 0 or code not in recipes:
        return empty
    t = tokens(F.col("client_name"))
    givens, n_given = numbered(names.select(F.get(t, F.lit(0)).alias("x")).where("x is not null"), seed)
    surnames, n_surname = numbered(names.select(last(t).alias("x")).where("x is not null"), seed)
    if not n_given or not n_surname:
        return empty
    key = F.concat_ws("|", F.lit(code), F.col("id").cast("string"))
    curated = {
        "DISP_DIACRITIC_STRIPPED": [x for x, _ in v.ACCENTED],
        "DISP_COMPOUND_NAME_RESTRUCTURED": HYPHENATED,
        "DISP_TRANSLITERATION_VARIANT": [x.title() for x in sorted(v.ROMANISED)],
        "DISP_MIDDLE_INITIAL_EXPANDED": [f"{c}." for c in v.ALPHABET],
        "DISP_MIDDLE_NAME_ABBREVIATED": [m for m in v.MIDDLE_NAMES if len(m) > 2],
        "DISP_PHONETIC_SURNAME_DIVERGENCE": [x.title() for x in sorted(v.PHONETIC)],
    }[code]
    draws = spark.range(3 * needed).select("id", F.get(words(curated), pick(key, "token", len(curated), seed).cast("int")).alias("token"), pick(key, "given", n_given, seed).alias("g"), pick(key, "surname", n_surname, seed).alias("s"), (pick(key, "side", 2, seed) == 0).alias("first"))
    draws = draws.join(givens.withColumnsRenamed({"ix": "g", "x": "given"}), "g").join(surnames.withColumnsRenamed({"ix": "s", "x": "surname"}), "s")
    if code in ("DISP_DIACRITIC_STRIPPED", "DISP_COMPOUND_NAME_RESTRUCTURED"):
        name = F.concat_ws(" ", "token", "surname")
    elif code == "DISP_TRANSLITERATION_VARIANT":
        name = F.when(F.col("first"), F.concat_ws(" ", "token", "surname")).otherwise(F.concat_ws(" ", "given", "token"))
    elif code == "DISP_PHONETIC_SURNAME_DIVERGENCE":
        name = F.concat_ws(" ", "given", "token")
    else:
        name = F.concat_ws(" ", "given", "token", "surname")
    made = draws.select("id", name.alias("client_name")).where(capable(F.col("client_name"), code))
    return made.groupBy(F.lower("client_name").alias("k")).agg(F.min_by("client_name", "id").alias("client_name"), F.min("id").alias("id")).orderBy("id").limit(needed).select("client_name")


def pools(spark: SparkSession, names: DataFrame, quotas: dict[str, int], top_up: bool = True, seed: str = SEED) -> DataFrame:
    """(code, client_name, tier): capable names for each code with a quota, and made-up ones where they are fewer than it."""
    codes = [c for c, q in quotas.items() if q > 0]
    if not codes:
        return spark.createDataFrame([], "code string, client_name string, tier int")
    real = capability_matrix(names, codes).withColumn("tier", F.lit(1))
    if not top_up:
        return real
    have = {r["code"]: r["count"] for r in real.groupBy("code").count().collect()}  # a row per code
    for code in codes:
        short = quotas[code] - have.get(code, 0)
        if code == "DISP_GIVEN_NAME_GENDER_VARIANT" and (short := short + max(8, quotas[code] // 5)) > 0:
            extra = gender_clients(names, quotas[code] + max(8, quotas[code] // 5), seed=seed).where("tier = 2").select("client_name")
        elif short > 0:
            extra = synthesised(spark, names, code, short, seed)
        else:
            continue
        known = real.where(F.col("code") == code).select(F.lower("client_name").alias("k"))
        extra = extra.withColumn("k", F.lower("client_name")).join(known, "k", "left_anti").select(F.lit(code).alias("code"), "client_name", F.lit(2).alias("tier"))
        real = real.unionByName(extra)
    return real


def capacity(pool: DataFrame, plan: DataFrame) -> DataFrame:
    """(code, quota, pool_size, capacity, short): what each pool can roughly yield against its quota."""
    sizes = pool.groupBy("code").agg(F.count("*").alias("pool_size"))
    space = F.coalesce(lookup(v.VARIANTS, F.col("code")), F.lit(1))
    return plan.join(sizes, "code", "left").select("code", "quota", F.coalesce("pool_size", F.lit(0)).cast("long").alias("pool_size")).withColumn("capacity", (F.col("pool_size") * space).cast("long")).withColumn("short", (F.col("quota") > 0) & (F.col("capacity") < F.col("quota")))


def gender_clients(names: DataFrame, count: int, seed: str = SEED) -> DataFrame:
    """(client_name, gender, turn, tier): `count` clients, masculine and feminine in turn by hash; made-up ones where a side runs out."""
    spark = names.sparkSession
    order = Window.partitionBy("gender").orderBy("hash", "client_name")
    rows = names.select("client_name", gender_of(F.col("client_name")).alias("gender")).where("gender is not null").distinct().withColumn("hash", F.md5(F.concat("client_name", F.lit(seed))))
    real = rows.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= (count + 1) // 2).withColumn("tier", F.lit(1))
    surnames = names.select(last(tokens(F.col("client_name"))).alias("surname")).distinct().orderBy(F.md5(F.concat("surname", F.lit(seed)))).limit(max(64, count))
    pairs = spark.createDataFrame([(x, g) for x, y in v.GENDERED for x, g in ((x, "masculine"), (y, "feminine"))], "given string, gender string").distinct()
    made = surnames.crossJoin(F.broadcast(pairs)).where(folded(F.col("surname")) != folded(F.col("given")))  # curated pairs by a bounded list
    made = made.select(F.concat_ws(" ", "given", "surname").alias("client_name"), "gender").join(rows.select("client_name"), "client_name", "left_anti")
    have = real.groupBy("gender").agg(F.max("turn").alias("have"))
    made = made.withColumn("hash", F.md5(F.concat("client_name", F.lit(seed)))).withColumn("at", F.row_number().over(order)).join(F.broadcast(have), "gender", "left")
    made = made.withColumn("turn", F.col("at") + F.coalesce("have", F.lit(0))).where(F.col("turn") <= (count + 1) // 2).withColumn("tier", F.lit(2))
    both = real.select("client_name", "gender", "turn", "tier").unionByName(made.select("client_name", "gender", "turn", "tier"))
    return both.orderBy("turn", F.desc("gender")).limit(count)
