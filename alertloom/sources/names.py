"""Name sources: CSV files, the built-in pools, generated names; cleaning and first-wins deduplication."""

from __future__ import annotations

import warnings
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vocab as v
from ..functions.strings import capitalised, joined, pick, tokens, words

#: What a CSV reader of data frames takes as missing.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def name_column(columns: list[str], wanted: str | None = None) -> str:
    if wanted in columns:
        return wanted
    return next((c for c in columns if c.strip().lower() in v.NAME_COLUMNS), columns[0])


def read_names(spark: SparkSession, path: str, column: str | None = None, multi_line: bool = True) -> DataFrame:
    """(raw, ord): the name column of a CSV file without missing values; no rows if the file isn't there.

    Quoted fields may hold line ends; without multi_line they may not, and a large file is split among tasks.
    """
    empty = spark.createDataFrame([], "raw string, ord long")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return empty
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)
    if not df.columns:
        return empty
    raw = F.col(f"`{name_column(df.columns, column)}`").cast("string")
    return df.select(raw.alias("raw")).where(F.col("raw").isNotNull() & ~F.col("raw").isin(MISSING)).withColumn("ord", F.monotonically_increasing_id())


def is_entity(name: Column) -> Column:
    """Some word of letters alone is one of the keywords; those with dots never are."""
    return F.arrays_overlap(F.regexp_extract_all(F.upper(name), F.lit(r"(?U)\b[A-Za-z]+\b"), F.lit(0)), words(v.ENTITY_WORDS))


def inverted(name: Column) -> Column:
    """`Surname, Given` as `Given Surname`, at the first comma."""
    parts = F.split(name, ",", 2)
    return F.when(name.contains(","), F.concat(F.trim(F.get(parts, F.lit(1))), F.lit(" "), F.trim(F.get(parts, F.lit(0))))).otherwise(name)


def honorific_key(token: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(token, "[.,]", "")))


def without_titles(name: Column) -> Column:
    return joined(F.filter(tokens(name), lambda t: (honorific_key(t) != "") & ~honorific_key(t).isin(v.HONORIFICS)))


def cased(word: Column) -> Column:
    parts = F.array_join(F.transform(F.split(word, "-"), capitalised), "-")
    one_case = (F.upper(word) == word) & (F.lower(word) != word) | (F.lower(word) == word) & (F.upper(word) != word)
    return F.when(word.contains("-"), parts).when(F.lower(word).isin(v.PARTICLES) | one_case, capitalised(word)).otherwise(word)


def strip_quotes(raw: Column) -> Column:
    return F.btrim(F.btrim(F.regexp_replace(raw, r"(?U)^\s+|\s+$", ""), F.lit('"')), F.lit("'"))


def clean(raw: Column) -> Column:
    """The normalised name, or null for what isn't a person's name of two tokens or more."""
    name = strip_quotes(raw)
    full = joined(F.transform(tokens(without_titles(inverted(name))), cased))
    return F.when((name == "") | is_entity(name), None).when(F.size(tokens(full)) >= 2, full)


def well_formed(name: Column) -> Column:
    """No token with a digit, and none with a dot but single initials."""
    return ~F.exists(tokens(name), lambda t: t.rlike(r"(?U)\d") | t.contains(".") & ~t.rlike(r"^[A-Za-z]\.$"))


def world_names(spark: SparkSession) -> DataFrame:
    rows = [(n, region) for region, names in v.WORLD_NAMES.items() for n in names]
    return spark.createDataFrame([(n, r, k) for k, (n, r) in enumerate(rows)], "name string, region string, ord long")


def locale_names(locale: str) -> tuple[list[str], list[str]] | None:
    """Given names and surnames that a locale draws from, those of its region; None for a locale that isn't known."""
    region = v.REGION_OF.get(locale.partition("_")[0].lower())
    names = v.WORLD_NAMES.get(region, [])
    return (sorted({n.split()[0] for n in names}), sorted({n.split()[-1] for n in names})) if names else None


def generated_names(spark: SparkSession, per_locale: int = 150, locales: list[str] | None = None, middle_share: float = 0.35, seed: str = "42") -> DataFrame:
    """(name, ord): invented names per locale from the given names and surnames of its region; every fifth as the locale writes them, a share with a middle name.

    Locales that aren't known are left out, with a warning.
    """
    known = [(k, x, *found) for k, x in enumerate(locales or v.LOCALES) if (found := locale_names(x))]
    for x in locales or ():
        if locale_names(x) is None:
            warnings.warn(f"locale {x!r} isn't known and is left out", stacklevel=2)
    if per_locale <= 0 or not known:
        return spark.createDataFrame([], "name string, ord long")
    places = spark.createDataFrame(known, "place long, locale string, givens array<string>, families array<string>")
    rows = places.crossJoin(F.broadcast(spark.range(per_locale).withColumnRenamed("id", "ix")))  # both sides are parameters of a few rows
    key = F.concat_ws("|", "locale", F.col("ix").cast("string"))
    one = lambda salt, xs: F.get(xs, pick(key, salt, F.size(xs), seed).cast("int"))
    given, second, family = one("given", F.col("givens")), one("second", F.col("givens")), one("family", F.col("families"))
    share = pick(key, "share", 1000, seed) < int(1000 * middle_share)
    name = F.when((F.col("ix") > 0) & (F.col("ix") % 5 == 0), F.concat_ws(" ", F.lit("Dr."), given, family)).when(share, F.concat_ws(" ", given, second, family)).otherwise(F.concat_ws(" ", given, family))
    made = rows.select(clean(name).alias("name"), (F.col("place") * per_locale + F.col("ix")).alias("ord"))
    return made.where(F.col("name").isNotNull() & well_formed(F.col("name")))


def first_wins(names: DataFrame, *order: str) -> DataFrame:
    """One row per name in lower case: the first by `order`."""
    at = F.row_number().over(Window.partitionBy(F.lower("name")).orderBy(*order))
    return names.withColumn("_at", at).where("_at = 1").drop("_at")


def load_names(spark: SparkSession, path: str | None = None, column: str | None = None, augment: bool = True, generate: bool = True, per_locale: int = 150, locales: list[str] | None = None, seed: str = "42") -> DataFrame:
    """(name, src, ord): CSV names cleaned, then built-in names verbatim, then generated ones; the first spelling of a name stays."""
    found = read_names(spark, path, column).select(clean(F.col("raw")).alias("name"), F.lit(0).alias("rank"), F.lit("csv").alias("src"), "ord").where("name is not null") if path else None
    if found is not None and not augment and found.limit(1).count() == 0:
        augment = True
    parts = [found] if found is not None else []
    if augment or found is None:
        parts.append(world_names(spark).select("name", F.lit(1).alias("rank"), F.lit("world").alias("src"), "ord"))
    if generate:
        parts.append(generated_names(spark, per_locale, locales, seed=seed).select("name", F.lit(2).alias("rank"), F.lit("generated").alias("src"), "ord"))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return first_wins(whole, "rank", "ord", "name").select("name", "src", "ord")


def write_alerts(alerts: DataFrame, path: str, single: bool = False, rows_per_file: int = 0) -> None:
    """The output columns as CSV with a header, quotes doubled; one file if `single`, files of at most rows_per_file rows if that is given."""
    df = alerts.select(*v.OUTPUT)
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").option("maxRecordsPerFile", rows_per_file).csv(path)


def append_alerts(alerts: DataFrame, path: str) -> None:
    """Add rows to a folder of CSV files; each append is committed whole."""
    alerts.select(*v.OUTPUT).write.mode("append").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{c} string" for c in v.OUTPUT)
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).option("nullValue", "\0").option("emptyValue", "").csv(path).select(*v.OUTPUT)


def local_weights(raw: str | None) -> str:
    """Text of a weights argument: inline JSON, or the content of the file it names."""
    raw = (raw or "").strip()
    return Path(raw).read_text(encoding="utf-8") if raw and not raw.startswith("{") else raw
