"""URL filter: an allow and block list first, mined association rules for the rest.

`mine_rules` runs Spark's FP-growth over the tokens of labelled URLs and keeps the combinations whose support,
confidence and lean towards "block" are high enough and of which no part is a rule by itself (a longer rule
fires only where the shorter one does). `fired` matches them through an inverted index: a rule stands under its
rarest token only, so a URL meets just the rules of its own tokens, by ordinary joins. A URL is blocked if a rule
fires, else allowed.

FP-growth lists 2**n combinations of n tokens that often stand together, so what it is given is kept short.
Without loss: tokens under the least support leave, tokens that stand in exactly the same labelled URLs count as
one (its class), in mining and in matching, and a class that is a rule by itself is in no longer rule. Spark's
FP-growth gets the URLs of at most MOST_ITEMS classes; what it finds is counted again over all URLs.

Every combination that some longer blocked URL holds is found by a growth of our own (`_grown`), over all labelled
URLs, whatever their length: the same conditional bases, one task for each rarest class, but no branch is followed that can't end in a
shortest rule. A branch ends at a rule, and where a class spares no allowed URL: without it the combination would
have as few allowed URLs and no fewer blocked ones, so confidence and lean would be no less. So of n tokens that stand together
2**n combinations are not listed, unless allowed URLs hold as many of their combinations. Nothing is left out: what
grows with such tables is time, and the number of rules.

Defined cases: a null URL or one without `://` has an empty host and path and no tokens; labels with a null
id or null marks are ignored, repeated ids are blocked if any row says so; a page's rows are as many labelled
URLs; without labels, or without enough blocked ones, no rule is mined; repeated pages are judged alike, row by
row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut, parts, table

BLOCKED = "=block"
#: (verdict, host, path): a rule fits its host and all subdomains if the path starts with its path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: A rule's support, as a share of the labelled URLs and as their number; its confidence; its lean in standard errors.
MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE, MIN_LEAN = 0.002, 20, 0.6, 3.0
MOST_ITEMS = 10
RULE = "key string, antecedent array<string>, confidence double, support double"


def rest_of(url: str) -> Column:
    at = F.coalesce(F.locate("://", F.col(url)), F.lit(0))
    return F.when(at > 0, F.substring(F.col(url), at + 3, F.length(F.col(url)))).otherwise("")


def host_and_path(url: str) -> tuple[Column, Column]:
    rest = rest_of(url)
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def listed(host: str, path: str, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (ties: the first by text) as `host/path`, and its verdict; null if none fits. The list is configuration, a handful of entries."""
    rule = verdict = F.lit(None).cast("string")
    for action, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = ((F.col(host) == h) | F.col(host).endswith(f".{h}")) & F.col(path).startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def tokens(url: str) -> Column:
    """Distinct tokens: host labels, path segments (numbers as one token), query keys, presence of a fragment."""
    host, path = host_and_path(url)
    mark = lambda kind, xs: F.transform(F.filter(xs, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    query = F.split(F.regexp_extract(rest_of(url), r"^[^?#]*\?([^#]*)", 1), "&")
    words = F.transform(F.split(path, "/"), lambda s: F.regexp_replace(s, "[0-9]+", "0"))
    return F.array_distinct(F.concat(mark("h:", F.split(host, r"\.")), mark("p:", words), mark("q:", F.transform(query, lambda q: F.substring_index(q, "=", 1))), F.when(F.contains(rest_of(url), F.lit("#")), F.array(F.lit("f:"))).otherwise(F.array().cast("array<string>"))))


def _grown(rest: list[list[str]], good: np.ndarray, bad: np.ndarray, far: np.ndarray, need: int, strong) -> Iterator[tuple[list[str], int, int]]:
    """(classes, docs, bad) of the rules that a head and classes of `rest` make and of which no class could be spared.

    rest: the other classes of the URLs that hold the head; good, bad: how many are allowed, blocked; far: whether a
    longer blocked one is among them. A base holds the URLs with all classes taken (miss is -1) or all but one (miss
    is its place), the latter as proof that this class spares an allowed URL.
    """
    names = sorted({x for r in rest for x in r})
    number = {x: k for k, x in enumerate(names)}
    row = np.repeat(np.arange(len(rest)), [len(r) for r in rest])
    item = np.fromiter((number[x] for r in rest for x in r), np.int64, len(row))
    todo = [([], np.arange(len(rest)), np.full(len(rest), -1), row, item)]  # classes taken; URL and miss of each place; entries: place, class
    while todo:
        taken, url, miss, row, item = todo.pop()
        n, at = len(taken) + 1, (miss + 1)[row] * len(names) + item
        goods = np.bincount(at, good[url][row], n * len(names)).reshape(n, -1)
        whole = (miss == -1)[row]
        bads, fars = (np.bincount(item[whole], x[url][row][whole], len(names)) for x in (bad, far))
        rules = strong(goods[0] + bads, bads)
        for k in np.flatnonzero((bads >= need) & (fars > 0) & (goods[0] < good[url][miss == -1].sum()) & (goods[1:] > 0).all(axis=0)):
            if rules[k]:
                yield [names[x] for x in [*taken, k]], int(goods[0][k] + bads[k]), int(bads[k])
                continue
            holds = np.zeros(len(url), bool)
            holds[row[item == k]] = True
            left = holds | (miss == -1) & (good[url] > 0)
            place = np.cumsum(left) - 1
            on = left[row] & (item > k)
            if on.any():
                todo.append(([*taken, k], url[left], np.where(holds, miss, len(taken))[left], place[row[on]], item[on]))


def _long_rules(rows: DataFrame, need: int, strong) -> DataFrame | None:
    """(antecedent, docs, bad): every shortest rule of several classes that a blocked row (uid, block, items by rarity) of more than MOST_ITEMS holds, maybe with some that aren't shortest; None without such rows."""
    rows = rows.withColumn("far", ((F.size("items") > MOST_ITEMS) & (F.col("block") == 1)).cast("long"))
    if rows.where("far = 1").isEmpty():
        return None
    wanted = rows.where("far = 1").select(F.explode("items").alias("class")).distinct()
    held = rows.select("uid", "block", "far", F.posexplode("items").alias("at", "class")).join(wanted, "class", "left_semi")
    held = held.groupBy("uid", "block", "far").agg(F.array_sort(F.collect_list(F.struct("at", "class"))).alias("x"))
    heads = held.select("block", "far", F.col("x.class").alias("items")).select("*", F.explode(F.sequence(F.lit(1), F.size("items"))).alias("k"))
    heads = heads.select(F.element_at("items", F.col("k")).alias("head"), F.slice("items", F.col("k") + 1, F.size("items")).alias("rest"), "block", "far")
    base = heads.groupBy("head", "rest").agg(F.sum(1 - F.col("block")).alias("good"), F.sum("block").alias("bad"), F.max("far").alias("far"))

    def run(key: tuple, t: pa.Table) -> pa.Table:
        found = list(_grown(t.column("rest").to_pylist(), *(t.column(c).to_numpy().astype(np.float64) for c in ("good", "bad", "far")), need, strong))
        return pa.table({"antecedent": pa.array([sorted([key[0].as_py(), *x]) for x, _, _ in found], pa.list_(pa.string())), **{c: pa.array([r[k] for r in found], pa.int64()) for k, c in ((1, "docs"), (2, "bad"))}})

    return base.groupBy("head").applyInArrow(run, "antecedent array<string>, docs long, bad long")


def _under(rules: DataFrame, sizes: DataFrame) -> DataFrame:
    """rules with key, the class of the antecedent that the fewest labelled URLs hold."""
    keyed = rules.withColumn("key", F.explode("antecedent")).join(sizes.select(F.col("class").alias("key"), F.col("docs").alias("of")), "key")
    return keyed.groupBy("antecedent").agg(F.min_by("key", F.struct("of", "key")).alias("key"), *[F.first(c).alias(c) for c in rules.columns if c != "antecedent"])


def _holding(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Pairs of rows (items) and rules (key, antecedent) all of whose classes the row holds."""
    return rows.withColumn("key", F.explode("items")).join(rules, "key").where(F.size(F.array_except("antecedent", "items")) == 0)


def _shortest(rules: DataFrame) -> DataFrame:
    """The rules of which no part is one. No class of a rule of several is a rule by itself, so pairs always stay."""
    subsets = F.aggregate("antecedent", F.array(F.array().cast("array<string>")), lambda done, x: F.concat(done, F.transform(done, lambda s: F.array_append(s, x))))
    size = F.size("antecedent")
    few = rules.where((size > 2) & (size <= MOST_ITEMS)).select("antecedent", F.explode(subsets).alias("part")).where((F.size("part") > 1) & (F.size("part") < size))
    few = few.join(rules.select(F.col("antecedent").alias("part")), "part", "left_semi").select("antecedent")
    inner = rules.select("key", F.col("antecedent").alias("part"))
    many = rules.where(size > MOST_ITEMS).select("antecedent").withColumn("key", F.explode("antecedent")).join(inner, "key")
    many = many.where((F.size("part") < size) & (F.size(F.array_except("part", "antecedent")) == 0)).select("antecedent")
    return rules.join(few.unionAll(many).distinct(), "antecedent", "left_anti")


def mine_rules(urls: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_count: int = MIN_COUNT, min_lean: float = MIN_LEAN) -> tuple[DataFrame, DataFrame]:
    """Rules (key, antecedent, confidence, support) over classes of tokens, and (token, class) for the classes they name.

    urls: (id, url); labels: (id, block int); key: the antecedent's rarest class.
    """
    spark = urls.sparkSession
    marks = labels.where("id is not null and block is not null").groupBy("id").agg(F.max(F.when(F.col("block") == 1, 1).otherwise(0)).alias("block"))
    told = cut(urls.join(marks, "id").select(F.monotonically_increasing_id().alias("uid"), "block", tokens("url").alias("items")))
    n, bad = told.agg(F.count("*"), F.coalesce(F.sum("block"), F.lit(0))).first()
    least, base = max(min_count, math.ceil(min_support * n), 1), bad / max(n, 1)
    none = spark.createDataFrame([], RULE), spark.createDataFrame([], "token string, class string")
    if bad < least:
        return none
    each = told.select("uid", "block", F.explode("items").alias("token"))
    name = [F.sum(F.xxhash64(F.lit(k), "uid").cast("decimal(38,0)")).alias(f"s{k}") for k in range(2)]  # the same for tokens of the same rows only
    counts = each.groupBy("token").agg(F.count("*").alias("docs"), F.sum("block").alias("bad"), *name).where(F.col("bad") >= least)
    classes = cut(counts.withColumn("class", F.min("token").over(Window.partitionBy("docs", "bad", "s0", "s1"))).select("token", "class", "docs", "bad"))
    sizes = classes.where("token = class").select("class", "docs", "bad")
    strong = (F.col("bad") >= least) & (F.col("bad") >= F.col("docs") * min_confidence) & (F.col("bad") - F.col("docs") * base >= min_lean * F.sqrt(F.col("docs") * (base * (1 - base))))
    figures = [(F.col("bad") / F.col("docs")).alias("confidence"), (F.col("bad") / n).alias("support")]
    rules = sizes.where(strong).select(F.col("class").alias("key"), F.array("class").alias("antecedent"), *figures)
    weak = sizes.where(~strong).select(F.col("class").alias("token"), "class", "docs")
    rows = each.join(weak, "token").groupBy("uid", "block").agg(F.sort_array(F.collect_list(F.struct("docs", "class"))).alias("x"))
    rows = cut(rows.select("uid", "block", F.col("x.class").alias("items")))
    marked = F.when(F.col("block") == 1, F.array_append("items", F.lit(BLOCKED))).otherwise(F.col("items"))
    baskets = cut(rows.where(F.size("items") <= MOST_ITEMS).select(marked.alias("items")))
    many, several = baskets.count(), []
    if many >= least:
        found = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / many, minConfidence=1.0, numPartitions=parts(spark)).fit(baskets).freqItemsets
        found = found.where(F.array_contains("items", BLOCKED) & (F.size("items") > 2)).select(F.array_sort(F.array_remove("items", BLOCKED)).alias("antecedent"))
        keyed = cut(_under(found, sizes))
        several.append(_holding(rows, keyed).groupBy("antecedent").agg(F.count("*").alias("docs"), F.sum("block").alias("bad")))
    need = max(least, math.ceil(min_lean**2 * base / (1 - base) - 1e-6)) if base < 1 else least  # fewer can't lean enough, even without an allowed URL
    spread = base * (1 - base)
    grown = _long_rules(rows, need, lambda docs, bad: (bad >= least) & (bad >= docs * min_confidence) & (bad - docs * base >= min_lean * np.sqrt(docs * spread)))
    for more in several + ([] if grown is None else [grown]):
        more = cut(more.where(strong))
        rules = rules.unionByName(_under(more, sizes).select("key", "antecedent", *figures))
    rules = cut(rules.dropDuplicates(["antecedent"]))
    rules = cut(_shortest(rules).select("key", "antecedent", "confidence", "support"))
    named = rules.select(F.explode("antecedent").alias("class")).distinct()
    return rules, cut(classes.join(named, "class", "left_semi").select("token", "class"))


def fired(urls: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """The distinct urls (column url) for which some rule's classes are all there, with the confidence of the best."""
    have = urls.where("url is not null").select("url").distinct().withColumn("token", F.explode(tokens("url")))
    have = have.join(classes, "token").groupBy("url").agg(F.collect_set("class").alias("items"))
    return _holding(have, rules).groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """pages (page_id, url) and labels (id, block) -> page_id, host, path, rule, verdict, confidence."""
    pages = pages.select("page_id", "url")
    mined, classes = mine_rules(pages.select(F.col("page_id").alias("id"), "url"), labels)
    host, path = host_and_path("url")
    rule, verdict = listed("host", "path", rules)
    out = pages.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "verdict": verdict})
    hit = fired(out.where("verdict is null"), mined, classes)
    out = out.join(hit, "url", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")).alias("verdict"), "confidence")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page counts as labelled block if the label of the same number marks it toxic or of low quality."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0).alias("block"))
    return judge(table(spark, sf_dir, "pages"), labels)
