"""From candidates to alerts: assert the label, keep one code per pair, rank by hash, fill the quotas.

Nothing here depends on the order of rows: ranks come from hashes of the pair, so a retried task or another
number of partitions gives the same alerts.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab as v
from ..functions.strings import ABSENT, SEED, compose, decision_of, differing, joined, label_of, last, lookup, middle, pick, pick_from, tokens, trimmed_lower, walk_middle, walk_note
from ..operators.audit import problem_under
from ..operators.capability import capable, gender_clients, gender_of
from ..operators.mutate import candidates
from ..sources.scratch import cut

#: Candidates that the clients taken could yield for each record of a quota, how many are drawn, and how many in any case.
SPARE, DRAWN, FEW = 4, 2, 2000
#: Tries of the free-running mode for each record asked for, before it gives up.
TRIES = 40


def pair_key(client: Column, hit: Column) -> Column:
    return F.concat_ws("\x1f", trimmed_lower(client), trimmed_lower(hit))


def pair_rank(seed: str = SEED) -> Column:
    return F.md5(F.concat_ws("|", "code", "client_name", "hit_name", F.lit(seed)))


def _below(hexes: Column, share: float) -> Column:
    """Whether the number that the first five hex digits give, of 20 bits, is below a share of all."""
    return F.conv(F.substring(hexes, 1, 5), 16, 10).cast("long") < int((1 << 20) * min(1.0, share) + 1)


def _need(code: str, quota: int) -> int:
    return max(64, -(-SPARE * quota // max(1, min(v.VARIANTS[code], 4))))


def thinned(pool: DataFrame, code: str, quota: int, size: int, seed: str = SEED) -> DataFrame:
    """Clients of a code's pool, by hash as many as SPARE * quota need, so that variants of the others are never made.

    What a client yields is much more than its name, so many are dealt anew to all tasks.
    """
    need = _need(code, quota)
    rows = pool.where(F.col("code") == code).select("client_name").distinct()
    if size > need:
        rows = rows.where(_below(F.md5(F.concat("client_name", F.lit(f"{code}{seed}"))), 1.5 * need / size))
    if min(size, need) * v.VARIANTS[code] > FEW:
        rows = rows.repartition(pool.sparkSession.sparkContext.defaultParallelism, "client_name")
    return rows


def drawn(found: DataFrame, code: str, quota: int, size: int, seed: str = SEED) -> DataFrame:
    """Candidates of the least ranks, about DRAWN * quota of them, FEW at least: the others would lose in the end, so their traces are never written."""
    clients = min(size, 1.5 * _need(code, quota))
    share = 1.5 * max(DRAWN * quota, FEW) / max(1.0, clients * v.VARIANTS[code])
    return found if size == 0 or share >= 1 else found.where(_below(pair_rank(seed), share))


def all_candidates(pool: DataFrame, quotas: dict[str, int], seed: str = SEED, whole_pools: Collection[str] = ()) -> DataFrame:
    """Candidates of every planned code whose label holds, by the independent audit; of whole_pools all of all clients."""
    sizes = {r["code"]: r["n"] for r in pool.groupBy("code").agg(F.countDistinct("client_name").alias("n")).collect()}  # a row per code
    whole = None
    for code in v.CODES:
        if quotas.get(code, 0) > 0:
            size = 0 if code in whole_pools else sizes.get(code, 0)
            found = candidates(thinned(pool, code, quotas[code], size, seed), code)
            one = audited(drawn(found, code, quotas[code], size, seed), code)
            whole = one if whole is None else whole.unionAll(one)
    return whole


def audited(found: DataFrame, code: str) -> DataFrame:
    """Candidates of a code whose label holds.

    The audit names the hit, its tokens and the differing ones many times; as a generator's output each is made once,
    where a filter pushed below their projections would make them anew each time.
    """
    columns = found.columns
    made = found.select(F.inline(F.array(F.struct(*columns))))
    made = made.select(F.inline(F.array(F.struct(*columns, tokens(F.col("client_name")).alias("_c"), tokens(F.col("hit_name")).alias("_h")))))
    made = made.select(F.inline(F.array(F.struct(*columns, "_c", "_h", differing(F.col("_c"), F.col("_h")).alias("_d")))))
    return made.where(problem_under(F.col("client_name"), F.col("hit_name"), code, F.col("_c"), F.col("_h"), F.col("_d")).isNull()).select(*columns)


def unique_pairs(found: DataFrame, quotas: dict[str, int], seed: str = SEED) -> DataFrame:
    """One row per pair of names: that of the code with the least supply for its quota (ties by code), then the least rank."""
    supply = found.groupBy("code").agg(F.count("*").alias("supply"))
    plan = found.sparkSession.createDataFrame(sorted(quotas.items()), "code string, quota long")
    scarce = supply.join(F.broadcast(plan), "code").select("code", (F.col("supply") / F.col("quota")).alias("ratio"))
    rows = found.join(F.broadcast(scarce), "code").withColumn("rank", pair_rank(seed))  # a row per code
    at = F.row_number().over(Window.partitionBy(pair_key(F.col("client_name"), F.col("hit_name"))).orderBy("ratio", "code", "rank", "variant_ix"))
    return rows.withColumn("_at", at).where("_at = 1").drop("_at", "ratio")


#: Hex digits of a rank by which a code's pairs are numbered in parts.
BUCKET = 3


def fill(pairs: DataFrame, plan: DataFrame) -> DataFrame:
    """pairs (with rank; written, as they are read twice) up to each code's quota, numbered by slot.

    The pairs of each code are counted by the first digits of their rank, at most 16**BUCKET counts a code. Parts
    beyond the quota leave before anything is sorted, and each other part is ranked by itself, behind those before it.
    """
    spark = pairs.sparkSession
    pairs = pairs.withColumn("_part", F.substring("rank", 1, BUCKET))
    counts = pairs.groupBy("code", "_part").agg(F.count("*").alias("n")).join(F.broadcast(plan.where("quota > 0").select("code", "quota")), "code").collect()
    starts, before = [], {}
    for r in sorted(counts, key=lambda r: (r["code"], r["_part"])):
        at = before.get(r["code"], 0)
        if at < r["quota"]:
            starts.append((r["code"], r["_part"], at, r["quota"]))
        before[r["code"]] = at + r["n"]
    parts = F.broadcast(spark.createDataFrame(starts, "code string, _part string, _before long, quota long"))  # at most 16**BUCKET rows a code
    at = F.row_number().over(Window.partitionBy("code", "_part").orderBy("rank", "variant_ix"))
    return pairs.join(parts, ["code", "_part"]).withColumn("slot", at + F.col("_before")).where(F.col("slot") <= F.col("quota")).drop("_part", "_before")


def shortfall(filled: DataFrame, plan: DataFrame) -> dict[str, str]:
    """code -> what it has of its quota, for the codes that are short."""
    got = filled.groupBy("code").agg(F.count("*").alias("n"))
    rows = plan.join(got, "code", "left").where(F.coalesce("n", F.lit(0)) < F.col("quota")).select("code", "quota", F.coalesce("n", F.lit(0)).alias("n")).orderBy("code").collect()
    return {r["code"]: f"{r['code']}: {r['n']} of {r['quota']}" for r in rows}


def as_alerts(filled: DataFrame, created_by: str = "rule_based") -> DataFrame:
    return filled.select("client_name", "hit_name", "matching_text", F.col("code").alias("disposition_code"), label_of(F.col("code")).alias("disposition_label"), "thinking", decision_of(F.col("code")).alias("decision"), F.lit(created_by).alias("created_by"))


def reserved_exact(names: DataFrame, count: int, seed: str = SEED) -> DataFrame:
    """`count` distinct names by hash, without replacement; ValueError if there are fewer."""
    rows = names.select("client_name").distinct()
    if count > rows.count():
        raise ValueError(f"cannot take {count} exact matches from fewer distinct names")
    return rows.orderBy(F.md5(F.concat("client_name", F.lit(f"exact{seed}"))), "client_name").limit(max(0, count))


def _gap_walk(client: Column, hit: Column) -> tuple[Column, Column, Column]:
    c, h = tokens(client), tokens(hit)
    uneven = F.when(F.least(F.size(c), F.size(h)) > 2, walk_note(joined(middle(c)), joined(middle(h)))).otherwise("absent from one or both records")
    return walk_note(c[0], h[0]), F.when(F.size(c) == F.size(h), walk_middle(c, h)).otherwise(uneven), walk_note(last(c), last(h))


def legacy_pairs(names: DataFrame, decision: str, attempts: int = 4, double_after: int = 3, seed: str = SEED, since: int = 0) -> DataFrame:
    """Free-running pairs: for each client and attempt (from `since`, below `attempts`) one operator by hash, with its fallbacks; later attempts mutate twice.

    (client_name, attempt, hit_name, matching_text, code, thinking). A doubly mutated pair carries the label of the
    second step, so it may fail the audit, as in free-running mode it always could.
    """
    fp = decision == v.DISQUALIFY
    last_step = "DISP_SURNAME_CONFLICT" if fp else "DISP_MINOR_TYPO"
    menu = ["DISP_SURNAME_CONFLICT", "DISP_MIDDLE_NAME_CONFLICT", "DISP_PHONETIC_SURNAME_DIVERGENCE"] if fp else ["DISP_MINOR_TYPO", "DISP_TOKEN_ORDER_SWAP", "MIDDLE", "DISP_TRANSLITERATION_VARIANT", "DISP_DIACRITIC_STRIPPED", "DISP_COMPOUND_NAME_RESTRUCTURED", "DISP_MIDDLE_NAME_OMITTED"]
    fallback = {"DISP_TRANSLITERATION_VARIANT": "DISP_MINOR_TYPO", "DISP_DIACRITIC_STRIPPED": "DISP_MINOR_TYPO", "DISP_COMPOUND_NAME_RESTRUCTURED": "DISP_TOKEN_ORDER_SWAP"}
    clients = cut(names.select("client_name").distinct())
    tries = clients.select("client_name", F.explode(F.sequence(F.lit(since), F.lit(attempts - 1))).alias("attempt"))
    key = F.concat_ws("|", "client_name", F.col("attempt").cast("string"))
    tries = tries.withColumn("wanted", pick_from(menu, key, f"menu/{decision}", seed))

    def one_each(frame: DataFrame, code: str) -> DataFrame:
        """For each (client_name, attempt) of frame one candidate of the code, by hash."""
        made = candidates(frame.select("client_name").distinct(), code)
        order = Window.partitionBy("client_name", "attempt").orderBy(F.md5(F.concat_ws("|", "hit_name", F.col("attempt").cast("string"), F.lit(seed))), "variant_ix")
        return frame.select("client_name", "attempt").join(made, "client_name").withColumn("_at", F.row_number().over(order)).where("_at = 1").drop("_at", "variant_ix")

    parts = []
    for want in menu:
        asked = tries.where(F.col("wanted") == want)
        codes = ["DISP_MIDDLE_NAME_ABBREVIATED", "DISP_MIDDLE_INITIAL_EXPANDED", "DISP_MIDDLE_NAME_OMITTED"] if want == "MIDDLE" else [want]
        if want == "MIDDLE":
            t = tokens(F.col("client_name"))
            parts += [one_each(asked.where(F.size(t) >= 3), c) for c in codes[:2]] + [one_each(asked.where(F.size(t) == 2), codes[2])]
            continue
        made = one_each(asked, want)
        parts.append(made)
        if want in fallback:
            parts.append(one_each(asked.join(made.select("client_name", "attempt"), ["client_name", "attempt"], "left_anti"), fallback[want]))
    first = parts[0]
    for p in parts[1:]:
        first = first.unionByName(p)
    first = cut(first)
    twice = first.where(F.col("attempt") >= double_after)
    again = one_each(twice.select(F.col("hit_name").alias("client_name"), "attempt").distinct(), last_step)
    again = twice.select("client_name", "attempt", F.col("hit_name").alias("between")).join(again.select(F.col("client_name").alias("between"), "attempt", "hit_name", "matching_text"), ["between", "attempt"])
    given, mid, surname = _gap_walk(F.col("client_name"), F.col("hit_name"))
    boundary, principle = ("BOUNDARY_SURNAME_CONFLICT", "PRINCIPLE_FP_DISTINCT") if fp else ("BOUNDARY_MINOR_TYPO", "PRINCIPLE_TP_IDENTITY")
    said = compose(F.col("client_name"), F.col("hit_name"), given, mid, surname, pick_from(v.WORDING[boundary], key, boundary, seed), pick_from(v.WORDING[principle], key, principle, seed), F.lit(last_step), F.lit(decision))
    again = again.select(F.lit(last_step).alias("code"), "client_name", "attempt", "hit_name", "matching_text", said.alias("thinking"))
    whole = first.where(F.col("attempt") < double_after).select("code", "client_name", "attempt", "hit_name", "matching_text", "thinking").unionByName(again)
    whole = cut(whole)
    same = trimmed_lower(F.col("client_name")) == trimmed_lower(F.col("hit_name"))
    instead = one_each(whole.where(same).select("client_name", "attempt"), last_step)
    return whole.where(~same).unionByName(instead.select(*whole.columns))


def gender_rows(names: DataFrame, count: int, seed: str = SEED) -> DataFrame:
    """Pairs for `count` reserved cross-gender records and some spare, masculine and feminine clients in turn (attempt)."""
    code = "DISP_GIVEN_NAME_GENDER_VARIANT"
    able = names.where(gender_of(F.col("client_name")).isNull() | capable(F.col("client_name"), code))
    clients = gender_clients(able, count + max(5, count // 5), seed).select("client_name", F.col("turn").cast("int").alias("attempt"))
    return candidates(clients, code).join(clients, "client_name")


def legacy_rows(names: DataFrame, num_tp: int, num_fp: int, num_exact: int = 0, seed: str = SEED, num_gender: int = 0) -> DataFrame:
    """Free-running mode: reserved cross-gender (of num_fp) and exact records (of num_tp) first, then pairs of either decision, each pair once, by hash up to the counts.

    (code, client_name, attempt, hit_name, matching_text, thinking, want, slot): want is -1 for cross-gender, 0 for exact,
    1 and 2 for the decisions; slot counts from 1 in each.

    A decision that is short gets more attempts for each client, twice as many a round, up to TRIES for each record (and client);
    RuntimeError if it stays short, or if a round beyond TRIES attempts brings nothing new.
    """
    wanted = {-1: num_gender, 0: num_exact, 1: num_tp - num_exact, 2: num_fp - num_gender}
    decisions = {1: v.ESCALATE, 2: v.DISQUALIFY}
    exact = candidates(reserved_exact(names, num_exact, seed), "DISP_EXACT_NAME_MATCH").withColumns({"attempt": F.lit(0), "want": F.lit(0)})
    rows = exact.select("code", "client_name", "attempt", "hit_name", "matching_text", "thinking", "want")
    if num_gender > 0:
        rows = rows.unionByName(gender_rows(names, num_gender, seed).withColumn("want", F.lit(-1)).select(*rows.columns))
    clients = max(1, names.select("client_name").distinct().count())
    first = {k: max(4, -(-2 * wanted[k] // clients)) for k in decisions}
    most = {k: max(TRIES, -(-TRIES * wanted[k] // clients)) for k in decisions}
    tried, got = dict.fromkeys(decisions, 0), dict.fromkeys(wanted, 0)
    again = [k for k in decisions if wanted[k] > 0]
    while True:
        for k in again:
            to = min(most[k], 2 * tried[k] or first[k])
            rows = rows.unionByName(legacy_pairs(names, decisions[k], to, max(3, 3 * first[k] // 4), seed, tried[k]).withColumn("want", F.lit(k)))
            tried[k] = to
        once = F.row_number().over(Window.partitionBy(pair_key(F.col("client_name"), F.col("hit_name"))).orderBy("want", "attempt", pair_rank(seed)))
        rows = cut(rows.withColumn("_at", once).where("_at = 1").drop("_at"))
        old, got = got, dict.fromkeys(wanted, 0) | {r["want"]: r["count"] for r in rows.groupBy("want").count().collect()}  # four rows
        short = [k for k in wanted if got[k] < wanted[k]]
        again = [k for k in short if k in tried and tried[k] < most[k] and (got[k] > old[k] or tried[k] < TRIES)]
        if not again:
            break
    if short:
        kinds = decisions | {-1: "cross-gender", 0: "exact"}
        raise RuntimeError(f"counts can't be met: {', '.join(f'{kinds[k]}: {got[k]} of {wanted[k]}' for k in short)}")
    order = F.row_number().over(Window.partitionBy("want").orderBy("attempt", pair_rank(seed)))
    return rows.withColumn("slot", order.cast("long")).where(F.col("slot") <= lookup(wanted, F.col("want")))


def legacy_alerts(names: DataFrame, num_tp: int, num_fp: int, num_exact: int = 0, seed: str = SEED, num_gender: int = 0) -> DataFrame:
    return as_alerts(legacy_rows(names, num_tp, num_fp, num_exact, seed, num_gender))


__all__ = ["ABSENT", "all_candidates", "as_alerts", "fill", "legacy_alerts", "legacy_pairs", "legacy_rows", "pair_key", "pick", "reserved_exact", "shortfall", "unique_pairs"]
