r"""Chat formatting over reply trees.

`reply_paths` enumerates root-to-leaf paths of reply trees by iterative self-joins (pointer doubling:
a tree of depth d takes log2(d) rounds), ranks the branches of a tree by their mean score and keeps
the best k. `format_turns` writes each turn of a chosen path as one segment

    ### User: text</turn>\n

and `read_back` parses segments again, turn by turn, without holding a conversation.

Escapes: in texts a backslash, `### ` and `</turn>` get a backslash in front; in other roles also `]`.
Roles other than user, assistant and system are written as `### [role]: `.

Defined cases: null role or text is empty; an empty table gives an empty result; repeated node ids keep
the row with the smallest (role, text); a parent that isn't in the tree makes the node a root; nodes on a
cycle have no root and are left out; ties in score go to the smaller leaf id; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

ROLES = {"user": "User", "assistant": "Assistant", "system": "System"}
NAMES = {v: k for k, v in ROLES.items()}
END = "</turn>\n"
MARK, CLOSE = "### ", "</turn>"


def turns_as_chain(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) as a reply tree in which each row answers the row before it; ties by role, then text."""
    rows = turns.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("tree"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    at = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    return rows.withColumn("node", at).select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score"))


def reply_paths(messages: DataFrame, k: int = 1) -> DataFrame:
    """(tree, path, depth, node) of the k best root-to-leaf paths of every tree; path counts from 1, depth from 0."""
    m = messages.groupBy("tree", "node").agg(F.min("parent").alias("parent"), F.coalesce(F.min("score"), F.lit(0.0)).alias("score"))
    known = m.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    m = m.join(known, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("known"), F.col("parent")).alias("parent"), "score")
    # up: the ancestor 2**i steps above, None past the root; far: steps so far; total: scores from the node up to just below `up`
    level = cut(m.select("tree", "node", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("far"), F.col("score").alias("total")))
    levels, before, done = [level], None, level.where("up is null")
    while True:
        n, left = level.agg(F.count("*"), F.count("up")).first()
        if not left or (left == before and 2 ** len(levels) > n):  # the rest stands on cycles
            break
        before = left
        # only nodes that haven't met their root go on; they look up both those and the ones that have
        rows = level.where("up is not null")
        above = rows.unionAll(done).select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("far").alias("far2"), F.col("total").alias("total2"))
        level = cut(rows.join(above, ["tree", "up"]).select("tree", "node", F.col("up2").alias("up"), (F.col("far") + F.col("far2")).alias("far"), (F.col("total") + F.col("total2")).alias("total")))
        done = done.unionAll(level.where("up is null"))
        levels.append(level)
    parents = m.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = done.join(parents, ["tree", "node"], "left_anti").withColumn("leaves", F.count("*").over(Window.partitionBy("tree")))
    leaves = cut(leaves.select("tree", "node", "leaves", (F.col("total") / (F.col("far") + 1)).alias("mean")))
    chains = leaves.where("leaves = 1").select("tree")  # a tree of one leaf is one path
    whole = done.join(chains, "tree", "left_semi").select("tree", F.lit(1).alias("path"), F.col("far").alias("depth"), "node")
    if not leaves.where("leaves > 1").limit(1).count():
        return whole
    best = Window.partitionBy("tree").orderBy(F.desc("mean"), "node")
    chosen = leaves.where("leaves > 1").withColumn("path", F.row_number().over(best)).where(F.col("path") <= k)
    nodes = chosen.select("tree", "path", "node")
    for jump in reversed(levels):
        both = nodes.join(jump.where("up is not null").select("tree", "node", "up"), ["tree", "node"], "left")
        nodes = both.select("tree", "path", F.explode(F.array_compact(F.array("node", "up"))).alias("node"))
    return whole.unionByName(nodes.distinct().join(done.select("tree", "node", F.col("far").alias("depth")), ["tree", "node"]).select("tree", "path", "depth", "node"))


def format_turns(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """(tree, path, depth, segment, loss_start, loss_end): one formatted turn; the mask, as code points of the segment, covers an assistant's text."""
    texts = messages.groupBy("tree", "node").agg(F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("m"))
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    role = F.coalesce(F.try_element_at(known, F.col("m.role")), F.concat(F.lit("["), F.regexp_replace("m.role", r"([\\\]])", r"\\$1"), F.lit("]")))
    head, body = F.concat(F.lit("### "), role, F.lit(": ")), F.regexp_replace("m.text", r"(\\|### |</turn>)", r"\\$1")
    rows = paths.join(texts, ["tree", "node"]).select("tree", "path", "depth", head.alias("head"), body.alias("body"), (F.col("m.role") == "assistant").alias("learn"))
    start = F.length("head").cast("long")
    return rows.select("tree", "path", "depth", F.concat("head", "body", F.lit(END)).alias("segment"), F.when(F.col("learn"), start).alias("loss_start"), F.when(F.col("learn"), start + F.length("body")).alias("loss_end"))


def conversations_text(turns: DataFrame) -> DataFrame:
    """(tree, path, formatted, loss): whole conversations, for those that fit a row; loss: [start, end) in code points."""
    w = Window.partitionBy("tree", "path").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    rows = turns.withColumn("at", F.coalesce(F.sum(F.length("segment")).over(w), F.lit(0)))
    span = F.when(F.col("loss_start").isNotNull(), F.struct((F.col("at") + F.col("loss_start")).alias("start"), (F.col("at") + F.col("loss_end")).alias("end")))
    got = rows.groupBy("tree", "path").agg(F.array_sort(F.collect_list(F.struct("depth", "segment", span.alias("span")))).alias("t"))
    return got.select("tree", "path", F.array_join(F.transform("t", lambda x: x["segment"]), "").alias("formatted"), F.filter(F.transform("t", lambda x: x["span"]), lambda x: x.isNotNull()).alias("loss"))


def unescape(text: str) -> str:
    """Without escapes; pairs of backslashes are found from the left, so a lone one in between is an escape."""
    return "\\".join(x.replace("\\", "") for x in text.split("\\\\")) if "\\" in text else text


def _plain(text: str, mark: str, at: int) -> int:
    """Where the next `mark` stands that no backslash escapes, or -1."""
    while (at := text.find(mark, at)) >= 0:
        n = at
        while n and text[n - 1] == "\\":
            n -= 1
        if (at - n) % 2 == 0:
            return at
        at += 1
    return -1


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text, found by searching its marks; raises ValueError on anything else."""
    out, at = [], 0
    while at < len(formatted):
        begin = at + len(MARK)
        name = next((n for n in NAMES if formatted.startswith(f"{n}: ", begin)), None)
        if name:
            role, body = NAMES[name], begin + len(name) + 2
        else:
            stop = _plain(formatted, "]", begin + 1) if formatted.startswith("[", begin) else -1
            if stop < 0 or not formatted.startswith("]: ", stop):
                raise ValueError(f"no turn at {at}")
            role, body = unescape(formatted[begin + 1 : stop]), stop + 3
        end = _plain(formatted, CLOSE, body)
        if not formatted.startswith(MARK, at) or end < 0 or not formatted.startswith(END, end):
            raise ValueError(f"no turn at {at}")
        out.append((role, unescape(formatted[body:end])))
        at = end + len(END)
    return out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state, done = None, None, []

    def close():
        done.append((*key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

    def flush():
        cols = list(zip(*done, strict=True)) or [[]] * 7
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["tree", "path", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
        done.clear()
        return out

    for b in batches:
        for tree, path, seg, lo, hi in zip(*(b.column(n).to_pylist() for n in ("tree", "path", "segment", "loss_start", "loss_end")), strict=True):
            if (tree, path) != key:
                if key is not None:
                    close()
                key, state = (tree, path), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(seg):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            if lo is not None:
                learned = unescape(seg[lo:hi])
                state[2] += len(learned)
                state[3].update(learned.encode())
            state[4] += len(seg)
        yield flush()
    if key is not None:
        close()
        yield flush()


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of what a reader gets from the formatted turns; streams each conversation in order and keeps only hash states."""
    rows = turns.select("tree", "path", "depth", "segment", "loss_start", "loss_end").repartition("tree", "path").sortWithinPartitions("tree", "path", "depth")
    return rows.mapInArrow(_read, "tree string, path int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionAll(extra)
    messages = cut(turns_as_chain(turns))
    got = read_back(format_turns(messages, reply_paths(messages)))
    return got.select(F.when(F.col("tree") != "null", F.col("tree")).cast("long").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


OP9_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (SELECT *, regexp_replace(text, '(\\|### |</turn>)', '\\\1', 'g') AS esc,
  CASE role WHEN 'user' THEN 4 WHEN 'assistant' THEN 9 WHEN 'system' THEN 6
    ELSE 2 + length(regexp_replace(role, '([\\\]])', '\\\1', 'g')) END AS role_chars FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + role_chars + length(esc)) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""
