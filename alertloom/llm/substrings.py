"""Substring dedup: repeats of at least `window` words across documents, by prefix-partitioned suffix trees.

Every word starts a suffix. The suffix tree of a corpus is never built whole: suffixes are split by a prefix of
variable length, and each part's subtree is built by itself, in memory.

1. Prefixes are counted. A suffix's shortest prefix ends with its anchor, the least hash of STEP adjacent words
   within its first `window` words, so that neighbouring suffixes share an anchor and travel as one stretch of
   text. Anchors that one document alone holds lead to no repeat and leave. The others' suffixes are counted.
2. From the counts follows the number of parts: as many as bring a part's text to GROUP_BYTES. A prefix of more
   than HOT_LOAD suffixes is lengthened to the whole window; such prefixes are found by a bitmap of fixed size.
3. A part's words are numbered in sorted order (words themselves are compared), its suffixes are sorted by
   prefix doubling, and the common lengths of neighbours give the tree's internal nodes. Below a node of depth
   `window` or more stand the holders of a repeat: all but the least lose it.
4. Below a lengthened prefix stands one node, so only its least holder matters: a task sends one suffix for each
   such window, its least, and settles the others itself.
Adjoining starts make the maximal repeats (`maximal_repeats`).

What several documents of a slice of text hold is summed up before it moves: only the least holder of a window
goes on, the others are settled where they are. There and below lengthened prefixes windows are told apart by
96 and 128 bits made of 64-bit hashes of their words. A slice has some 2e5 windows, so two different ones of a slice
are taken as equal with odds of 2e10 / 2**96 = 3e-19, 2e-11 over the 6e7 slices of 10**13 words; below lengthened
prefixes 10**13 windows meet falsely with odds of 5e25 / 2**128 = 1.5e-13. Two words of a slice share their hash
with odds of 1e-9, which counts only where the windows around them are equal.

Defined cases: null text has no words; a null doc_id counts as the smallest (as would the id -2**63, which
comes back null); rows that repeat a doc_id are no repeats of each other, but each row loses what a smaller id
holds; texts shorter than the window stay; an empty table gives an empty result; other columns are ignored, or
kept by `dedup_substrings`.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, dealt, flat, id_back, id_column, mix, packed_batch, parts, raw, runs_of, table, trim, trimmed
from .words import Slice, pack_longs, slices, unpack_longs

WINDOW, STEP = 13, 4
#: Text of a part's suffixes, aimed at; a suffix moves about so many bytes.
GROUP_BYTES, SUFFIX_BYTES = 2 << 20, 24
#: A prefix with more suffixes is lengthened to the window.
HOT_LOAD, HOT_BITS = 1 << 15, 1 << 23
#: Anchors, and single suffixes, that a task gathers before it sums them up.
GATHERED, SINGLES = 250_000, 250_000
FILED = "p int, settled boolean, anchors binary, ids binary, many binary, loads binary"
HELD = "_id long, anchor long, load long"
NODES = "p int, kind int, ids binary, tags binary, starts binary, counts binary, words binary, w binary, v binary"
#: Kinds of its rows: starts that are settled, stretches of text, single suffixes below lengthened prefixes.
SETTLED, STRETCH, SINGLE = range(3)
GONE = "_id long, tag long, start int, len int"


def anchors_of(s: Slice, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the start of each whole window of the slice: start, place of its anchor, the anchor's hash."""
    steps = runs_of(s.hashes, STEP)
    wide = window - STEP + 1
    if len(steps) < wide:
        e = np.empty(0, np.int64)
        return e, e, np.empty(0, np.uint64)
    at = np.arange(len(steps) - wide + 1)
    place = at + np.lib.stride_tricks.sliding_window_view(steps, wide).argmin(axis=1)
    ok = s.whole(window)
    return at[ok], place[ok], steps[place[ok]]


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Places where rows differ from the row before in some column."""
    n = len(columns[0])
    new = np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))[:n] if n else np.empty(0, bool)
    return np.flatnonzero(new)


def _file(window: int, shares: int):
    """Anchors with the documents that hold them and the suffixes below; what several documents of a task hold is settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def summed() -> pa.RecordBatch:
            anchor, doc, load = (np.concatenate(x) for x in zip(*gathered, strict=True))
            gathered.clear()
            order = np.lexsort((doc, anchor))
            anchor, doc, load = anchor[order], doc[order], load[order]
            if not len(anchor):
                return packed_batch([], FILED)
            at = _heads(anchor, doc)
            anchor, doc, load = anchor[at], doc[at], np.add.reduceat(load, at)
            head = _heads(anchor)
            size = np.diff(np.append(head, len(anchor)))
            several = np.repeat(size > 1, size)
            out = [(p, False, *r) for p, *r in dealt((anchor[head] % np.uint64(shares)).astype(np.int64), shares, [anchor[head], doc[head], size > 1, np.add.reduceat(load, head)], [raw("<u8"), pack_longs, raw("u1"), pack_longs])]
            out += [(p, True, *r, b"", b"") for p, *r in dealt(doc[several] % shares, shares, [anchor[several], doc[several]], [raw("<u8"), pack_longs])]
            return packed_batch(out, FILED)

        size = 0
        for s, _ in slices(batches, False):
            _, place, anchor = anchors_of(s, window)
            place, first, load = np.unique(place, return_index=True, return_counts=True)
            gathered.append((anchor[first], s.ids[s.doc[place]], load))
            size += len(place)
            if size > GATHERED:
                yield summed()
                size = 0
        if gathered:
            yield summed()

    return run


def _shared(t: pa.Table, hot_load: int) -> pa.Table:
    """(document, anchor) for anchors that more than one document holds; (null, anchor, load) for those of many suffixes; (null, null, load) of all."""
    anchors, ids, many, loads, done_anchor, done_id = [], [], [], [], [], []
    for settled, a, i, m, n in zip(*(t.column(c).to_pylist() for c in ("settled", "anchors", "ids", "many", "loads")), strict=True):
        if settled:
            done_anchor.append(np.frombuffer(a, "<u8"))
            done_id.append(unpack_longs(i))
        else:
            anchors.append(np.frombuffer(a, "<u8"))
            ids.append(unpack_longs(i))
            many.append(np.frombuffer(m, "u1").astype(bool))
            loads.append(unpack_longs(n))
    hot, hot_n, total = np.empty(0, np.uint64), np.empty(0, np.int64), 0
    if anchors:
        anchor, doc, more, load = np.concatenate(anchors), np.concatenate(ids), np.concatenate(many), np.concatenate(loads)
        order = np.lexsort((doc, anchor))
        anchor, doc, more, load = anchor[order], doc[order], more[order], load[order]
        head = _heads(anchor)
        size = np.diff(np.append(head, len(anchor)))
        shared = (doc[head] != doc[head + size - 1]) | np.logical_or.reduceat(more, head)
        held = np.repeat(shared, size) & ~more
        done_anchor.append(anchor[held])
        done_id.append(doc[held])
        load = np.add.reduceat(load, head)
        total = int(load[shared].sum())
        heavy = shared & (load > hot_load)
        hot, hot_n = anchor[head][heavy], load[heavy]
        del more, order, size, held
    a, i = np.concatenate([x.astype(np.uint64) for x in done_anchor]), np.concatenate(done_id)
    anchors, ids, many, loads, done_anchor, done_id = [], [], [], [], [], []
    trim()
    column = lambda x, there: pa.array(x.astype(np.int64), mask=~there)
    n, k = len(a), len(hot)
    place = np.arange(n + k + 1)
    anchor = np.concatenate([a, hot, np.zeros(1, np.uint64)]).view(np.int64)
    return pa.table({"_id": column(np.concatenate([i, np.zeros(k + 1, np.int64)]), place < n), "anchor": column(anchor, place < n + k), "load": column(np.concatenate([np.zeros(n, np.int64), hot_n, [total]]), place >= n)})


def _suffixes(window: int, shares: int, groups: int, hot):
    """Suffixes below shared anchors: settled where the slice holds a smaller document, else in stretches of text, or one by one where the prefix is lengthened."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.frombuffer(hot.value, np.uint8) if hot else None
        single: list[tuple[np.ndarray, ...]] = []
        size = 0

        def summed() -> pa.RecordBatch:
            w, v, ids, tags, starts = (np.concatenate(x) for x in zip(*single, strict=True))
            single.clear()
            gone = _later(ids, w, v)
            k = ~gone
            rows = dealt((w[k] % np.uint64(shares)).astype(np.int64), shares, [ids[k], tags[k], starts[k], w[k], v[k]], [pack_longs, raw("<i8"), raw("<u4"), raw("<u8"), raw("<u8")])
            out = [(groups + p, SINGLE, *r[:3], b"", b"", *r[3:]) for p, *r in rows]
            return packed_batch(out + _settled(ids[gone], tags[gone], starts[gone], shares), NODES)

        for s, (held, tags) in slices(batches, False, ("held", "tag")):
            start, place, anchor = anchors_of(s, window)
            doc = s.doc[start]
            sizes = pc.fill_null(pc.list_value_length(held), 0).to_numpy(zero_copy_only=False)
            if not sizes.sum() or not len(start):
                continue
            wanted = held.flatten().to_numpy().view(np.uint64) ^ mix(np.repeat(np.arange(len(held)), sizes).astype(np.uint64))
            ok = np.isin(anchor ^ mix(doc.astype(np.uint64)), wanted)
            start, place, anchor, doc = start[ok], place[ok], anchor[ok], doc[ok]
            w, v = runs_of(s.hashes, window)[start], runs_of(s.hashes, window, 1)[start]
            ids = s.ids[doc]
            gone = _later(ids, w, v >> np.uint64(32))
            tag = tags.to_numpy()[doc]
            local = start - s.first[doc]
            out = _settled(ids[gone], tag[gone], local[gone], shares)
            keep = ~gone
            if dense is not None:
                slot = anchor % np.uint64(HOT_BITS)
                many = keep & ((dense[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1) > 0)
                single.append((w[many], v[many], ids[many], tag[many], local[many]))
                size += int(many.sum())
                keep &= ~many
            k = np.flatnonzero(keep)
            if len(k):
                first = k[_heads(doc[k], place[k], start[k] - np.arange(len(k)))]
                count = np.diff(np.append(np.searchsorted(k, first), len(k)))
                last = start[first] + count + window - 2  # the last word of each stretch
                after = np.append(s.at, len(s.text))[last + 1]
                texts = np.empty(len(first), object)
                texts[:] = [s.text[a:b] for a, b in zip(s.at[start[first]].tolist(), after.tolist(), strict=True)]
                rows = dealt((mix(anchor[first]) % np.uint64(groups)).astype(np.int64), groups, [ids[first], tag[first], local[first], count, texts], [pack_longs, raw("<i8"), raw("<u4"), raw("<u4"), lambda x: b" ".join(x.tolist())])
                out += [(p, STRETCH, *r, b"", b"") for p, *r in rows]
            yield packed_batch(out, NODES)
            if size > SINGLES:
                yield summed()
                size = 0
        if single:
            yield summed()

    return run


def _later(ids: np.ndarray, *names: np.ndarray) -> np.ndarray:
    """Whether a row of the same names has a smaller id."""
    order = np.lexsort((ids, *names[::-1]))
    head = _heads(*(x[order] for x in names))
    out = np.zeros(len(ids), bool)
    out[order] = ids[order] > np.repeat(ids[order][head], np.diff(np.append(head, len(ids))))
    return out


def _spans(ids: np.ndarray, tags: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """ids, tags, starts, counts of adjoining starts of a row."""
    order = np.lexsort((starts, tags, ids))
    ids, tags, starts = ids[order], tags[order], starts[order]
    first = _heads(ids, tags, starts - np.arange(len(starts)))
    return [ids[first], tags[first], starts[first], np.diff(np.append(first, len(ids)))]


def _settled(ids: np.ndarray, tags: np.ndarray, starts: np.ndarray, shares: int) -> list[tuple]:
    spans = _spans(ids, tags, starts)
    rows = dealt(spans[0] % shares, shares, spans, [pack_longs, raw("<i8"), raw("<u4"), raw("<u4")])
    return [(p, SETTLED, *r, b"", b"", b"") for p, *r in rows]


def _numbered(texts: Iterable[list[bytes]]) -> np.ndarray:
    """The words of all texts as numbers in sorted order; each word is held once, beside those of one text."""
    seen: dict[bytes, int] = defaultdict(count().__next__)
    met = [np.fromiter(map(seen.__getitem__, words), np.int32, len(words)) for words in texts]
    place = np.empty(len(seen), np.int32)
    place[np.fromiter(map(seen.__getitem__, sorted(seen)), np.int64, len(seen))] = np.arange(len(seen))
    return place[np.concatenate(met)] if met else np.empty(0, np.int32)


def _dense_rank(key: np.ndarray) -> np.ndarray:
    """The place of each entry among the distinct ones, as np.unique has it, with fewer copies."""
    order = np.argsort(key)
    new = np.empty(len(key), np.int32)
    new[:1] = 0
    new[1:] = np.diff(key[order]) != 0
    out = np.empty(len(key), np.int32)
    out[order] = np.cumsum(new, dtype=np.int32)
    return out


class Subtree:
    """The suffixes of some stretches of words, sorted, with the common length of neighbours."""

    def __init__(self, words: list[bytes] | np.ndarray, lengths: np.ndarray, depth: int):
        """words: themselves or `_numbered`; lengths: words of each stretch; suffixes are told apart for `depth` words at least, and end with their stretch."""
        rank = words if isinstance(words, np.ndarray) else _numbered([words])
        self.left = np.repeat(np.cumsum(lengths).astype(np.int32), lengths) - np.arange(len(rank), dtype=np.int32)  # words up to the stretch's end
        self.levels = [rank]
        width = 1
        while width < depth:
            key = rank * np.int64(len(rank) + 2)
            there = np.flatnonzero(self.left > width)
            key[there] += rank[there + width] + 1
            del there
            rank = _dense_rank(key)
            self.levels.append(rank)
            width *= 2

    def sorted(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """places in the order of their suffixes, and the words that each has in common with the one before it (up to the depth told apart)."""
        order = places[np.argsort(self.levels[-1][places], kind="stable")].astype(np.int32)
        most = np.minimum(self.left[order[:-1]], self.left[order[1:]])
        common = np.zeros(len(most), np.int32)
        for k in range(len(self.levels) - 1, -1, -1):
            inside = np.flatnonzero(common < most)
            at = common[inside]
            # a level's numbers are equal too where both stretches end there, so the length is held down below
            same = self.levels[k][order[:-1][inside] + at] == self.levels[k][order[1:][inside] + at]
            common[inside[same]] += 1 << k
        common = np.minimum(common, most)
        return order, np.append(np.int32(0), common)[: len(order)]


def _repeats(t: pa.Table, window: int) -> pa.Table:
    """Runs of window starts that a smaller document holds too."""
    done: list[list[np.ndarray]] = [[], [], [], []]
    todo: list[list[np.ndarray]] = [[], [], [], []]
    single: list[list[np.ndarray]] = [[], [], [], [], []]
    for kind, i, g, s, c, w, v in zip(*(t.column(n).to_pylist() for n in ("kind", "ids", "tags", "starts", "counts", "w", "v")), strict=True):
        row = [unpack_longs(i), np.frombuffer(g, "<i8"), np.frombuffer(s, "<u4").astype(np.int64)]
        if kind == SINGLE:
            row += [np.frombuffer(w, "<u8"), np.frombuffer(v, "<u8")]
        else:
            row.append(np.frombuffer(c, "<u4").astype(np.int64))
        for to, x in zip((done, todo, single)[kind], row, strict=True):
            to.append(x)
    words = _numbered((text.as_py() or b"").split() for text in t.column("words"))
    if single[0]:
        ids, tags, starts, w, v = (np.concatenate(x) for x in single)
        gone = _later(ids, w, v)
        for to, x in zip(done, _spans(ids[gone], tags[gone], starts[gone]), strict=True):
            to.append(x)
    if len(words):
        ids, tags, starts, counts = (np.concatenate(x) for x in todo)
        run = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        within = np.arange(len(run), dtype=np.int32) - np.repeat((np.cumsum(counts) - counts).astype(np.int32), counts)
        lengths = counts + window - 1
        first = (np.cumsum(lengths) - lengths).astype(np.int32)
        order, common = Subtree(words, lengths, window).sorted(first[run] + within)
        # a node of this depth or more: neighbours that have a window in common
        node = np.flatnonzero(common < window)
        holder = ids[np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)[order]]
        later = holder > np.repeat(np.minimum.reduceat(holder, node), np.diff(np.append(node, len(order))))
        gone = np.zeros(len(words), bool)
        gone[order] = later
        gone = gone[first[run] + within]
        run, start = run[gone], (starts[run] + within)[gone]
        first = _heads(run, start - np.arange(len(start)))
        for to, x in zip(done, (ids[run][first], tags[run][first], start[first], np.diff(np.append(first, len(start)))), strict=True):
            to.append(x)
        del words, order, common, run, within, holder, later, gone
        trim()
    return flat(GONE, *(np.concatenate(x) if x else np.empty(0, np.int64) for x in done))


def _dense(shared: DataFrame):
    """A bitmap of the anchors with more than HOT_LOAD suffixes (HOT_BITS bits; some others may be let in), broadcast; None without any."""
    slot = F.pmod("anchor", F.lit(HOT_BITS))
    number = F.floor(slot / 32768).cast("int")
    rows = shared.where("_id is null and anchor is not null").select(number.alias("b"), (slot % 32768).alias("s")).groupBy("b").agg(F.bitmap_construct_agg("s").alias("m")).collect()  # at most HOT_BITS / 32768 rows of 4 KB
    if not rows:
        return None
    whole = np.zeros(HOT_BITS // 8, np.uint8)
    for r in rows:
        whole[4096 * r["b"] : 4096 * (r["b"] + 1)] = np.frombuffer(r["m"], np.uint8)
    return shared.sparkSession.sparkContext.broadcast(whole.tobytes())


def repeat_runs(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(rows, gone): rows are docs with _id and tag; gone has for each _id the runs (tag, start, len) of window starts that a smaller document holds.

    Texts are joined twice by _id alone, so that one exchange of them serves both joins.
    """
    if window < STEP:
        raise ValueError(f"a window has at least {STEP} words")
    shares = 4 * parts(docs.sparkSession)
    rows = docs.withColumns({"_id": id_column("doc_id"), "tag": F.xxhash64(F.coalesce("text", F.lit("")))})
    texts = rows.select("_id", "tag", "text")
    hot_load = HOT_LOAD
    filed = texts.select("_id", "text").mapInArrow(trimmed(_file(window, shares)), FILED)
    shared = cut(filed.groupBy("p").applyInArrow(lambda t: _shared(t, hot_load), HELD))
    load = shared.where("_id is null and anchor is null").agg(F.sum("load")).first()[0] or 0
    groups = max(1, -(-load * SUFFIX_BYTES // GROUP_BYTES))
    held, dense = shared.where("_id is not null").groupBy("_id").agg(F.collect_list("anchor").alias("held")), _dense(shared)
    nodes = texts.join(held, "_id", "left").select("_id", "tag", "text", "held").mapInArrow(trimmed(_suffixes(window, shares, groups, dense)), NODES)
    gone = nodes.groupBy("p").applyInArrow(lambda t: _repeats(t, window), GONE)
    return rows, gone.groupBy("_id").agg(F.collect_list(F.struct("tag", "start", "len")).alias("gone"))


def maximal_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, n_words): for each row, the longest stretches of words all of whose windows a smaller document holds too."""
    rows, gone = repeat_runs(docs, window)
    runs = rows.select("_id", "tag").join(gone, "_id").select("_id", F.array_sort(F.transform(_own(), lambda r: F.struct(r["start"].alias("start"), (r["start"] + r["len"]).alias("stop")))).alias("runs"))
    none = F.array().cast("array<struct<start:int,stop:int>>")

    def joined(done: F.Column, r: F.Column) -> F.Column:
        last = F.element_at(done, -1)
        longer = F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], r["stop"]).alias("stop")))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["stop"] >= r["start"]), F.concat(F.slice(done, 1, F.size(done) - 1), longer)).otherwise(F.concat(done, F.array(r)))

    merged = runs.where("runs is not null").select("_id", F.explode(F.aggregate("runs", none, joined)).alias("r"))
    return merged.select(id_back("_id").alias("doc_id"), F.col("r.start").cast("long").alias("start"), (F.col("r.stop") - F.col("r.start") + window - 1).cast("long").alias("n_words"))


def _own(gone: str = "gone") -> F.Column:
    """The runs of a row's own text; null if there are none."""
    runs = F.filter(gone, lambda r: r["tag"] == F.col("tag"))
    return F.when(F.size(runs) > 0, runs)


def kept_words(words: list, gone: list | None, window: int) -> list:
    """The words that no window of `gone` (runs of starts) covers."""
    if not gone:
        return words
    cover = np.zeros(len(words) + 1, np.int32)
    for r in gone:
        cover[r["start"]] += 1
        cover[min(len(words), r["start"] + r["len"] - 1 + window)] -= 1
    return [w for w, c in zip(words, np.cumsum(cover[:-1]).tolist(), strict=True) if not c]


def _read_texts(b: pa.RecordBatch, window: int):
    for t, gone in zip(b.column("text"), b.column("gone").to_pylist(), strict=True):
        words = (t.as_py() or "").encode("utf-8", "surrogatepass").split()
        yield words, kept_words(words, gone, window)


def _digests(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, len(w), len(w) - len(k), hashlib.sha256(b" ".join(k)).hexdigest()) for i, (w, k) in zip(b.column("_id").to_pylist(), _read_texts(b, window), strict=True)]
            yield packed_batch(rows, "_id long, n_words long, n_removed long, kept_sha256 string")

    return run


def substring_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    rows, gone = repeat_runs(docs, window)
    found = rows.select("_id", "tag", "text").join(gone, "_id", "left").select("_id", "text", _own().alias("gone"))
    return found.mapInArrow(_digests(window), "_id long, n_words long, n_removed long, kept_sha256 string").select(id_back("_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs, all columns, with texts that lost words holding the words kept, joined by one space; other rows are unchanged."""

    @F.pandas_udf("string")
    def rest(text: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([None if g is None else b" ".join(kept_words((t or "").encode("utf-8", "surrogatepass").split(), list(g), window)).decode() for t, g in zip(text, gone, strict=True)], dtype=object)

    inner = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # own names, so that none of docs can clash
    at = {c: F.col(f"c{k}") for k, c in enumerate(docs.columns)}
    rows, gone = repeat_runs(inner.withColumns({"doc_id": at["doc_id"], "text": at["text"]}), window)
    rows = rows.join(gone, "_id", "left").withColumn("gone", _own())
    less = rest(F.when(F.col("gone").isNotNull(), F.col("text")), "gone")  # texts that lose nothing stay where they are
    got = rows.withColumn("left", F.coalesce(less, "text"))
    new = {"text": F.col("left"), "n_chars": F.when(F.col("gone").isNull(), at.get("n_chars", F.lit(None))).otherwise(F.length("left").cast("long"))}
    return got.select(*[new.get(c, at[c]).alias(c) for c in docs.columns])


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), WINDOW)


OP7_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS a FROM documents),
s AS (SELECT doc_id, i, array_to_string(a[i + 1 : i + {WINDOW}], ' ') AS w
  FROM (SELECT doc_id, a, unnest(range(0, len(a) - {WINDOW - 1})) AS i FROM d WHERE len(a) >= {WINDOW})),
f AS (SELECT w, min(doc_id) AS first FROM s GROUP BY w),
g AS (SELECT s.doc_id, s.i FROM s JOIN f ON s.w = f.w WHERE s.doc_id > f.first),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS pos FROM g),
k AS (SELECT doc_id, unnest(a) AS word, unnest(range(0, len(a))) AS pos FROM d),
r AS (SELECT k.doc_id, count(*) FILTER (c.pos IS NOT NULL) AS n_removed,
  string_agg(k.word, ' ' ORDER BY k.pos) FILTER (c.pos IS NULL) AS kept
  FROM k LEFT JOIN c ON k.doc_id = c.doc_id AND k.pos = c.pos GROUP BY k.doc_id)
SELECT d.doc_id, CAST(len(d.a) AS BIGINT) AS n_words, coalesce(r.n_removed, 0) AS n_removed,
  sha256(coalesce(r.kept, '')) AS kept_sha256 FROM d LEFT JOIN r ON d.doc_id = r.doc_id
"""
