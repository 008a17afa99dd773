"""N-gram Jaccard join: a prefix-tree join over globally ordered shingle sets.

1. One pass counts shingles into a sketch of fixed size (2**SLOT_BITS counters, summed in a tree of tasks) and
   names each document's set by 128 bits; equal sets are linked to their least document, which alone goes on.
   The counts, then the hash, give one global order in which what many documents share stands last.
2. Two sets as alike as the threshold share a shingle among the first n - ceil(t n) + 1 of each, and behind it
   enough shingles are left for the overlap they need. These prefixes are filed by shingle with their place;
   documents that have no partner of fitting size and place there leave. The rest of a shingle's documents goes
   to one cell, named by the least of them, so that a document's set is sent once a cell and not once a shingle.
3. A cell stores its sets in a trie of shared beginnings. Each set walks it, carrying the overlap of the path,
   and leaves subtrees whose remaining length can't reach the threshold, or that are in its own component
   already. Only links that join two components are given out, so a cell of m sets gives at most m - 1 rows.
4. A cell of more than CELL_DOCS sets or CELL_SHINGLES shingles is dealt out: first portions of it are joined
   each in itself; then what isn't in the cell's largest component so far meets all portions, block by block,
   and pairs of one component are left out. So nothing is lost and no task holds more than two blocks.
   Shingles far above the sketch's mean have cells of their own and never meet in one task.

Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; shingles are compared by 64-bit hashes: among 10**12 different
ones, the odds that a given pair of documents meets a false common shingle stay under 1e-5, and a link needs many.

Defined cases: null or blank text has no shingles and is linked with nothing; fewer words than a shingle are
one shingle; a null doc_id counts as the smallest (as would the id -2**63, which comes back null); rows that
repeat a doc_id are each returned and share their links; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, dealt, drop_scratch, flat, id_back, id_column, id_filter, packed_batch, parts, raw, runs_of, scratch_path, table, trim, trimmed
from .words import Slice, pack_longs, slices, unpack_longs

SLOT_BITS, CHUNKS = 22, 64
#: Bits of a sort key that hold a document's number in its slice, and the count of a shingle.
DOC_BITS, COUNT_BITS = 20, 32
#: A cell of the join holds so many documents and shingles at most; beyond, it is dealt out.
CELL_DOCS, CELL_SHINGLES = 2048, 1 << 22
#: Bytes of text of a cell behind which a worker gives its memory back.
TRIMMED = 1 << 20
#: Shingles of a trie's node that a walk looks up before it weighs the bound again (then four times as many).
STRETCH = 64
#: A shingle is hot from so many documents on, if that is HOT_TIMES the mean of the sketch at least.
HOT, HOT_TIMES = 1 << 16, 4
COUNTED = "_id long, n long, k1 long, k2 long, twin long, chunk int, part int, counts binary"
FILED = "p int, shingle long, _id long, n int, shingles binary, ids binary, sizes binary, places binary"
HOMES = "cell long, _id long, n int"
LINKS = "a long, b long"


def shingle_sets(s: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document number, shingle hash) of the distinct shingles of each document, sorted by both."""
    ok = s.whole(width)
    h, doc = runs_of(s.hashes, width)[: len(ok)][ok], s.doc[: len(ok)][ok]
    short = np.flatnonzero((s.counts > 0) & (s.counts < width))
    lone = np.array([xxhash.xxh3_64_intdigest(s.hashes[s.first[k] : s.first[k] + s.counts[k]].tobytes(), seed=width) for k in short], np.uint64)
    h, doc = np.concatenate([h, lone]), np.concatenate([doc, short])
    order = np.argsort(_key(doc, h >> np.uint64(DOC_BITS)))
    h, doc = h[order], doc[order]
    same = np.flatnonzero((h[1:] >> np.uint64(DOC_BITS) == h[:-1] >> np.uint64(DOC_BITS)) & (h[1:] < h[:-1]) & (doc[1:] == doc[:-1]))
    if len(same):  # equal in all bits that the key has: order the last ones too
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
    new = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))[: len(h)]
    return doc[new], h[new]


def _key(doc: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """One 64-bit sort key: a document's number above the 64 - DOC_BITS lower bits of rest."""
    if len(doc) and int(doc[-1]) >> DOC_BITS:
        raise ValueError(f"a slice holds more than {1 << DOC_BITS} documents")
    return doc.astype(np.uint64) << np.uint64(64 - DOC_BITS) | rest


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _count(width: int, salts: int):
    """(id, size, 128-bit name of its set) of each document, or its twin in the slice; then the task's counts, in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.uint32)
        for s, _ in slices(batches, True):
            doc, h = shingle_sets(s, width)
            slot, many = np.unique(_slot(h), return_counts=True)
            counts[slot] += many.astype(np.uint32)
            sizes = np.bincount(doc, minlength=len(s.ids))
            ends = np.cumsum(sizes)
            first: dict[int, int] = {}
            out = []
            for i, n, e in zip(s.ids.tolist(), sizes.tolist(), ends.tolist(), strict=True):
                name = xxhash.xxh3_128_intdigest(h[e - n : e].tobytes()) if n else None
                twin = first.setdefault(name, i) if n else i
                if n and twin == i:
                    out.append((i, n, _signed(name >> 64), _signed(name & (1 << 64) - 1), None, None, None, None))
                else:
                    out.append((i, n, None, None, twin, None, None, None))
            yield packed_batch(out, COUNTED)
        if counts.any():
            part = TaskContext.get().partitionId() % salts
            yield packed_batch([(None, None, None, None, None, k, part, zlib.compress(c.astype("<u4").tobytes(), 1)) for k, c in enumerate(counts.reshape(CHUNKS, -1))], COUNTED)

    return run


def _sum_counts(t: pa.Table) -> pa.Table:
    total = np.zeros((1 << SLOT_BITS) // CHUNKS, np.int64)
    for c in t.column("counts").to_pylist():
        total += np.frombuffer(zlib.decompress(c), "<u4")
    packed = zlib.compress(np.minimum(total, 2**32 - 1).astype("<u4").tobytes(), 1)
    return pa.table({"chunk": pa.array([t.column("chunk")[0].as_py()], pa.int32()), "counts": pa.array([packed], pa.binary())})


def _sketch(counted: DataFrame) -> np.ndarray:
    """All tasks' counts, summed by part and then by chunk: CHUNKS rows of fixed size reach the driver."""
    some = counted.where("chunk is not null").select("chunk", "part", "counts").groupBy("chunk", "part").applyInArrow(_sum_counts, "chunk int, counts binary")
    counts = np.zeros((CHUNKS, (1 << SLOT_BITS) // CHUNKS), np.uint32)
    for r in some.groupBy("chunk").applyInArrow(_sum_counts, "chunk int, counts binary").collect():
        counts[r["chunk"]] = np.frombuffer(zlib.decompress(r["counts"]), "<u4")
    return counts.ravel()


def _ordered(doc: np.ndarray, h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The order of a slice's shingles (sorted by document and hash) by document, then globally: what fewer documents hold first, then by hash."""
    return np.argsort(_key(doc, counts[_slot(h)].astype(np.uint64) << np.uint64(64 - DOC_BITS - COUNT_BITS)), kind="stable")


def _file(width: int, num: int, den: int, shares: int, hot: int, sketch):
    """Prefixes by shingle; those of hot shingles, whose rows can't meet in one task, as rows of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, _ in slices(batches, True):
            doc, h = shingle_sets(s, width)
            sizes = np.bincount(doc, minlength=len(s.ids))
            order = _ordered(doc, h, sketch.value)
            doc, h = doc[order], h[order]
            place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            ok = place < (sizes - -(-num * sizes // den) + 1)[doc]
            doc, h, place = doc[ok], h[ok], place[ok]
            common = sketch.value[_slot(h)] > hot
            out = [(-1, k, i, n, None, None, None, None) for k, i, n in zip(h[common].view(np.int64).tolist(), s.ids[doc[common]].tolist(), sizes[doc[common]].tolist(), strict=True)]
            doc, h, place = doc[~common], h[~common], place[~common]
            rows = dealt((h % np.uint64(shares)).astype(np.int64), shares, [h, s.ids[doc], sizes[doc], place], [raw("<u8"), pack_longs, raw("<u4"), raw("<u4")])
            yield packed_batch(out + [(p, None, None, None, *r) for p, *r in rows], FILED)

    return run


def _greatest(v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The greatest of v[lo:hi] for each range, very little for an empty one; by maxima over powers of two."""
    out = np.full(len(lo), np.iinfo(np.int64).min)
    width = np.maximum(hi - lo, 0)
    level = np.frexp(np.maximum(width, 1))[1] - 1
    row = v
    for k in range(int(level.max(initial=0)) + 1):
        if k:
            row = np.maximum(row[: len(row) - (1 << k - 1)], row[1 << k - 1 :])
        at = np.flatnonzero((level == k) & (width > 0))
        out[at] = np.maximum(row[lo[at]], row[hi[at] - (1 << k)])
    return out


def partnered(h: np.ndarray, n: np.ndarray, place: np.ndarray, num: int, den: int) -> np.ndarray:
    """For rows sorted by shingle and size: whether some other row of the shingle fits by size and place.

    Sizes n <= m fit if num * m <= den * n; the overlap needed is num * (n + m) / (num + den), and from a first
    common shingle on, no more than n - place and m - place are left. So of the partners' sizes both ends are known,
    and among these the greatest (num + den) * left - num * size decides.
    """
    left = n - place
    worth = (num + den) * left - num * n
    head = np.append(True, h[1:] != h[:-1])[: len(h)]
    group = np.cumsum(head) - 1
    step = int(n.max(initial=0)) + 2
    key = group * step + n
    lo = np.searchsorted(key, group * step + -(-num * n // den), "left")
    hi = np.searchsorted(key, group * step + np.minimum(np.minimum(den * n, worth) // num, step - 1), "right")
    at = np.arange(len(h))
    best = np.maximum(_greatest(worth, lo, np.minimum(hi, at)), _greatest(worth, np.maximum(lo, at + 1), hi))
    return best >= num * n


def _homes(t: pa.Table, num: int, den: int) -> pa.Table:
    """Cells of a share's shingles: (least document, document, size)."""
    columns = [t.column(c).to_pylist() for c in ("shingles", "ids", "sizes", "places")]
    h, ids = np.concatenate([np.frombuffer(x, "<u8") for x in columns[0]]), np.concatenate([unpack_longs(x) for x in columns[1]])
    n, place = (np.concatenate([np.frombuffer(x, "<u4") for x in c]).astype(np.int64) for c in columns[2:])
    _, size = np.unique(h, return_counts=True)
    order = np.lexsort((ids, n, h))
    order = order[np.repeat(size > 1, size)]
    h, ids, n, place = h[order], ids[order], n[order], place[order]
    ok = partnered(h, n, place, num, den)
    h, ids, n = h[ok], ids[ok], n[ok]
    if not len(h):
        return flat(HOMES, h, ids, n)
    head = np.append(True, h[1:] != h[:-1])
    least = np.minimum.reduceat(ids, np.flatnonzero(head))[np.cumsum(head) - 1]
    order = np.lexsort((n, ids, least))
    least, ids, n = least[order], ids[order], n[order]
    new = np.append(True, (least[1:] != least[:-1]) | (ids[1:] != ids[:-1]) | (n[1:] != n[:-1]))
    return flat(HOMES, least[new], ids[new], n[new])


class Trie:
    """Sets in one order, as a tree of shared beginnings; each node holds a stretch of shingles."""

    def __init__(self, sets: dict[int, bytes]):
        """sets: key -> shingles in the global order, 8 bytes each."""
        rows = sorted((b, k) for k, b in sets.items())
        arrays = [np.frombuffer(b, "<u8") for b, _ in rows]
        common = [0] * len(rows)
        for r in range(1, len(rows)):
            a, b = arrays[r - 1], arrays[r]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            common[r] = int(differ[0]) if len(differ) else m
        self.nodes: list[tuple[np.ndarray, int, list[int], list[int], int, int]] = []  # stretch, depth behind it, keys that end, children, least and greatest size below
        todo = [(0, len(rows), 0, -1)]
        while todo:
            lo, hi, depth, parent = todo.pop()
            to = min(common[lo + 1 : hi], default=len(arrays[lo]))
            ends = [rows[r][1] for r in range(lo, hi) if len(arrays[r]) == to]
            lengths = [len(arrays[r]) for r in range(lo, hi)]
            me = len(self.nodes)
            self.nodes.append((arrays[lo][depth:to], to, ends, [], min(lengths), max(lengths)))
            if parent >= 0:
                self.nodes[parent][3].append(me)
            splits = [lo, *(r for r in range(lo + 1, hi) if common[r] == to), hi] if hi - lo > 1 else []
            for a, b in zip(splits, splits[1:], strict=False):
                if not (b - a == 1 and len(arrays[a]) == to) and not all(len(arrays[r]) == to for r in range(a, b)):
                    todo.append((a, b, to, me))

    def alike(self, members: bytes, num: int, den: int, label: list[int] | None = None, own: int | None = None) -> list[int]:
        """Keys of the sets with den * intersection >= num * union, without those whose label is `own`."""
        probe = np.sort(np.frombuffer(members, "<u8"))
        n, out, todo = len(probe), [], [(0, 0)]
        if not n:
            return out
        while todo:
            at, shared = todo.pop()
            stretch, depth, ends, children, least, most = self.nodes[at]
            if not children and label is not None and all(label[k] == own for k in ends):
                continue
            # an overlap o of sizes n and m is enough if (num + den) * o >= num * (n + m)
            begin, to, step = depth - len(stretch), 0, STRETCH
            while to < len(stretch):
                part = stretch[to : to + step]
                shared += int((probe[np.minimum(np.searchsorted(probe, part), n - 1)] == part).sum())
                to, step = to + len(part), 4 * step
                here = begin + to
                if (num + den) * (shared + min(most - here, n - shared)) < num * (n + max(least, here)):
                    break
            else:
                if (num + den) * (shared + min(most - depth, n - shared)) >= num * (n + max(least, depth)):
                    if ends and (num + den) * shared >= num * (n + depth):
                        out += [k for k in ends if label is None or label[k] != own]
                    todo += [(c, shared) for c in children]
        return out


def _join_cell(width: int, num: int, den: int, sketch):
    """Links that join components: rows (_id, component, probe, text); only rows with probe walk the trie."""

    def run(t: pa.Table) -> pa.Table:
        sets: dict[tuple[int, int], bytes] = {}  # rows that repeat an id may have other texts
        placed: dict[int, tuple[int, bool]] = {}
        for s, more in slices(t.to_batches(), True, ("component", "probe")):
            doc, h = shingle_sets(s, width)
            h = h[_ordered(doc, h, sketch.value)]
            ends = np.cumsum(np.bincount(doc, minlength=len(s.ids)))
            for i, lo, hi, c, p in zip(s.ids.tolist(), [0, *ends[:-1].tolist()], ends.tolist(), *(x.to_pylist() for x in more), strict=True):
                m = h[lo:hi].astype("<u8").tobytes()
                sets.setdefault((i, xxhash.xxh3_64_intdigest(m)), m)
                placed[i] = c, p or placed.get(i, (c, False))[1]
        keys = sorted(sets)
        label = [placed[i][0] for i, _ in keys]
        links, trie = [], None
        if len(set(label)) > 1:
            held: dict[int, list[int]] = {}
            for k, c in enumerate(label):
                held.setdefault(c, []).append(k)
            trie = Trie({k: sets[key] for k, key in enumerate(keys)})
            for k, key in enumerate(keys):
                if len(held) == 1:
                    break
                if not placed[key[0]][1]:
                    continue
                for x in trie.alike(sets[key], num, den, label, label[k]):
                    if label[x] != label[k]:
                        links.append((min(key[0], keys[x][0]), max(key[0], keys[x][0])))
                        small, large = sorted((label[x], label[k]), key=lambda c: len(held[c]))
                        for y in held[small]:
                            label[y] = large
                        held[large] += held.pop(small)
        if t.nbytes > TRIMMED:
            del sets, keys, trie, s, doc, h, m
            trim()
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def _portions(homes: DataFrame) -> DataFrame:
    """(cell, docs, portions) of the cells that don't fit one task."""
    load = homes.groupBy("cell").agg(F.count("*").alias("docs"), F.sum(F.col("n").cast("long")).alias("shingles"))
    many = F.greatest(F.ceil(F.col("docs") / CELL_DOCS), F.ceil(F.col("shingles") / CELL_SHINGLES)).cast("int")
    return load.select("cell", "docs", many.alias("portions")).where("portions > 1")


def _joined(cells: DataFrame, texts: DataFrame, keys: list[str], join_cell) -> DataFrame:
    """Texts are sent, not sets: they take less than half the room and are split again where they are needed."""
    rows = cells.select(*keys, "_id", "component", "probe").join(texts, "_id")
    return rows.groupBy(*keys).applyInArrow(join_cell, LINKS)


def _block(name: str, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "_id"), F.col(name)).cast("int")


def _across(homes: DataFrame, large: DataFrame, known: DataFrame) -> DataFrame:
    """(cell, i, j, _id, component, probe): blocks i of dealt cells with blocks j of what isn't in the cell's largest component."""
    placed = homes.join(large, "cell").join(known.withColumnRenamed("node", "_id"), "_id", "left").withColumn("component", F.coalesce("component", "_id"))
    by = placed.groupBy("cell", "component").agg(F.count("*").alias("docs"), F.sum(F.col("n").cast("long")).alias("shingles"))
    rest = by.groupBy("cell").agg(F.max(F.struct("docs", F.negative("component").alias("c"), "shingles")).alias("top"), F.sum("docs").alias("docs"), F.sum("shingles").alias("shingles"))
    left = rest.select("cell", F.negative("top.c").alias("main"), F.greatest(F.ceil((F.col("docs") - F.col("top.docs")) / CELL_DOCS), F.ceil((F.col("shingles") - F.col("top.shingles")) / CELL_SHINGLES)).cast("int").alias("blocks")).where("blocks > 0")
    placed = placed.join(left, "cell")
    every = placed.select("cell", "_id", "component", F.lit(False).alias("probe"), _block("portions", 1).alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    some = placed.where("component <> main")
    probes = some.select("cell", "_id", "component", F.lit(True).alias("probe"), F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("i"), _block("blocks", 2).alias("j"))
    return every.unionAll(probes)


def _equal(counted: DataFrame) -> DataFrame:
    """(a, b): each document and the least one with the same set, found by the sets' names or within a slice."""
    named = counted.where("k1 is not null").select("_id", "k1", "k2")
    first = named.groupBy("k1", "k2").agg(F.min("_id").alias("a"), F.count("*").alias("many")).where("many > 1").select("k1", "k2", "a")
    twins = counted.where("twin <> _id").select(F.col("twin").alias("a"), F.col("_id").alias("b"))
    return named.join(first, ["k1", "k2"]).where("_id <> a").select("a", F.col("_id").alias("b")).unionAll(twins)


def similar_components(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """_id, n (size of its set), component for each row of docs: den * intersection >= num * union links two documents."""
    spark = docs.sparkSession
    shares, mine = parts(spark), [scratch_path(spark) for _ in range(5)]
    texts = docs.select(id_column("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = cut(texts.mapInArrow(trimmed(_count(width, max(1, math.isqrt(shares)))), COUNTED))
    counts = _sketch(counted)
    sketch, hot = spark.sparkContext.broadcast(counts), max(HOT, HOT_TIMES * int(counts.mean()))
    same = cut(_equal(counted), mine[0])
    often = counted.where("_id is not null").groupBy("_id").count().where("count > 1").select("_id")
    copies = cut(same.select(F.col("b").alias("_id")).distinct().join(often, "_id", "left_anti"), mine[1])
    copied = id_filter(copies, "_id")  # what it lets through is looked up
    lone = texts.where(~copied("_id")).unionAll(texts.where(copied("_id")).join(copies, "_id", "left_anti"))
    filed = lone.mapInArrow(trimmed(_file(width, num, den, shares, hot, sketch)), FILED)
    if counts.max() > hot:  # else no shingle is, and one branch reads what is filed
        filed = cut(filed, mine[2])
    homes = filed.where("p >= 0").select("p", "shingles", "ids", "sizes", "places").groupBy("p").applyInArrow(lambda t: _homes(t, num, den), HOMES)
    if counts.max() > hot:
        homes = homes.unionAll(filed.where("p < 0").select(F.col("shingle").alias("cell"), "_id", "n"))
    homes = cut(homes.distinct(), mine[3])
    drop_scratch(spark, mine[2])
    near, join_cell = texts.where(id_filter(homes, "_id")("_id")), _join_cell(width, num, den, sketch)  # and a few that no join asks for
    large = cut(_portions(homes), mine[4])
    cells = homes.withColumns({"component": F.col("_id"), "probe": F.lit(True)})
    links = _joined(cells.join(large, "cell", "left_anti"), near, ["cell"], join_cell).unionAll(same)
    some = not large.isEmpty()
    if some:
        links = links.unionAll(_joined(cells.join(large, "cell").withColumn("portion", _block("portions", 1)), near, ["cell", "portion"], join_cell))
    known = cut(components(links))
    if some:
        more = _joined(_across(homes, large, known), near, ["cell", "i", "j"], join_cell)
        known = cut(components(known.select(F.col("component").alias("a"), F.col("node").alias("b")).unionAll(more)))
    for path in mine:
        drop_scratch(spark, path)
    rows = counted.where("_id is not null").select("_id", "n")
    return rows.join(known.withColumnRenamed("node", "_id"), "_id", "left").select("_id", "n", F.coalesce("component", "_id").alias("component"))


def ngram_components(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs."""
    return similar_components(docs, width, num, den).select(id_back("_id").alias("doc_id"), F.col("n").alias("n_shingles"), id_back("component").alias("component_id"))


def _nodes(named: DataFrame) -> tuple[Column, DataFrame]:
    """A long for each distinct (doc_id, text) of named, and (node, id, rows) of all of them; the first seed under which no two share one."""
    text = F.coalesce("text", F.lit(""))
    for seed in range(64):
        node = F.xxhash64(F.lit(seed), id_column("doc_id"), text)
        each = named.select(node.alias("node"), id_column("doc_id").alias("id"), F.xxhash64(text, F.lit(-1 - seed)).alias("other"))
        keys = cut(each.groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("rows"), ((F.min("id") != F.max("id")) | (F.min("other") != F.max("other"))).alias("shared")))
        if keys.where("shared").isEmpty():
            return node, keys.select("node", "id", "rows")
    raise RuntimeError("no seed tells all documents apart")


def keep_one(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs, all columns, with one row of each component of near copies: that of the smallest id (of these, the least text).

    Components are of distinct (doc_id, text), so rows that repeat an id, or have none, go only where their own texts
    are linked. Equal rows are copies of each other; rows of null or blank text have no copies and all stay.
    """
    inner = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    at = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    named = inner.withColumns({"doc_id": F.col(at["doc_id"]), "text": F.col(at["text"])})
    node, keys = _nodes(named)
    texts = named.select(node.alias("doc_id"), "text")
    found = similar_components(texts, width, num, den).where("n > 0").select(F.col("_id").alias("node"), "component").distinct()
    placed = cut(keys.join(found, "node"))
    heads = placed.groupBy("component", "id").agg(F.count("*").alias("nodes"), F.min("node").alias("node")).groupBy("component")
    heads = cut(heads.agg(F.min(F.struct("id", "nodes", "node")).alias("head"), F.sum("nodes").alias("size")).where("size > 1").select("component", "head.*"))
    first = heads.where("nodes = 1").select("node")
    tied = placed.join(heads.where("nodes > 1").select("component", "id"), ["component", "id"]).select("node", "component")
    if not heads.where("nodes > 1").isEmpty():  # texts of one id are linked: the least stays
        tied = cut(tied)
        held = texts.withColumnRenamed("doc_id", "node").where(id_filter(tied, "node")("node")).join(tied, "node")
        first = first.unionAll(held.groupBy("component").agg(F.min(F.struct("text", "node")).alias("least")).select("least.node"))
    gone = cut(placed.join(heads.select("component"), "component", "left_semi").join(first, "node", "left_anti").select("node"))
    rest = named.select(node.alias("node"), *inner.columns).join(gone, "node", "left_anti")
    twice = placed.where("rows > 1").select("node")
    once = rest.join(twice, "node", "left_anti")
    again = rest.join(twice, "node", "left_semi").dropDuplicates(["node"])
    return once.unionByName(again).select(*[F.col(at[c]).alias(c) for c in docs.columns])


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents").select("doc_id", "text"), 4, 85, 100)


OP3_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS a FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(a[i + 1 : i + 4], ' ') AS g FROM (SELECT doc_id, a, unnest(range(0, len(a) - 3)) AS i FROM w WHERE len(a) >= 4) q
  UNION SELECT doc_id, array_to_string(a, ' ') FROM w WHERE len(a) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * p.k >= 85 * (na.n + nb.n - p.k)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.m AS component_id FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.a = w.doc_id
"""
