"""Exact top-k search by inner product, block at a time.

Rows are renumbered within a batch so that similar ones adjoin; a block is a range of BLOCK documents in that
order, with the least and greatest value of each term (dimension) and a forward index (the block's matrix). For a
query the blocks stand in the order of their bound, the sum over terms of the best product that block allows;
blocks are scored through their forward index until the next bound falls below the k-th score so far (a bound equal
to it is still scored, for ties).

Blocks and queries meet in a grid: each cell holds one share of the blocks, CELL_ROWS rows on average, and one chunk
of at most CHUNK queries and returns k rows a query, so no side is broadcast or held whole anywhere. Rows travel as
the smallest integers that hold them. An exact search compares each query with each share, so what moves is the rows
once for every CHUNK queries, and the queries once for every CELL_ROWS rows.

Defined cases: null vectors, and those with null or non-finite components, take no part, nor do rows with a
null id; shorter vectors count as padded with zeros; a repeated query row is one query; other rows with the
query's id are no candidates; repeated candidate rows are candidates each; an empty table gives an empty result;
other columns are ignored. Scores are exact; where sizes are such that one could reach 2**53, a ValueError says so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import parts, table

BLOCK, CHUNK, CELL_ROWS, SCALE, K, EVERY = 128, 16384, 1 << 16, 256, 5, 50
CELLS = "p int, c int, ids binary, rows binary"
HITS = "query_id long, mark long, vec_id long, score long"


def _matrix(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """ids and floor(SCALE * x) of the rows that take part."""
    ids, out = [], []
    for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
        if i is None or not v.is_valid or v.values.null_count:
            continue
        x = np.zeros(dims)
        got = v.values.to_numpy(zero_copy_only=False)
        x[: len(got)] = got
        if np.isfinite(x).all():
            ids.append(i)
            out.append(x)
    rows = np.floor(SCALE * np.array(out).reshape(-1, dims))
    if rows.size and dims * np.abs(rows).max() ** 2 >= 2**53:
        raise ValueError("components are too large for exact scores")
    return np.array(ids, np.int64), rows.astype(np.int64)


def _packed(rows: np.ndarray) -> bytes:
    """Integers in the fewest bytes that hold all of them, behind the number of bytes."""
    most = int(np.abs(rows).max(initial=0))
    kind = "<i1" if most < 2**7 else "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
    return kind[-1].encode() + rows.astype(kind).tobytes()


def _unpacked(b: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(b, f"<i{b[:1].decode()}", offset=1).astype(np.int64).reshape(-1, dims)


def _alike(rows: np.ndarray) -> np.ndarray:
    """An order that puts similar rows side by side: by the nearest of some rows, then by the product with it."""
    x = rows.astype(np.float64)
    seeds = x[:: max(1, len(x) // 64)]
    product = x @ seeds.T
    near = product.argmax(axis=1)
    return np.lexsort((product[np.arange(len(x)), near], near))


def _quantised(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rows = _matrix(b, dims)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([_packed(r) for r in rows], pa.binary())], names=["vec_id", "row"])

    return run


def _cells(kind: str, dims: int, shares: int, chunks: int):
    """Cells of vectors (kind "blocks") or of distinct quantised queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if kind == "blocks":
                ids, rows = _matrix(b, dims)
                order = _alike(rows)
                ids, rows = ids[order], rows[order]
            else:
                ids, rows = b.column("vec_id").to_numpy(), np.concatenate([np.empty((0, dims), np.int64), *(_unpacked(r, dims) for r in b.column("row").to_pylist())])
            out = []
            for lo in range(0, len(ids), BLOCK):
                i, r = ids[lo : lo + BLOCK], rows[lo : lo + BLOCK]
                where = int(abs(int(i[0]) * 2654435761 + len(i)) >> 7)
                cells = [(where % shares, c) for c in range(chunks)] if kind == "blocks" else [(p, where % chunks) for p in range(shares)]
                packed = i.tobytes(), _packed(r)
                out += [(p, c, *packed) for p, c in cells]
            cols = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["p", "c", "ids", "rows"])

    return run


def search_cell(blocks: list[tuple[np.ndarray, np.ndarray]], queries: tuple[np.ndarray, np.ndarray], k: int) -> list[tuple[int, int, int, int]]:
    """(query id, query row, vector id, score) of the k best of each query among the blocks."""
    import xxhash

    wide = max(len(i) for i, _ in blocks)
    dims = blocks[0][1].shape[1]
    if dims * max(int(np.abs(r).max(initial=0)) for _, r in blocks) * int(np.abs(queries[1]).max(initial=0)) >= 2**53:
        raise ValueError("components are too large for exact scores")
    ids = np.full((len(blocks), wide), -1, np.int64)
    index = np.zeros((len(blocks), wide, dims))
    used = np.zeros((len(blocks), wide), bool)
    for n, (i, r) in enumerate(blocks):
        ids[n, : len(i)], index[n, : len(i)], used[n, : len(i)] = i, r, True
    hi, lo = np.stack([r.max(axis=0) for _, r in blocks]).astype(np.float64), np.stack([r.min(axis=0) for _, r in blocks]).astype(np.float64)
    out = []
    for q, row in zip(*queries, strict=True):
        x = row.astype(np.float64)
        bound = hi @ np.maximum(x, 0) + lo @ np.minimum(x, 0)
        order = np.argsort(-bound, kind="stable")
        score, who, kth, at, step = np.empty(0), np.empty(0, np.int64), -np.inf, 0, 1
        while at < len(order) and bound[order[at]] >= kth:
            take = order[at : at + step]
            s, i = (index[take] @ x).ravel(), ids[take].ravel()
            ok = used[take].ravel() & (i != q) & (s >= kth)
            score, who = np.concatenate([score, s[ok]]), np.concatenate([who, i[ok]])
            best = np.lexsort((who, -score))[:k]
            score, who = score[best], who[best]
            if len(score) == k:
                kth = score[-1]
            at, step = at + step, min(8, 2 * step)
        mark = xxhash.xxh3_64_intdigest(row.tobytes()) - 2**63
        out += [(int(q), mark, int(i), int(s)) for i, s in zip(who, score, strict=True)]
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score for every row of queries against every row of vectors (both: vec_id, embedding)."""
    spark = vectors.sparkSession
    vectors, queries = vectors.select(F.col("vec_id").cast("long"), "embedding"), queries.select(F.col("vec_id").cast("long"), "embedding")
    n = queries.count()
    many, wide = vectors.agg(F.count("*"), F.max(F.size("embedding"))).first()
    dims = max(1, wide or 0, queries.agg(F.max(F.size("embedding"))).first()[0] or 0)
    chunks, shares = max(1, -(-n // CHUNK)), max(parts(spark), -(-many // CELL_ROWS))
    left = vectors.mapInArrow(_cells("blocks", dims, shares, chunks), CELLS)
    once = queries.mapInArrow(_quantised(dims), "vec_id long, row binary").distinct()  # a repeated query row is one query
    right = once.mapInArrow(_cells("queries", dims, shares, chunks), CELLS)
    schema = pa.schema([("query_id", pa.int64()), ("mark", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if a.num_rows and b.num_rows:
            read = lambda t: [(np.frombuffer(i, np.int64), _unpacked(r, dims)) for i, r in zip(t.column("ids").to_pylist(), t.column("rows").to_pylist(), strict=True)]
            blocks = read(a)
            for q in read(b):
                out += search_cell(blocks, q, k)
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 4)], schema=schema)

    hits = left.groupBy("p", "c").cogroup(right.groupBy("p", "c")).applyInArrow(cell, HITS)
    rank = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


OP2_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(v.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
