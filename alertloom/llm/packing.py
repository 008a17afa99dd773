"""Best-fit packing by a length histogram.

Documents become token pieces; the plan is made from the counts of each length alone (at most `capacity`
numbers), by best-fit decreasing over groups of equal bins; pieces then look up their slot by their rank
within their length. Ranks are counted in parts of each length (SALTS, or the shuffle partitions, MOST_SALTS at most), so a length that most pieces share
is ranked by many tasks; what reaches the driver is at most capacity * MOST_SALTS counts, whatever the input.

Defined cases: null text is empty (one piece, the closing id); a null doc_id is kept and ranks like any
other id; repeated rows are packed as often as they stand there; an empty table gives an empty result;
only longer documents are cut, the first piece taking what is over; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, parts, table, trimmed

CAPACITY, SALTS, MOST_SALTS, CLOSING = 2048, 64, 1024, b"\0\0\0\0"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


PROBES = ("Hello  world's\n\n \tfoo_bar 1234 (x) \u00e9\u00df\u4e2d\u6587 \U0001f600\u200d ", "  leading, I'll they've 'S \u00a0\u3000x")


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TextIds:
    """Ids of a text by a `tokenizers` file with add_special_tokens=False, as little-endian 32-bit bytes.

    A byte-level BPE whose ids are its merge ranks is run by tiktoken from the same vocabulary, which is
    several times as fast; any other, any text that holds the string of an added token, and any text that
    tiktoken refuses, by `tokenizers` itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = self._ranks()
        if self.fast and any(self.fast.encode_ordinary(p) != self._slow(p) for p in PROBES):
            self.fast = None

    def _slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _ranks(self):
        import public_tokenizers
        import tiktoken

        letters = _byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in vocabulary.items() if all(c in letters for c in t)}
        ranks = {t: i for t, i in ranks.items() if t.decode("utf-8", "replace") not in self.added}
        if sorted(ranks.values()) != list(range(len(ranks))):
            return None
        return tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        if self.fast and not any(a in text for a in self.added):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
            except (ValueError, RuntimeError, OverflowError):  # a run of blanks too long for its pattern
                pass
        return np.array(self._slow(text), "<u4").tobytes()


@lru_cache(4)
def text_ids(path: str) -> TextIds:
    return TextIds(path)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for each piece of each row; the ids end with id 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = text_ids(tokenizer)
        for b in batches:
            out: list[tuple] = []
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = store.ids(text.as_py() or "") + CLOSING
                n = len(ids) // 4
                cuts = [0, *range((n - 1) % capacity + 1, n, capacity), n]
                out += [(i, k, lo, hi - lo, zlib.crc32(ids[4 * lo : 4 * hi])) for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False))]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        text_ids.cache_clear()  # made again in half a second; idle workers would keep some 45 MB each beside other stages

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(trimmed(run), PIECES)


def plan_slots(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """counts[length] -> runs (length, first rank, pieces a bin, first bin, offset), sorted by length and rank.

    Longest first; each length goes to the bins with least room that still fits, as many pieces a bin as fit.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room left: (first bin, bins)
    bins, runs = 0, []
    for length in range(capacity, 0, -1):
        left, rank, free = int(counts[length]), 0, length

        def fill(first: int, many: int, space: int, left: int, rank: int, length: int = length) -> tuple[int, int]:
            """Put pieces in bins that have `space`; the bins that are not needed keep their room."""
            each = space // length
            take = min(left, many * each)
            runs.append((length, rank, each, first, capacity - space))
            full, over = divmod(take, each)
            if full and space > each * length:
                room[space - each * length].append((first, full))
            if over:
                room[space - over * length].append((first + full, 1))
            used = full + (over > 0)
            if used < many:
                room[space].append((first + used, many - used))
            return left - take, rank + take

        while left and free <= capacity:
            if room[free]:
                first, many = room[free].pop()
                left, rank = fill(first, many, free, left, rank)
            else:
                free += 1
        if left:
            need = -(-left // (capacity // length))
            fill(bins, need, capacity, left, rank)
            bins += need
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset. Writes the pieces once to the scratch folder, as they are read twice."""
    spark = pieces.sparkSession
    salts = min(MOST_SALTS, max(SALTS, parts(spark)))
    pieces = cut(pieces).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    many = np.zeros((capacity + 1, salts), np.int64)
    for r in pieces.groupBy("length", "salt").count().toLocalIterator():
        many[r["length"], r["salt"]] = r["count"]
    before = np.cumsum(many, axis=1) - many
    shared = spark.sparkContext.broadcast((before, plan_slots(many.sum(axis=1), capacity)))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(order).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, runs = shared.value
        high = np.int64(1 << 48)
        starts = runs[:, 0] * high + runs[:, 1]
        for b in batches:
            length, salt, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "salt", "rank"))
            rank = rank - 1 + before[length, salt]
            r = runs[np.searchsorted(starts, length * high + rank, "right") - 1]
            i = rank - r[:, 1]
            placed = [pa.array(r[:, 3] + i // r[:, 2]), pa.array(r[:, 4] + i % r[:, 2] * length)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), *placed], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, PLACED)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    return place(token_pieces(docs, tokenizer, capacity), capacity)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
