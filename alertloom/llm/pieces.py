"""SentencePiece encoding and decoding by suffix-array matching.

A batch's new chunks (a run of blanks with the word behind it) are concatenated and indexed by a suffix array,
sorted as deep as the longest piece by prefix doubling; every piece of the vocabulary is binary-searched in it
for its range of occurrences; the ranges, sorted by position, are the edges of a lattice over the batch.
Relaxing the edges in the order of their score joins neighbouring symbols as long as an edge covers both (ties:
leftmost), which is what a BPE model does; characters that no piece covers become their UTF-8 bytes.

Chunks are what such a model never joins across, so each distinct chunk is encoded once while it stays in a
store of STORE_CHARS characters. A chunk longer than INDEX_CHARS is indexed block by block and relaxed with some
20 bytes a character. The vocabulary is a file whose path is a parameter; its bytes travel with the job. A model
that isn't of this kind (unigram, with a normaliser or symbols of a user) shows in PROBES; then the library encodes.

Defined cases: null text is empty and has no ids; a null doc_id is kept; repeated rows are encoded each; an
empty table gives an empty result; U+2581 in a text is taken as a space, as the format has it; other columns
are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SPACE, SEPARATOR = "▁", "\0"
CHUNKS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
INDEX_CHARS, WIDE = 150_000, 64
#: Characters of chunks, and ids, that are kept or decoded at once.
STORE_CHARS, DECODED = 4_000_000, 100_000
#: Texts that show whether the library would encode otherwise.
PROBES = ("Hello  world's\n\n \tfoo_bar 1234 (x) \u00e9\u00df\u4e2d\u6587 \U0001f600 ", "  leading <s> \u00a0\u3000\uff21\ufb01 e\u0301 " + "ab" * 70, "a\u2581b  ")
CODED = "doc_id long, n_ids long, ids binary"


class Vocabulary:
    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        plain.sort(key=sp.id_to_piece)
        self.text = [sp.id_to_piece(i) for i in plain]
        self.ids, self.score = np.array(plain), np.array([sp.get_score(i) for i in plain])
        self.length = np.array(list(map(len, self.text)))
        self.width = int(self.length.max())
        self.codes = np.zeros((len(plain), self.width), np.int64)  # code points, 0 behind the end
        for row, t in zip(self.codes, self.text, strict=True):
            row[: len(t)] = list(map(ord, t))
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        whole = {i: t.replace(SPACE, " ").encode() for i, t in zip(plain, self.text, strict=True)}
        whole |= {i: bytes([b]) for b, i in self.byte.items()}
        self.piece_of = {t: k for k, t in enumerate(self.text)}
        _, self.rank = np.unique(-self.score, return_inverse=True)  # equal scores share a rank
        self.ranks, self.id_list = self.rank.tolist(), self.ids.tolist()
        self.library = None
        self.bytes_of = [whole.get(i, "⁇".encode() if i == self.unknown else b"") for i in range(n)]

    def like(self, library) -> bool:
        """Whether this encodes PROBES as the library does."""
        texts = [SPACE + t.replace(" ", SPACE) for t in PROBES]
        mine = [np.frombuffer(b"".join(self.encode_chunks(CHUNKS.findall(t))), "<u4").tolist() for t in texts]
        return mine == library.encode(list(PROBES))

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece) of every occurrence of every piece in a text given as code points, sorted by start.

        Suffixes are ranked by their first characters, packed into a 64-bit key by the batch's own alphabet, then by
        twice as many, until that is the longest piece. A piece's range of ranks is found by binary search for each
        part of a key's length, then for each two adjoining parts: behind a part that is full, only its own rank will do.
        """
        alphabet = np.zeros(0x110000, np.uint64)
        present = np.flatnonzero(np.bincount(codes))
        alphabet[present] = np.arange(1, len(present) + 1)
        bits = 8 if len(present) < 256 else 16 if len(present) < 65536 else 32
        each = 64 // bits
        many = 1
        while many * each < self.width:
            many *= 2

        def packed(rows: np.ndarray) -> np.ndarray:
            key = np.zeros(rows.shape[:-1], np.uint64)
            for k in range(each):
                key = key << np.uint64(bits) | rows[..., k]
            return key

        n = len(codes)
        text = np.concatenate([alphabet[codes], np.zeros(many * each + each, np.uint64)])
        values, rank = np.unique(packed(np.lib.stride_tricks.sliding_window_view(text, each)), return_inverse=True)
        pieces = np.where(self.codes > 0, alphabet[self.codes], np.uint64(0))
        can = np.flatnonzero(((pieces > 0) | (self.codes == 0)).all(axis=1))
        pieces, length = pieces[can], self.length[can]
        parts = np.zeros((len(can), many * each), np.uint64)
        parts[:, : self.width] = pieces
        parts = packed(parts.reshape(len(can), many, each))
        filled = np.clip(length[:, None] - np.arange(many) * each, 0, each)  # characters of each part
        spare = (bits * (each - filled)).astype(np.uint64)
        above = np.where(filled > 0, parts | np.where(filled < each, (np.uint64(1) << (spare % np.uint64(64))) - np.uint64(1), np.uint64(0)), np.uint64(2**64 - 1))
        lo, hi = np.searchsorted(values, parts, "left"), np.searchsorted(values, above, "right")
        depth = each
        while depth < many * each:
            size = np.int64(len(values) + 1)
            behind = np.append(rank[depth:], np.zeros(depth, rank.dtype))  # behind the end stand zeros, whose rank is 0
            values, rank = np.unique(rank * size + behind, return_inverse=True)
            more = filled[:, 1::2] > 0
            left_lo, left_hi, right_lo, right_hi = lo[:, ::2], hi[:, ::2], lo[:, 1::2], hi[:, 1::2]
            low = left_lo * size + np.where(more, right_lo, 0)
            high = np.where(more, left_lo * size + right_hi, left_hi * size)
            none = (left_lo >= left_hi) | (more & (right_lo >= right_hi))
            lo, hi = np.searchsorted(values, low, "left"), np.where(none, 0, np.searchsorted(values, high, "left"))
            filled, depth = filled[:, ::2] + filled[:, 1::2], 2 * depth
        suffixes = np.argsort(rank[:n], kind="stable")
        ordered = rank[:n][suffixes]
        first, last = np.searchsorted(ordered, lo[:, 0], "left"), np.searchsorted(ordered, hi[:, 0], "left")
        count = np.maximum(last - first, 0)
        piece = np.repeat(np.arange(len(can)), count)
        start = suffixes[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - first, count)]
        order = np.argsort(start, kind="stable")
        return start[order], can[piece[order]]

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk as little-endian 32-bit bytes."""
        codes = np.frombuffer(SEPARATOR.join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        begin, piece = self.edges(codes)
        sizes = np.array(list(map(len, chunks)))
        starts = np.cumsum(sizes + 1) - sizes - 1
        table = np.full((len(codes), self.width + 1), -1, np.int32)
        table[begin, self.length[piece]] = piece
        wide = {}
        for c in np.flatnonzero(sizes > WIDE).tolist():  # too many rounds: by their own queue
            lo, hi = np.searchsorted(begin, [starts[c], starts[c] + sizes[c]])
            wide[c] = self.relaxed(chunks[c], self._lengths(begin[lo:hi] - starts[c], piece[lo:hi], int(sizes[c])))
        lefts, rights, owners = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        rest = np.flatnonzero(sizes <= WIDE)
        owner = np.repeat(rest, sizes[rest])
        left = np.arange(len(owner)) - np.repeat(np.cumsum(sizes[rest]) - sizes[rest] - starts[rest], sizes[rest])
        right = left + 1
        while len(left):
            span = right[1:] - left[:-1]
            joins = (owner[1:] == owner[:-1]) & (span <= self.width)
            found = np.where(joins, table[left[:-1], np.where(joins, span, 0)], -1)
            worth = np.append(np.where(found >= 0, self.score[found], -np.inf), -np.inf)
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            group = np.cumsum(np.append(True, owner[1:] != owner[:-1])) - 1
            best = np.maximum.reduceat(worth, heads)
            at = np.flatnonzero((worth == best[group]) & (worth > -np.inf))
            at = at[np.append(True, group[at][1:] != group[at][:-1])] if len(at) else at  # the leftmost of each chunk
            going = (best > -np.inf)[group]
            lefts.append(left[~going])
            rights.append(right[~going])
            owners.append(owner[~going])
            right[at] = right[at + 1]
            going[at + 1] = False
            left, right, owner = left[going], right[going], owner[going]
        left, right, owner = np.concatenate(lefts), np.concatenate(rights), np.concatenate(owners)
        order = np.argsort(left, kind="stable")
        left, right, owner = left[order], right[order], owner[order]
        out = self.ids_of(codes, table[left, np.minimum(right - left, self.width)], left, owner, len(chunks))
        return [wide.get(c, ids) for c, ids in enumerate(out)] if wide else out

    def _lengths(self, start: np.ndarray, piece: np.ndarray, n: int) -> np.ndarray:
        """For each place the lengths of the pieces that start there, as bits."""
        return np.bincount(start, np.ldexp(1.0, self.length[piece] - 1), minlength=n).astype(np.uint64)[:n]

    def encode_long(self, chunk: str) -> bytes:
        """The ids of a chunk of any length, indexed block by block."""
        found = []
        for at in range(0, len(chunk), INDEX_CHARS):
            codes = np.frombuffer(chunk[at : at + INDEX_CHARS + self.width - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            start, piece = self.edges(codes)
            found.append(self._lengths(start, piece, len(codes))[:INDEX_CHARS].astype(np.uint32))
        return self.relaxed(chunk, np.concatenate(found))


    def ids_of(self, codes: np.ndarray, piece: np.ndarray, left: np.ndarray, owner: np.ndarray, n: int) -> list[bytes]:
        """Bytes of the ids of each of n chunks; a symbol without a piece is one character and becomes its bytes."""
        lost = np.flatnonzero(piece < 0)
        spelled = {int(c): [self.byte[b] for b in chr(c).encode("utf-8", "surrogatepass")] if self.byte else [self.unknown] for c in np.unique(codes[left[lost]])}
        many = np.ones(len(piece), np.int64)
        many[lost] = [len(spelled[int(c)]) for c in codes[left[lost]]]
        ids = np.repeat(np.where(piece >= 0, self.ids[piece], 0), many).astype("<u4")
        place = np.cumsum(many) - many
        for k in lost:
            ids[place[k] : place[k] + many[k]] = spelled[int(codes[left[k]])]
        stops = 4 * np.cumsum(np.bincount(owner, many, minlength=n).astype(np.int64))
        whole = ids.tobytes()
        return [whole[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]

    def relaxed(self, chunk: str, lengths: np.ndarray) -> bytes:
        """Ids of one chunk; lengths: where its edges are. Places wait in a queue for each rank, so a character takes a few bytes."""
        n, of, ranks = len(chunk), self.piece_of, self.ranks
        edge = array("Q" if lengths.dtype == np.uint64 else "I", lengths.tobytes())
        after, before, alive = array("i", range(1, n + 1)), array("i", range(-1, n)), bytearray(b"\x01") * n  # symbol at i: [i, after[i]); before[j]: where the one that ends at j starts
        queues: dict[int, tuple[array, list[int]]] = {}
        waiting: list[int] = []

        def joins(i: int, k: int) -> int:
            """The rank of the edge over [i, k), or -1."""
            return ranks[of[chunk[i:k]]] if k - i <= self.width and edge[i] >> (k - i - 1) & 1 else -1

        def wait(i: int, r: int) -> None:
            if r not in queues:
                queues[r] = array("i"), [0]
                heapq.heappush(waiting, r)
            places, done = queues[r]
            if places and places[-1] > i:
                bisect.insort(places, i, done[0])
            else:
                places.append(i)

        for i in range(n - 1):
            if (r := joins(i, i + 2)) >= 0:
                wait(i, r)
        while waiting:
            r = waiting[0]
            places, done = queues[r]
            if done[0] == len(places):
                heapq.heappop(waiting)
                del queues[r]
                continue
            i = places[done[0]]
            done[0] += 1
            j = after[i]
            if not alive[i] or j >= n or joins(i, after[j]) != r:
                continue
            k = after[j]
            alive[j], after[i], before[k] = 0, k, i
            h = before[i]
            if h >= 0 and (x := joins(h, k)) >= 0:
                wait(h, x)
            if k < n and (x := joins(i, after[k])) >= 0:
                wait(i, x)
        out, i = array("I"), 0
        while i < n:
            piece = of.get(chunk[i : after[i]])
            if piece is None:
                out.extend([self.byte[b] for b in chunk[i].encode("utf-8", "surrogatepass")] if self.byte else [self.unknown])
            else:
                out.append(self.id_list[piece])
            i = after[i]
        return out.tobytes()

    def decode(self, ids: bytes) -> str:
        parts = (b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids[k : k + 4 * DECODED], "<u4").tolist())) for k in range(0, len(ids), 4 * DECODED))
        return b"".join(parts).decode("utf-8", "replace").removeprefix(" ")


class Coder:
    def __init__(self, vocabulary: Vocabulary, limit: int = STORE_CHARS):
        self.vocabulary, self.limit, self.store, self.size = vocabulary, limit, {}, 0

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.vocabulary.library:
            return [np.array(x, "<u4").tobytes() for x in self.vocabulary.library.encode(texts)]
        cut = [CHUNKS.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if self.size > self.limit:
            self.store, self.size = {}, 0
        new = list(dict.fromkeys(c for chunks in cut for c in chunks if c not in self.store))
        part: list[str] = []
        size = 0
        for c in [*new, None]:
            if part and (c is None or size + len(c) > INDEX_CHARS):
                self.store.update(zip(part, self.vocabulary.encode_chunks(part), strict=True))
                self.size += size
                part, size = [], 0
            if c is not None and len(c) > INDEX_CHARS:
                self.store[c] = self.vocabulary.encode_long(c)
                self.size += len(c)
            elif c is not None:
                part.append(c)
                size += len(c) + 1
        return [b"".join(map(self.store.__getitem__, chunks)) for chunks in cut]


@lru_cache(1)
def _coder(key: str) -> Coder:
    """One for all tasks of a Python worker, as it keeps the chunks it has met."""
    from sentencepiece import SentencePieceProcessor

    vocabulary, library = Vocabulary(_MODELS[key]), SentencePieceProcessor(model_proto=_MODELS[key])
    if not vocabulary.like(library):
        vocabulary.library = library
    return Coder(vocabulary)


_MODELS: dict[str, bytes] = {}


def coder_of(model) -> Coder:
    key = hashlib.sha256(model.value).hexdigest()
    _MODELS[key] = model.value
    return _coder(key)


def _coded(model, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(model)
        vocabulary = coder.vocabulary
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text")
            for lo in range(0, b.num_rows, 500):
                part = [t.as_py() or "" for t in texts.slice(lo, 500)]
                coded = coder.encode(part)
                cols, names = [ids.slice(lo, 500), pa.array([len(c) // 4 for c in coded], pa.int64())], ["doc_id", "n_ids"]
                if digest:
                    back = [vocabulary.decode(c) for c in coded]
                    cols += [pa.array([hashlib.sha256(c).hexdigest() for c in coded]), pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in back]), pa.array([a == t for a, t in zip(back, part, strict=True)])]
                    names += ["ids_sha256", "decoded_sha256", "round_trip"]
                else:
                    cols, names = [*cols, pa.array(coded, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _model(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(Path(path).read_bytes())  # a vocabulary file, of fixed size


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids and the ids (little-endian 32-bit) of every row's text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_coded(_model(docs.sparkSession, path), False), CODED)


def decode(coded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with ids, as encode makes them; null ids give an empty text."""
    model = _model(coded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = coder_of(model).vocabulary
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([vocabulary.decode(i.as_py() or b"") for i in b.column("ids")], pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = _model(spark, public_tokenizers.path("piece_bpe_32k.model"))
    return docs.mapInArrow(_coded(model, True), "doc_id long, n_ids long, ids_sha256 string, decoded_sha256 string, round_trip boolean")
