"""Toxicity: a counterfactual-regularised linear classifier over whole texts.

Features of a text are the words it holds and their beginnings (presence, hashed); identity terms have
features of their own. Training adds to the logistic loss a penalty on the squared change of a sentence's
score when its identity terms are swapped for others of their group, so that naming a group moves the
score as little as the data allow. Labels are the only other input.

The fit uses at most MAX_TOXIC toxic and MAX_CLEAN other labelled documents (least hashes of doc_id); the
share of toxic rows among all training labels corrects the intercept. Features are counted and chosen in
Spark; the driver gets the MAX_FEATURES chosen ones and, for each sampled document, their places as 16-bit
numbers, so at most 2 * (MAX_TOXIC + MAX_CLEAN) * (MAX_FEATURES + terms) bytes, 200 MB, however long texts are.
Scoring covers every row and its whole text.

Each identity term is one feature of its own, so swapping a term in a sentence changes its score by the
difference of two weights: the penalty is computed on these and no swapped text has to be written.

Defined cases: null or empty text scores by the intercept; a null doc_id is scored and its label not used;
null labels are ignored, repeated labels count as toxic if one is; of rows that repeat a doc_id the fit uses
the one with the least text; without labels of both kinds, or without features, the score is that of the
shares or 0; repeated rows are scored alike; other columns of the table are kept out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table, trim

SPACE = 1 << 20
MAX_TOXIC, MAX_CLEAN, MAX_FEATURES = 4000, 8000, 8192
THRESHOLD, HELD_OUT = 0.3, 2
#: A feature must lean to one label by so many standard errors, and stand in so many of the sampled documents.
LEAST_LEAN, LEAST_DOCS = 3, 3
#: Words whose features a task keeps.
WORDS_KEPT = 100_000
#: Places of features handled at once in a step of the fit.
PORTION = 1 << 20
#: Groups of identity terms, of four languages; a term is swapped for others of its own group.
IDENTITY = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    ("african", "american", "arab", "asian", "chinese", "european", "indian", "mexican", "turkish", "polish", "russian"),
    ("africans", "americans", "arabs", "asians", "europeans", "indians", "mexicans", "turks", "poles", "russians"),
    ("black", "white", "latino", "brown"),
    ("woman", "man", "transgender", "nonbinary"),
    ("women", "men"),
    ("female", "male"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "homosexual"),
    ("deaf", "blind", "disabled", "autistic"),
    ("old", "young", "elderly", "teenage"),
    ("immigrant", "refugee", "native", "foreigner"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("frauen", "männer"), ("schwule", "lesben"), ("türken", "polen", "russen", "araber", "afrikaner"), ("ausländer", "einheimische", "flüchtlinge"),
    ("musulmán", "cristiano", "judío", "ateo"), ("musulmanes", "cristianos", "judíos", "ateos"), ("mujeres", "hombres"),
    ("árabes", "africanos", "asiáticos", "europeos"), ("extranjeros", "inmigrantes", "refugiados"),
    ("musulman", "chrétien", "juif", "athée"), ("musulmans", "chrétiens", "juifs", "athées"), ("femmes", "hommes"),
    ("arabes", "africains", "asiatiques", "européens"), ("étrangers", "immigrés", "réfugiés"),
)
TERMS = {w: SPACE + i for i, w in enumerate(w for g in IDENTITY for w in g)}
SWAPS = {TERMS[w]: [TERMS[x] for x in g[k + 1 :] + g[:k]] for g in IDENTITY for k, w in enumerate(g)}
WORDS = re.compile(r"\w+")


def word_features(word: str) -> list[int]:
    if word in TERMS:
        return [TERMS[word]]
    names = [f"w{word}", *(f"{n}{word[:n]}" for n in (4, 5, 6) if len(word) >= n)]
    return [xxhash.xxh3_64_intdigest(n) % SPACE for n in names]


def text_features(text: str) -> np.ndarray:
    return np.fromiter({f for w in set(WORDS.findall(text.lower())) for f in word_features(w)}, np.int32)


@dataclass
class Model:
    weights: dict[int, float] = field(default_factory=dict)
    bias: float | None = None  # None: nothing learned, every score is 0

    def logits(self, text: str, store: dict[str, tuple[int, ...]]) -> float:
        found: set[int] = set()
        for w in set(WORDS.findall(text.lower())):
            f = store.get(w)
            if f is None:
                if len(store) > WORDS_KEPT:
                    store.clear()
                f = store[w] = tuple(x for x in word_features(w) if x in self.weights)
            if f:
                found.update(f)
        return self.bias + sum(self.weights[x] for x in sorted(found))

    def score(self, text: str, store: dict) -> float:
        if self.bias is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.logits(text, store), -30, 30))))


def train(rows: list[np.ndarray], toxic: np.ndarray, strength: float = 1.0, rounds: int = 200, rate: float = 0.1, decay: float = 1e-3, slots: np.ndarray | None = None) -> Model:
    """rows: features of each text, as places in `slots` if that is given. strength weighs the counterfactual penalty; 0 leaves it out."""
    toxic = np.asarray(toxic, np.float64)
    if not len(rows) or toxic.min() == toxic.max():
        return Model()
    ends = np.cumsum([len(r) for r in rows])
    at = np.concatenate(rows)
    if slots is None:
        slots = np.union1d(at, list(TERMS.values()))
        at = np.searchsorted(slots, at)
    # portions of whole documents, each with its first document and its places
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(PORTION, ends[-1], PORTION)), [0, len(rows)]))
    starts = np.append(0, ends)
    spans = [(lo, hi, starts[lo], starts[hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    owner = lambda lo, hi: np.repeat(np.arange(hi - lo), np.diff(starts[lo : hi + 1]))
    named = [(lo, hi, *(x[slots[at[a:z]] >= SPACE] for x in (owner(lo, hi), at[a:z].astype(np.int64)))) for lo, hi, a, z in spans]
    pairs = sum(len(np.unique(d)) for _, _, d, _ in named) or 1
    base = toxic.mean()
    w, b = np.zeros(len(slots)), np.log(base / (1 - base))
    m, v = np.zeros(len(slots) + 1), np.zeros(len(slots) + 1)
    n = len(rows)
    swaps = {int(k): np.searchsorted(slots, SWAPS[int(slots[k])]) for k in np.flatnonzero(slots >= SPACE)}
    for step in range(1, rounds + 1):
        g, g0 = decay * w, 0.0
        for (lo, hi, a, z), (_, _, d, t) in zip(spans, named, strict=True):
            doc, place = owner(lo, hi), at[a:z].astype(np.int64)
            score = b + np.bincount(doc, w[place], minlength=hi - lo)
            miss = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - toxic[lo:hi]) / n
            g += np.bincount(place, miss[doc], minlength=len(slots))
            g0 += miss.sum()
            if strength and len(t):
                other = np.array([swaps[x][step % len(swaps[x])] for x in t.tolist()])
                change = np.bincount(d, w[t] - w[other], minlength=hi - lo)
                push = 2 * strength * change[d] / pairs
                g += np.bincount(t, push, minlength=len(slots)) - np.bincount(other, push, minlength=len(slots))
        g = np.append(g, g0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model({int(s): float(x) for s, x in zip(slots, w, strict=True) if abs(x) > 1e-3}, float(b))


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == HELD_OUT


def _chosen(sampled: DataFrame, n: int, bad: int) -> np.ndarray:
    """The features (sorted) that lean most to one label, at most MAX_FEATURES, and all identity terms; counted over `sampled` (toxic, features)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.zeros((2, SPACE), np.int32)
        for b in batches:
            for k, x in zip(b.column("toxic").to_pylist(), b.column("features").to_pylist(), strict=True):
                f = np.frombuffer(x, np.int32)
                there[k, f[f < SPACE]] += 1
        f = np.flatnonzero(there.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (f, there[:, f].sum(axis=0), there[1, f])], names=["feature", "docs", "bad"])

    base = bad / max(1, n)
    counts = sampled.mapInArrow(count, "feature long, docs long, bad long").groupBy("feature").agg(F.sum("docs").alias("docs"), F.sum("bad").alias("bad"))
    lean = F.abs(F.col("bad") - F.col("docs") * base) / F.sqrt(F.col("docs") * (base * (1 - base)) + 1)
    best = counts.where(F.col("docs") >= min(LEAST_DOCS, 1 + n // 100)).withColumn("lean", lean).where(F.col("lean") > LEAST_LEAN).orderBy(F.desc("lean"), "feature").limit(MAX_FEATURES)
    return np.union1d([r["feature"] for r in best.select("feature").collect()], list(TERMS.values())).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, strength: float = 1.0) -> Model:
    """Learn from labels (doc_id, toxic) whose row isn't held out."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out())
    share = {r["toxic"]: r["n"] for r in known.groupBy(F.when(F.col("toxic") == 1, 1).otherwise(0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    least = lambda rows, n: rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    sample = least(known.where("toxic = 1"), MAX_TOXIC).unionAll(least(known.where("toxic <> 1"), MAX_CLEAN))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array([text_features(t.as_py()).tobytes() for t in b.column("text")], pa.binary())], names=["toxic", "features"])

    told = F.broadcast(sample.select("doc_id", F.col("toxic").cast("int").alias("toxic")))  # at most MAX_TOXIC + MAX_CLEAN rows
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(told, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sampled = cut(texts.select(F.when(F.col("toxic") == 1, 1).otherwise(0).alias("toxic"), "text").mapInArrow(features, "toxic int, features binary"))
    n, bad = sampled.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    slots = _chosen(sampled, n, bad)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column("features").to_pylist():
                f = np.frombuffer(x, np.int32)
                at = np.minimum(np.searchsorted(slots, f), len(slots) - 1)
                out.append(at[slots[at] == f].astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(out, pa.binary())], names=["toxic", "places"])

    got = sampled.mapInArrow(places, "toxic int, places binary").toArrow()
    model = train([np.frombuffer(x, np.uint16) for x in got.column("places").to_pylist()], got.column("toxic").to_numpy(), strength, slots=slots)
    toxic = np.array([bad, n - bad])
    if model.bias is not None and share.get(0) and share.get(1):
        model.bias += np.log(share[1] / share[0]) - np.log(toxic[0] / toxic[1])
    return model


def with_score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """docs with the score of each row's text."""
    import pandas as pd

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        store: dict[str, tuple[int, ...]] = {}
        for t in texts:
            yield pd.Series([shared.value.score(x or "", store) for x in t], dtype="float64")
        store.clear()
        trim()

    run.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(column, F.pandas_udf(run, "double")(F.col("text")))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return with_score(docs, model).select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
