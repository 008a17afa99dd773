"""The operators of alertloom.llm against brute force on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import re
import tracemalloc
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("alertloom.llm")
from alertloom.llm import chat, fingerprints, lines, packing, pieces, similar, substrings, topk, toxicity, urls
from alertloom.llm.common import components, packed_batch, ship

P = pytest.importorskip("public_tokenizers")
BYTES = P.path("byte_bpe_50k.json")
HIT = ["query_id", "rank", "vec_id", "score"]
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
A, B = " ".join(f"alpha{k}" for k in range(60)), " ".join(f"beta{k}" for k in range(60))
DOCS = [
    (5, A),
    (2, B),
    (3, A + " tail"),
    (9, A.upper()),
    (4, "x y " + A[: len(A) // 2] + "\nShared line of text\n" + B[:200]),
    (7, "Shared line of text\n  shared LINE of text \nshort\nshort"),
    (8, None),
    (10, ""),
    (11, "   \n\t "),
    (12, "two words"),
    (13, "two words"),
    (13, "two words"),
    (None, "Shared line of text\nwith no id"),
    (20, ("long " * 30_000).strip()),
    (21, "é" * 3 + " ﬁ Straße x\n\n"),
]
SCHEMA = "doc_id long, text string, _id int, tag string, gone string, score string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame([(i, t, 1, "a", "b", "c", len(t or "")) for i, t in DOCS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def low(i):
    return -(2**63) if i is None else i


# 1


def test_toxicity_finds_the_word_and_evens_out_groups(spark):
    ship(spark)
    rng = np.random.default_rng(1)
    plain = [f"w{k}" for k in range(200)]
    texts, toxic = [], []
    for k in range(400):
        bad = k % 4 == 0
        words = [*rng.choice(plain, 20), *(["idiot"] if bad else [])]
        if k % 2 == 0 and bad or k % 40 == 1:
            words.append("muslim")  # named mostly where it is toxic
        if k % 40 == 3:
            words.append("christian")
        texts.append(" ".join(words))
        toxic.append(int(bad))
    feats = [toxicity.text_features(t) for t in texts]
    free, even = toxicity.train(feats, np.array(toxic), strength=0.0), toxicity.train(feats, np.array(toxic), strength=50.0)
    gap = lambda m: abs(m.logits("the muslim sat", {}) - m.logits("the christian sat", {}))
    assert gap(even) < gap(free) / 2
    assert even.score("you idiot", {}) > 0.5 > toxicity.THRESHOLD > even.score("the muslim sat", {})
    assert toxicity.train([], np.array([])).score("x", {}) == 0.0


def test_toxicity_query(spark, docs, empty):
    n = 300
    text = [f"word{k % 7} other{k % 11} {'idiot' if k % 5 == 0 else 'kind'}" for k in range(n)]
    d = spark.createDataFrame([(k, t) for k, t in enumerate(text)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(n)] + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.fit(d, labels)
    got = {r.doc_id: r.score for r in toxicity.with_score(d, model).collect()}
    held = [k for k in range(n) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert held and all((got[k] >= 0.3) == (k % 5 == 0) for k in held)
    again = toxicity.with_score(docs.drop("score"), model)
    assert again.count() == len(DOCS) and again.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.fit(empty, labels.limit(0)).bias is None


def test_toxicity_fit_with_repeated_ids_and_a_long_text(spark):
    ship(spark)
    n = 200
    text = [(k, f"word{k % 7} other{k % 11} {'idiot' if k % 5 == 0 else 'kind'}") for k in range(n)]
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(n)], "doc_id long, toxic int")
    once = spark.createDataFrame([*text, (1, "a" * 5_000_000), (None, "no id")], "doc_id long, text string")
    often = spark.createDataFrame([*text, *[(1, "zz later text")] * 50, *[(5, "zz later text")] * 50, (1, "a" * 5_000_000), (None, "no id")], "doc_id long, text string")
    a, b = toxicity.fit(once, labels), toxicity.fit(often.repartition(7), labels)
    assert a.bias == b.bias and a.weights == b.weights  # the least text of an id is the one that counts
    got = {r.text: r.score for r in toxicity.with_score(once, a).collect()}
    for t in [t for _, t in text] + ["a" * 5_000_000, "no id"]:
        plain = a.bias + sum(w for f, w in a.weights.items() if f in set(toxicity.text_features(t).tolist()))
        assert abs(got[t] - 1 / (1 + np.exp(-plain))) < 1e-9


def test_toxicity_portions_change_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    feats, toxic = [np.unique(rng.integers(0, 90, rng.integers(0, 30))).astype(np.int32) for _ in range(60)], rng.integers(0, 2, 60)
    feats[3] = np.append(feats[3], np.int32(toxicity.TERMS["muslim"]))
    whole = toxicity.train(feats, toxic, rounds=30)
    monkeypatch.setattr(toxicity, "PORTION", 50)
    parts = toxicity.train(feats, toxic, rounds=30)
    assert whole.weights.keys() == parts.weights.keys() and all(abs(parts.weights[k] - w) < 1e-6 for k, w in whole.weights.items())


# 2


def test_topk_equals_brute_force(spark):
    ship(spark)
    rng = np.random.default_rng(2)
    v = rng.normal(size=(700, 16)).astype(np.float32)
    v[300:500] = v[300]
    data = [(int(i), [float(x) for x in row]) for i, row in enumerate(v)]
    data += [(1000, None), (1050, [float("nan")] * 16), (1100, [None] + [0.0] * 15), (None, [1.0] * 16), (2000, [0.5] * 3)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = rows(topk.top_k(df, df.where("vec_id % 50 = 0"), 5), "query_id", "rank", "vec_id", "score")
    q = {i: np.pad(np.floor(256 * np.array(e, np.float64)), (0, 16 - len(e))) for i, e in data if i is not None and e is not None and None not in e and np.isfinite(e).all()}
    q = {i: np.floor(256 * np.array(np.float32(data[k][1]), np.float64)) for k, (i, e) in enumerate(data) if i in q and len(e) == 16} | {2000: q[2000]}
    want = []
    for i in q:
        if i % 50 == 0:
            s = sorted((-int(q[i] @ q[j]), j) for j in q if j != i)[:5]
            want += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    assert got == sorted(want, key=repr)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_topk_takes_a_repeated_query_row_once(spark):
    ship(spark)
    rng = np.random.default_rng(4)
    data = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(60)]
    v = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    again = v.where("vec_id = 50")
    q = v.where("vec_id % 50 = 0").unionAll(again).unionAll(again.selectExpr("vec_id", "concat(embedding, array(cast(0 as float)))"))
    assert rows(topk.top_k(v, q, 5), *HIT) == rows(topk.top_k(v, v.where("vec_id % 50 = 0"), 5), *HIT)
    both = v.unionAll(again)  # among the vectors, too, the query's own rows are no candidates
    assert rows(topk.top_k(both, both.where("vec_id = 50"), 5), *HIT) == rows(topk.top_k(v, again, 5), *HIT)


def test_topk_with_repeats_clashing_columns_and_many_cells(spark, monkeypatch):
    ship(spark)
    rng = np.random.default_rng(19)
    data = [(int(i), [float(x) for x in row], 1, 2) for i, row in enumerate(rng.normal(size=(300, 6)))]
    data += data[7:9] + data[7:8]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, score int, rank int").repartition(3)
    monkeypatch.setattr(topk, "CELL_ROWS", 20)
    monkeypatch.setattr(topk, "CHUNK", 2)
    q = [np.floor(256 * np.array(r[1])).astype(int) for r in data]
    want = []
    for a in range(0, 300, 50):
        best = sorted((-int(q[a] @ q[k]), r[0]) for k, r in enumerate(data) if r[0] != a)[:5]
        want += [(a, n + 1, i, -x) for n, (x, i) in enumerate(best)]
    assert rows(topk.top_k(df, df.where("vec_id % 50 = 0"), 5), *HIT) == sorted(want, key=repr)
    with pytest.raises(Exception, match="too large"):
        topk.top_k(spark.createDataFrame([(0, [1e9]), (1, [1e9])], "vec_id long, embedding array<double>"), df.where("vec_id = 0").select("vec_id", "embedding"), 5).collect()


# 3


def shingles(t, n):
    w = [x.lower() if x.isascii() else x for x in WORDS.findall(t or "")]
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_components(data, n, num, den):
    sets = [(low(i), shingles(t, n)) for i, t in data]
    par = {i: i for i, _ in sets}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and den * len(a & b) >= num * len(a | b):
                p, q = sorted((find(i), find(j)))
                par[q] = p
    return {i: find(i) for i in par}, sets


def test_similar_equals_brute_force(spark, docs, empty):
    rng = np.random.default_rng(3)
    data = list(DOCS)
    base = [f"w{k}" for k in rng.integers(0, 500, 120)]
    for k in range(60):  # near copies at all distances
        words = list(base)
        for _ in range(k // 4):
            words[rng.integers(0, len(words))] = f"n{rng.integers(0, 10**6)}"
        data.append((100 + k, " ".join(words)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    for n, num, den in ((4, 85, 100), (5, 80, 100)):
        comp, sets = brute_components(data, n, num, den)
        got = rows(similar.ngram_components(df, n, num, den), "doc_id", "n_shingles", "component_id")
        back = lambda i: None if i == -(2**63) else i
        assert got == sorted(((back(i), len(s), back(comp[i])) for i, s in sets), key=repr)
    kept = similar.keep_one(docs, 4, 85, 100)
    assert kept.columns == docs.columns
    comp, _ = brute_components(DOCS, 4, 85, 100)
    assert sorted(low(r.doc_id) for r in kept.collect()) == sorted({i for i in comp if comp[i] == i})
    assert similar.ngram_components(empty).count() == 0


def near_copies(n, seed):
    rng = np.random.default_rng(seed)
    bases = [[f"b{b}x{k}" for k in range(90)] for b in range(3)]
    out = []
    for k in range(n):
        words = list(bases[k % 3])
        for _ in range(int(rng.integers(0, 9))):
            words[rng.integers(0, len(words))] = f"n{rng.integers(0, 10**6)}"
        out.append((1000 + k, " ".join(words)))
    return out


def test_similar_with_dealt_cells_and_hot_shingles(spark, monkeypatch):
    ship(spark)
    data = [*near_copies(150, 8), *((5000 + k, near_copies(3, 9)[k % 3][1]) for k in range(30)), (1000, A), (None, B), (None, B + " end")]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    comp, sets = brute_components(data, 4, 85, 100)
    assert len({comp[i] for i, _ in data if i and 1000 < i < 1150}) > 3  # not all of them are linked
    back = lambda i: None if i == -(2**63) else i
    want = sorted(((back(i), len(s), back(comp[i])) for i, s in sets), key=repr)
    for docs, shingles_, hot in ((10, 1 << 22, 1 << 16), (2048, 2000, 1 << 16), (16, 1 << 22, 5)):
        monkeypatch.setattr(similar, "CELL_DOCS", docs)
        monkeypatch.setattr(similar, "CELL_SHINGLES", shingles_)
        monkeypatch.setattr(similar, "HOT", hot)
        assert rows(similar.ngram_components(df, 4, 85, 100), "doc_id", "n_shingles", "component_id") == want


def test_partnered_keeps_what_fits():
    rng = np.random.default_rng(12)
    h, n = np.sort(rng.integers(0, 40, 400)), rng.integers(1, 40, 400)
    order = np.lexsort((n, h))
    h, n = h[order], n[order]
    place = rng.integers(0, n)
    got = similar.partnered(h, n, place, 80, 100)
    fits = lambda x, y: h[x] == h[y] and 80 * max(n[x], n[y]) <= 100 * min(n[x], n[y]) and 180 * min(n[x] - place[x], n[y] - place[y]) >= 80 * (n[x] + n[y])
    assert got.tolist() == [any(x != y and fits(x, y) for y in range(400)) for x in range(400)]


def test_keep_one_drops_near_copies_only(spark):
    ship(spark)
    c = " ".join(f"gamma{k}" for k in range(60))
    data = [(None, A), (None, B), (None, c), (None, A + " tail"), (None, c), (7, B + " end"), (7, "other words of the same id here"), (7, None), (None, ""), (None, ""), (9, "Other words of the same id here"), (9, c + " z"), (7, "x " + A), (30, "lone text of its own id"), (30, "lone text of its own id")]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(data)], "doc_id long, text string, node int")
    kept = similar.keep_one(df, 5, 80, 100)
    assert kept.columns == df.columns
    want = [(None, A), (None, B), (None, c), (7, "other words of the same id here"), (7, None), (None, ""), (None, ""), (30, "lone text of its own id")]
    assert rows(kept, "doc_id", "text") == sorted(want, key=repr)


def test_trie_prunes_nothing_that_counts():
    rng = np.random.default_rng(4)
    sets = {k: np.sort(rng.choice(40, rng.integers(1, 30), replace=False)).astype("<u8").tobytes() for k in range(80)}
    trie = similar.Trie(sets)
    for b in sets.values():
        a = set(np.frombuffer(b, "<u8"))
        want = [k for k, x in sets.items() if 10 * len(a & set(np.frombuffer(x, "<u8"))) >= 6 * len(a | set(np.frombuffer(x, "<u8")))]
        assert sorted(trie.alike(b, 6, 10)) == want


def test_components(spark):
    e = spark.createDataFrame([(k, k + 1) for k in range(100, 140)] + [(5, 3), (3, 3), (9, 5), (None, 1)], "a long, b long")
    got = {r.node: r.component for r in components(e).collect()}
    assert got == {**{k: 100 for k in range(100, 141)}, 3: 3, 5: 3, 9: 3}


# 4


def test_pieces_equal_sentencepiece_and_round_trip(spark, docs, empty):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    coded = pieces.encode(docs, path)
    got = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.n_ids) for r in coded.collect()]
    want = [(i, e, len(e)) for (i, t), e in zip(DOCS, sp.encode([t or "" for _, t in DOCS]), strict=True)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sorted(r.text for r in pieces.decode(coded, path).collect()) == sorted(t or "" for _, t in DOCS)
    assert pieces.encode(empty, path).count() == 0
    odd = ["  a", "a  b ", "日本 ▁ x", "😀😀‍", "<s> <0x0A>", "a\0b", "A" * 300, "é" * 100 + "z"]
    coder = pieces.Coder(pieces.Vocabulary(open(path, "rb").read()))
    assert [np.frombuffer(c, "<u4").tolist() for c in coder.encode(odd)] == sp.encode(odd)


def test_pieces_of_long_chunks_and_many_letters(monkeypatch):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    voc = pieces.Vocabulary(open(path, "rb").read())
    rng = np.random.default_rng(17)
    letters = [chr(x) for x in [*range(97, 123), *range(0x4E00, 0x4E00 + 400), 0x1F600, 0xE9]]
    texts = ["".join(rng.choice(letters, n)) for n in (30, 300, 3000)] + ["".join(rng.choice(list("abcdetnrs"), 5000)), "a" * 4000, "ab" * 3000, "the" * 900]
    coder = pieces.Coder(voc)
    want = sp.encode(texts)
    assert [np.frombuffer(c, "<u4").tolist() for c in coder.encode(texts)] == want
    monkeypatch.setattr(pieces, "INDEX_CHARS", 700)
    assert [np.frombuffer(c, "<u4").tolist() for c in pieces.Coder(voc).encode(texts)] == want
    assert voc.like(sp)
    monkeypatch.setattr(voc, "score", voc.score[::-1].copy())
    assert not voc.like(sp)


def test_pieces_edges_are_all_occurrences():
    voc = pieces.Vocabulary(open(P.path("piece_bpe_32k.model"), "rb").read())
    for text in ("\u2581international\u2581organizations\0\u2581the\u2581the", "".join(chr(0x4E00 + k) for k in range(300)) + "tion\u2581the"):
        start, piece = voc.edges(np.array([ord(c) for c in text]))
        want = sorted((k, t) for t in voc.text for k in range(len(text)) if text.startswith(t, k))
        assert sorted((int(s), voc.text[p]) for s, p in zip(start, piece, strict=True)) == want


def test_pieces_of_a_word_of_a_million_letters():
    import resource

    voc = pieces.Vocabulary(open(P.path("piece_bpe_32k.model"), "rb").read())
    word = "".join(np.random.default_rng(18).choice(list("abcdefghijklmnopqrst"), 1_000_000))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    ids = pieces.Coder(voc).encode([word])[0]
    assert voc.decode(ids) == word
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 150_000  # KB


# 5


@pytest.mark.parametrize("bits", [128, 2])
def test_fingerprints(spark, docs, bits):
    data = sorted(((low(i), t or "") for i, t in DOCS), key=lambda x: (-x[0], x[1]))
    canon = lambda t: " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t).casefold()).split())
    want = []
    for k, (i, t) in enumerate(data):
        after, n = data[(k + 1) % len(data)][1], len(t)
        edited = t[: n - n // 2] + after[: n // 2]
        want.append((None if i == -(2**63) else i, n, sha(edited), float(canon(t) == canon(edited)), float(canon(t) == canon(after))))
    out = fingerprints.fingerprints(docs, bits)
    assert rows(out, "doc_id", "n_chars", "edited_sha256", "near_edited", "near_next") == sorted(want, key=repr)
    by = {}
    for r in out.collect():
        by.setdefault(r.fingerprint, set()).update(canon(t or "") for i, t in DOCS if i == r.doc_id)
    texts = {sha(t[: len(t) - len(t) // 2] + data[(k + 1) % len(data)][1][: len(t) // 2]): canon(t[: len(t) - len(t) // 2] + data[(k + 1) % len(data)][1][: len(t) // 2]) for k, (_, t) in enumerate(data)}
    for r in out.collect():
        by.setdefault(r.edited_fingerprint, set()).add(texts[r.edited_sha256])
    assert all(len(x) == 1 for x in by.values())  # different texts never share one, however few bits, edited ones included
    assert len({next(iter(x)) for x in by.values()}) == len(by)  # and equal ones always do


def test_fingerprints_of_very_long_texts(spark):
    ship(spark)
    t = "Ä b\t" * 700_000
    df = spark.createDataFrame([(1, t), (2, t.lower().replace("\t", "  ")), (3, "x")], "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.fingerprints(df).collect()}
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint and got[2].near_next == 1.0


def test_fingerprints_of_few(spark, empty):
    assert fingerprints.fingerprints(empty).count() == 0
    r = fingerprints.fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert r.edited_sha256 == sha("abab")


# 6


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTES)
    docs = docs.unionByName(docs.limit(1).withColumns({"doc_id": F.lit(30).cast("long"), "text": F.lit("hello <|endoftext|> x<|endoftext|><|endof")}))
    DOCS = [*globals()["DOCS"], (30, "hello <|endoftext|> x<|endoftext|><|endof")]
    for cap in (2048, 16):
        want = []
        for i, text in DOCS:
            ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
            head = (len(ids) - 1) % cap + 1
            cuts = [0, *range(head, len(ids), cap), len(ids)]
            want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
        out = packing.pack(docs, BYTES, cap)
        assert rows(out, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want, key=repr)
        ends = {}
        for seq, at, n in sorted((r.sequence_id, r.offset, r.length) for r in out.collect()):
            assert at == ends.get(seq, 0)
            ends[seq] = at + n
        assert max(ends.values()) <= cap
    assert packing.pack(empty, BYTES).count() == 0


def test_ids_equal_the_tokenizer_over_a_table():
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()]
    texts += [" " * 3_000_000, "a" * 200_000, "\u00a0\u3000 x\r\n\t\t", "\U0001f468\u200d\U0001f469 'LL 'll", "1234567 ½ ² ٣"]
    t, mine = Tokenizer.from_file(BYTES), packing.text_ids(BYTES)
    assert mine.fast
    for text, e in zip(texts, t.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(mine.ids(text), "<u4").tolist() == e.ids


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(6)
    for _ in range(30):
        cap = int(rng.integers(5, 60))
        lengths = rng.integers(1, cap + 1, rng.integers(1, 300))
        runs = packing.plan_slots(np.bincount(lengths, minlength=cap + 1), cap)
        bins = []
        for n in sorted(lengths.tolist(), reverse=True):
            fit = [b for b in range(len(bins)) if bins[b] >= n]
            if fit:
                bins[min(fit, key=lambda b: bins[b])] -= n
            else:
                bins.append(cap - n)
        used = {}
        for n in np.unique(lengths):
            own = runs[runs[:, 0] == n]
            for rank in range((lengths == n).sum()):
                r = own[own[:, 1] <= rank][-1]
                i = rank - r[1]
                used.setdefault(r[3] + i // r[2], []).append((r[4] + i % r[2] * n, n))
        assert len(used) == len(bins)
        for spots in used.values():
            spots.sort()
            assert all(a + n == b for (a, n), (b, _) in zip(spots, spots[1:], strict=False)) and spots[0][0] == 0 and sum(spots[-1]) <= cap


# 7


def brute_substrings(data, window):
    ws = [(low(i), WORDS.findall(t or "")) for i, t in data]
    first = {}
    for i, w in ws:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in ws:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((None if i == -(2**63) else i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [13, 4])
def test_substrings(spark, docs, window):
    rng = np.random.default_rng(7)
    data = [*DOCS, (None, A), (5, B), *((200 + k, " ".join(f"t{x}" for x in rng.integers(0, 3, 80))) for k in range(20))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(substrings.substring_digests(df, window), "doc_id", "n_words", "n_removed", "kept_sha256") == brute_substrings(data, window)


@pytest.mark.parametrize("window", [13, 4])
def test_substrings_below_lengthened_prefixes(spark, monkeypatch, window):
    ship(spark)
    rng = np.random.default_rng(13)
    passage = [f"p{k}" for k in range(30)]
    data = [*DOCS, (None, A), *((300 + k, " ".join([*(f"u{x}" for x in rng.integers(0, 9**6, 7)), *passage[rng.integers(0, 5) :], *(f"t{x}" for x in rng.integers(0, 3, 40))])) for k in range(40))]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    for load, size in ((10, 8 << 20), (10**9, 500)):
        monkeypatch.setattr(substrings, "HOT_LOAD", load)
        monkeypatch.setattr(substrings, "GROUP_BYTES", size)
        monkeypatch.setattr(substrings, "GATHERED", 300)
        assert rows(substrings.substring_digests(df, window), "doc_id", "n_words", "n_removed", "kept_sha256") == brute_substrings(data, window)


def test_maximal_repeats(spark):
    ship(spark)
    p, q = [f"p{k}" for k in range(70)], [f"q{k}" for k in range(20)]
    data = [(1, " ".join(["a", *p, "b", *q])), (2, " ".join(["c", "d", *p[5:65], "e", *q[:12]])), (3, " ".join([*q, "f", "g", *p])), (4, "no repeat here")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = [(2, 2, 60), (3, 0, 20), (3, 22, 70)]
    assert rows(substrings.maximal_repeats(df, 13), "doc_id", "start", "n_words") == want


def test_subtree_orders_suffixes():
    rng = np.random.default_rng(14)
    lengths = rng.integers(1, 30, 40)
    words = [f"{x}".encode() for x in rng.integers(0, 3, lengths.sum())]
    stops = np.repeat(np.cumsum(lengths), lengths)
    suffix = [tuple(words[k : min(k + 16, stops[k])]) for k in range(len(words))]
    order, common = substrings.Subtree(words, lengths, 13).sorted(np.arange(len(words)))
    assert [suffix[k] for k in order] == sorted(suffix)
    for a, b, n in zip(order, order[1:], common[1:], strict=False):
        x, y = suffix[a], suffix[b]
        assert n == next((k for k, (u, v) in enumerate(zip(x, y, strict=False)) if u != v), min(len(x), len(y)))


def test_part_of_suffixes_is_held_in_little_memory():
    """A part's words are held once each, and its numbers in few copies: a worker's peak stands beside the JVM's."""
    rng = np.random.default_rng(3)
    n, window = 2000, 50
    body = np.array([b"w%d" % k for k in range(20_000)], object)[rng.integers(0, 20_000, (n, 100))]
    body[1::2, 20:80] = body[::2, 20:80]  # each second stretch holds 60 words of the one before it
    text = [b" ".join(x) for x in body.tolist()]
    i8 = lambda x: np.array([x], "<i8").tobytes()
    u4 = lambda x: np.array([x], "<u4").tobytes()
    rows = [(0, substrings.STRETCH, substrings.pack_longs(np.array([k])), i8(7 * k), u4(5), u4(100 - window + 1), t, b"", b"") for k, t in enumerate(text)]
    part = pa.Table.from_batches([packed_batch(rows, substrings.NODES)])
    tracemalloc.start()
    got = substrings._repeats(part, window)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = [{"_id": k, "tag": 7 * k, "start": 25, "len": 11} for k in range(1, n, 2)]
    assert sorted(got.to_pylist(), key=lambda r: r["_id"]) == want
    assert peak < 18 * sum(map(len, text))


def test_substring_stage_keeps_columns(docs, empty):
    out = substrings.dedup_substrings(docs, 13)
    assert out.columns == docs.columns and out.count() == len(DOCS)
    assert out._jdf.queryExecution().sparkPlan().toString().count("MapInArrow") == 1  # one walk over the texts and their parts, not one for rows that change and one for others
    got = {r.doc_id: r for r in out.collect()}
    assert got[2].text == B and got[3].text == A + " tail" and got[5].text == "" and got[5].n_chars == 0 and got[8].text is None
    assert substrings.dedup_substrings(empty, 50).count() == substrings.substring_digests(empty).count() == 0
    with pytest.raises(ValueError):
        substrings.repeat_runs(docs, 2)


# 8


def brute_lines(data):
    blank = " \t\n\x0b\x0c\r"
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(blank))
    holders = {}
    for i, t in data:
        for x in (t or "").split("\n"):
            holders.setdefault(key(x), set()).add(low(i))
    out = []
    for i, t in data:
        ls = (t or "").split("\n")
        kept = [x for x in ls if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == low(i)]
        out.append((i, len(ls), len(ls) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


def test_lines(spark, docs, empty):
    many = [*DOCS, *((300 + k, f"head {k}\nvery common line here\nend of {k % 3} things") for k in range(3000))]  # a hot key
    df = spark.createDataFrame(many, "doc_id long, text string")
    got = lines.with_keep(df, columns=["doc_id", "text"]).select("doc_id", F.col("_n_lines").alias("a"), F.col("_n_dropped").alias("b"), F.sha2(lines.kept_text(), 256).alias("c"))
    assert rows(got, "doc_id", "a", "b", "c") == brute_lines(many)
    out = lines.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == len(DOCS)
    bits = lines.keep_bitmaps(docs)
    assert bits.where("n_lines - n_dropped <> aggregate(keep, 0, (s, r) -> s + r.len)").count() == 0
    assert lines.keep_bitmaps(empty).count() == 0


# 9


def test_chat_round_trip(spark, tmp_path):
    ship(spark)
    nasty = r"\### Assistant: </turn> ok \\ ### User: x"
    turns = [(1, 0, "user", nasty), (1, 1, "assistant", nasty), (1, 2, "tool]x\\", "a"), (2, 0, None, None), (2, 0, "assistant", "b"), (2, 0, "assistant", "b"), (None, 3, "user", "z"), (3, None, "assistant", "q")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    m = chat.turns_as_chain(df)
    out = chat.format_turns(m, chat.reply_paths(m))
    got = rows(chat.read_back(out), "tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    want = []
    for c in {t[0] for t in turns}:
        ts = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == c))
        learned = "".join(x for *_, r, x in ts if r == "assistant")
        want.append(("null" if c is None else str(c), len(ts), sha("".join(f"{r}\n{x}\n" for *_, r, x in ts)), len(learned), sha(learned)))
    assert got == sorted(want, key=repr)
    for r in chat.conversations_text(out).collect():
        assert all(0 <= s.start <= s.end <= len(r.formatted) for s in r.loss)
        assert "".join(chat.unescape(r.formatted[s.start : s.end]) for s in r.loss) == "".join(x for role, x in chat.parse(r.formatted) if role == "assistant")
    assert chat.read_back(chat.format_turns(m.limit(0), chat.reply_paths(m.limit(0)))).count() == 0


def test_chat_parse_of_hostile_and_long_texts():
    rng = np.random.default_rng(16)
    bits = ["\\", "### ", "</turn>", "</turn>\n", "]: ", "a", "\n", "User: ", "["]
    esc = lambda t: re.sub(r"(\\|### |</turn>)", r"\\\1", t)
    for _ in range(500):
        turns = [(["user", "assistant", "".join(rng.choice(bits, 3))][rng.integers(0, 3)], "".join(rng.choice(bits, rng.integers(0, 12)))) for _ in range(rng.integers(1, 4))]
        head = lambda r: chat.ROLES.get(r) or "[" + re.sub(r"([\\\]])", r"\\\1", r) + "]"
        assert chat.parse("".join(f"### {head(r)}: {esc(t)}</turn>\n" for r, t in turns)) == turns
    import resource

    big = ["<" * 5_000_000, "\\" * 5_000_000, "x" * 5_000_000]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for t in big:
        assert chat.parse(f"### User: {esc(t)}</turn>\n") == [("user", t)]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000  # KB; escaping by the test takes part of it
    for bad in ("### User: x", "### User: x</turn>", "User: x</turn>\n", "### [a: x</turn>\n", "### User: x\\</turn>\n"):
        with pytest.raises(ValueError):
            chat.parse(bad)


def test_chat_of_other_columns_and_one_long_text(spark):
    ship(spark)
    long = "\\ ### " * 300_000
    df = spark.createDataFrame([(1, 0, "user", long, "t", 5), (1, 1, "assistant", long, "t", 5)], "conv_id long, turn long, role string, text string, tree string, node int")
    m = chat.turns_as_chain(df)
    got = chat.read_back(chat.format_turns(m, chat.reply_paths(m))).first()
    assert (got.n_turns, got.loss_chars, got.loss_sha256) == (2, len(long), sha(long))


def test_reply_trees(spark):
    #      1 -> 2 -> 4, 1 -> 3 -> 5 -> 6; a tree of one; an orphan; a cycle
    nodes = [("a", 1, None, 1.0), ("a", 2, 1, 5.0), ("a", 4, 2, 5.0), ("a", 3, 1, 1.0), ("a", 5, 3, 1.0), ("a", 6, 5, 1.0), ("b", 9, None, 0.0), ("c", 8, 77, 1.0), ("d", 1, 2, 1.0), ("d", 2, 1, 1.0)]
    m = spark.createDataFrame([(*n, "user", str(n[1])) for n in nodes], "tree string, node long, parent long, score double, role string, text string")
    path = lambda k: rows(chat.reply_paths(m, k), "tree", "path", "depth", "node")
    best = [("a", 1, 0, 1), ("a", 1, 1, 2), ("a", 1, 2, 4), ("b", 1, 0, 9), ("c", 1, 0, 8)]
    assert path(1) == sorted(best, key=repr)
    assert path(2) == sorted([*best, ("a", 2, 0, 1), ("a", 2, 1, 3), ("a", 2, 2, 5), ("a", 2, 3, 6)], key=repr)


# 10


def test_urls(spark):
    ship(spark)
    cases = [
        ("http://A.Example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("https://x.org/en/12", "x.org", "/en/12", "org/", "allow"),
        ("https://x.org", "x.org", "", None, "allow"),
        ("ftp://m.site.com/de/", "m.site.com", "/de/", "com/de/", "block"),
        ("ftp://m.site.com/fr/?a=://b", "m.site.com", "/fr/", "com/fr/", "allow"),
        ("http://notcom/de/", "notcom", "/de/", None, "allow"),
        ("no scheme.org/es/", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://ÄB.net/x", "Äb.net", "/x", None, "allow"),
    ]
    pages = spark.createDataFrame([(k, c[0], "h") for k, c in enumerate(cases)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "id long, block int")
    got = {r.page_id: r for r in urls.judge(pages, none).collect()}
    for k, c in enumerate(cases):
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == c[1:], c
    assert urls.judge(pages.limit(0), none).count() == 0


def test_url_rules_equal_brute_force(spark):
    ship(spark)
    rng = np.random.default_rng(10)
    data = [(k, f"http://{rng.choice(['a', 'b', 'c'])}.{rng.choice(['x', 'y'])}.net/{rng.choice(['p', 'q', 'r'])}/{k}{rng.choice(['', '?u=1', '#f'])}") for k in range(400)]
    bad = lambda u: ".x.net/p" in u or "://b" in u and "#f" in u
    df = spark.createDataFrame(data, "page_id long, url string")
    labels = spark.createDataFrame([(k, int(bad(u))) for k, u in data if k % 3], "id long, block int")
    mined, classes = urls.mine_rules(df.select(F.col("page_id").alias("id"), "url"), labels, 0.02, 0.8, 1, 3.0)
    toks = {r.page_id: set(r.t) for r in df.select("page_id", urls.tokens("url").alias("t")).collect()}
    train = [(toks[k], bad(u)) for k, u in data if k % 3]
    base = sum(b for _, b in train) / len(train)
    from itertools import combinations

    want = set()  # every combination that is strong enough, longer ones included
    for c in {c for t, _ in train for n in range(1, len(t) + 1) for c in combinations(sorted(t), n)}:
        have = [b for s, b in train if set(c) <= s]
        lean = sum(have) - len(have) * base >= 3 * (len(have) * base * (1 - base)) ** 0.5
        if sum(have) / len(train) >= 0.02 and sum(have) / len(have) >= 0.8 and lean:
            want.add(frozenset(c))
    shortest = {c for c in want if not any(x < c for x in want)}
    of = {}
    for r in classes.collect():
        of.setdefault(r["class"], set()).add(r.token)
    from itertools import product

    assert {frozenset(c) for r in mined.collect() for c in product(*(of[x] for x in r.antecedent))} == shortest and shortest
    got = {r.page_id: r.verdict for r in urls.judge(df, labels, ()).collect()}
    loose = {r.url for r in urls.fired(df, mined, classes).collect()}
    assert loose == {u for k, u in data if any(r <= toks[k] for r in want)}
    assert set(got.values()) <= {"allow", "block"}


def test_url_rules_with_very_long_urls_and_repeats(spark):
    ship(spark)
    long = "http://long.net/" + "/".join(f"s{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200))
    rng = np.random.default_rng(15)
    part = lambda k: "http://part.net/" + "/".join(f"t{chr(97 + x % 26)}{chr(97 + x // 26)}" for x in range(60) if x != k)
    data = [*((k, long) for k in range(30)), *((100 + k, part(k)) for k in range(60)), *((200 + k, f"http://ok.net/{rng.choice(['a', 'b'])}") for k in range(200)), (5, long), (None, long), (6, None)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in data], "page_id long, url string, confidence string")
    labels = spark.createDataFrame([(k, int(k < 200), "y") for k in [*range(30), *range(100, 400)]] + [(None, 1, "y"), (3, None, "y")], "id long, block int, verdict string")
    out = urls.judge(pages, labels, ())
    assert out.count() == len(data)
    verdicts = {(r.page_id, r.host): r.verdict for r in out.collect()}
    assert all(v == ("block" if h in ("long.net", "part.net") else "allow") for (_, h), v in verdicts.items())
    assert urls.judge(pages, labels.limit(0), ()).where("verdict = 'block'").count() == 0


def test_url_rules_of_long_urls_equal_brute_force(spark):
    """URLs of more than MOST_ITEMS classes, against every set of segments (a number, a bit for each)."""
    ship(spark)
    rng = np.random.default_rng(23)
    n, size = 600, 14
    has = rng.random((n, size)) < np.linspace(0.5, 0.95, size)
    bad = np.where(has[:, 0] & has[:, 7] & has[:, 13], rng.random(n) < 0.9, rng.random(n) < np.where(has[:, 13] & has[:, 2], 0.2, 0.5))
    name = [f"s{chr(97 + k)}" for k in range(size)]
    data = [(i, "http://n/" + "/".join(x for x, h in zip(name, row, strict=True) if h)) for i, row in enumerate(has)]
    labels = spark.createDataFrame([(i, int(b)) for i, b in enumerate(bad)], "id long, block int")
    mined, classes = urls.mine_rules(spark.createDataFrame(data, "id long, url string"), labels, 0.002, 0.75, 20, 3.0)
    assert all(r["class"] == r.token for r in classes.collect()) and (has.sum(axis=1) > urls.MOST_ITEMS).sum() > 50
    held, base = (has << np.arange(size)).sum(axis=1), bad.mean()
    sets = np.arange(1, 1 << size)
    docs = np.array([((held & x) == x).sum() for x in sets.tolist()])
    hits = np.array([bad[(held & x) == x].sum() for x in sets.tolist()])
    want = sets[(hits >= 20) & (hits >= docs * 0.75) & (hits - docs * base >= 3 * np.sqrt(docs * (base * (1 - base))))].tolist()
    shortest = {x for x in want if not any(y != x and y & x == y for y in want)}
    got = {sum(1 << name.index(t[2:]) for t in r.antecedent): (r.confidence, r.support) for r in mined.collect()}
    assert set(got) == shortest and any(x.bit_count() > 2 for x in shortest)
    assert all(got[x] == (hits[x - 1] / docs[x - 1], hits[x - 1] / n) for x in shortest)


def test_grown_rules_spare_what_cannot_be_one():
    """Thirty classes that stand together in blocked URLs, and singly in allowed ones: the pairs, none of the 2**30 combinations."""
    found = list(urls._grown([[f"c{k:02}" for k in range(30)], *([f"c{k:02}"] for k in range(30))], np.array([0.0] + [9.0] * 30), np.array([25.0] + [0.0] * 30), np.array([1.0] + [0.0] * 30), 20, lambda docs, bad: bad >= 0.9 * docs))
    assert len(found) == 435 and all((len(x), docs, bad) == (2, 25, 25) for x, docs, bad in found)


# pipeline


def test_pipeline_holds_little_between_stages(spark):
    """Batches of whole texts are small, and a worker's tokenizer goes with its task."""
    cp = pytest.importorskip("corpus_pipeline")
    cp.begin(spark)
    assert 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    d = spark.createDataFrame([(1, "some text")], "doc_id long, text string").coalesce(1)
    assert packing.token_pieces(d, BYTES).count() == 1
    left = d.mapInArrow(lambda batches: (b.select(["doc_id"]).set_column(0, "n", pa.array([packing.text_ids.cache_info().currsize] * b.num_rows, pa.int64())) for b in batches), "n long").collect()
    assert [r.n for r in left] == [0]


def test_pipeline_stages(spark, tmp_path):
    cp = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(11)
    passage = " ".join(f"passage{k}" for k in range(70))
    data = []
    for k in range(200):
        own = " ".join(f"v{x}" for x in rng.integers(0, 5000, 60))
        data.append((k, own + (" you idiot" if k % 10 == 0 else " all good") + "\nA line that many hold"))
    data += [(300, data[1][1]), (301, data[2][1].replace("v", "V", 1)), (302, passage + " alpha beta"), (303, "gamma delta " + " ".join(f"z{k}" for k in range(200)) + " " + passage), (304, None), (305, ""), (306, data[3][1].replace(" v", " q", 1))]
    d = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, 1, int(k % 10 == 0)) for k in range(200)], "doc_id long, quality int, toxic int")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    sf, now = str(tmp_path), d
    for name, stage in cp.STAGES[:-1]:
        nxt = stage(spark, now, sf)
        assert nxt.columns == d.columns, name
        nxt.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
    left = {r.doc_id: r.text for r in now.collect()}
    assert not any(k % 10 == 0 and k < 200 for k in left)
    assert left[300] == left[301] == "" and 306 not in left  # copies lose their lines, a near copy goes whole
    assert sum("A line that many hold" in (t or "") for t in left.values()) == 1
    assert passage in left[302] and "passage0" not in left[303] and "z199" in left[303]
    packed = cp.run(spark, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(left)


def test_pipeline_on_empty_tables_and_clashing_columns(spark, tmp_path):
    cp = pytest.importorskip("corpus_pipeline")
    schema = "doc_id long, text string, lang string, source string, n_chars long, _id int, score double, tag string, component long, c0 string, keep string"
    rows_ = [(i, t, "en", "s", len(t or ""), 1, 0.5, "t", 7, "c", "k") for i, t in DOCS]
    labels = "doc_id long, quality int, toxic int"
    for k, (data, told) in enumerate(((rows_, []), ([], [(1, 1, 1), (2, 1, 0)]), ([], []))):
        sf = f"{tmp_path}/{k}"
        spark.createDataFrame(data, schema).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame(told, labels).write.parquet(f"{sf}/labels.parquet")
        now = spark.read.parquet(f"{sf}/documents.parquet")
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, now, sf)
            assert out.columns == now.columns and out.dtypes == now.dtypes, name
            out.write.parquet(f"{sf}/{name}")
            now = spark.read.parquet(f"{sf}/{name}")
        packed = cp.run(spark, sf)
        assert packed.select("doc_id").distinct().count() == now.select("doc_id").distinct().count()
        if data:
            left = {r.doc_id: r.text for r in now.collect()}
            assert left[2] == B and left[8] is None and {10, 11, 20, 21, None} <= set(left) and left[9] == ""  # its line is one that a smaller id holds


def test_pipeline_equals_brute_force(spark, tmp_path):
    """The stages between the classifier and packing, on texts for which each can be worked out by hand."""
    cp = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(21)
    passage = " ".join(f"p{k}" for k in range(60))
    data = [*near_copies(40, 22), *((k, f"line {k % 7} is held by some\n" + " ".join(f"w{x}" for x in rng.integers(0, 10**6, 50)) + ("\n" + passage if k % 5 == 0 else "")) for k in range(60))]
    d = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    sf = str(tmp_path)
    now = {i: t for i, t in data}
    holders = {}
    for i, t in now.items():
        for x in t.split("\n"):
            holders.setdefault(x, []).append(i)
    now = {i: "\n".join(x for x in t.split("\n") if len(x) < 10 or i == min(holders[x])) for i, t in now.items()}
    comp, _ = brute_components(list(now.items()), 5, 80, 100)
    now = {i: t for i, t in now.items() if comp[i] == i}
    first = {}
    for i, t in now.items():
        w = WORDS.findall(t)
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            first[key] = min(first.get(key, i), i)
    want = {}
    for i, t in now.items():
        w = WORDS.findall(t)
        gone = {x for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for x in range(k, k + 50)}
        want[i] = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t
    got = d
    for name, stage in cp.STAGES[1:4]:
        stage(spark, got, sf).write.parquet(f"{sf}/{name}")
        got = spark.read.parquet(f"{sf}/{name}")
    assert {r.doc_id: r.text for r in got.collect()} == want
