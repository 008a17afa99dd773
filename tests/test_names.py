import pytest
from pyspark.sql import functions as F

from alertloom.functions import strings as s
from alertloom.sources import names as src

GOLDEN = {
    "AL-ZOMOR, Dr. Ahmed": "Ahmed Al-Zomor",
    "ACME TRADING LLC": None,
    "Bank, John": None,
    "Cher": None,
    "": None,
    "JOHN O'NEIL": "John O'neil",
    "S.A. Gomez": "S.a. Gomez",
    "V. Tóth Mónika": "Tóth Mónika",
    "smith, john m.": "John Smith",
    "smith, john a.": "John A. Smith",
    "ludwig VAN beethoven": "Ludwig Van Beethoven",
    "McDonald-Smith Anna": "Mcdonald-Smith Anna",
    "McDonald Anna": "McDonald Anna",
    "DOE, John, Jr.": "John, Doe",
    "Jack Ma": None,
    '"Ana  Li"': "Ana Li",
    "Min-jun Kim": "Min-Jun Kim",
    None: None,
}


def test_cleaning(spark):
    df = spark.createDataFrame([(x,) for x in GOLDEN], "raw string")
    assert {r.raw: r.name for r in df.select("raw", src.clean(F.col("raw")).alias("name")).collect()} == GOLDEN


def test_well_formed(spark):
    rows = spark.createDataFrame([("Ana A. Sus", True), ("Ana Th.S. Sus", False), ("Ana 2 Sus", False)], "n string, ok boolean")
    assert rows.where(src.well_formed(F.col("n")) != F.col("ok")).count() == 0


def test_fold(spark):
    rows = spark.createDataFrame([("José", "Jose"), ("Jørgen", "Jrgen"), ("Łukasz", "ukasz"), ("ß", ""), ("Ağaoğlu", "Agaoglu"), ("ﬁn", "fin")], "a string, b string")
    assert rows.where(s.strip_marks(F.col("a")) != F.col("b")).count() == 0


def test_fold_equals_the_decomposition_of_every_letter(spark):
    import unicodedata

    letters = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + "".join(letters[k : k + 50]) + "z" for k in range(0, len(letters), 50)]
    rows = spark.createDataFrame([(t, unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode()) for t in texts], "a string, b string")
    assert rows.where(s.strip_marks(F.col("a")) != F.col("b")).limit(3).collect() == []


def test_overlap_and_notes(spark):
    df = spark.createDataFrame([("Ali Khan", "Ali Smith"), ("Ana Li", "Bo Xu")], "c string, h string")
    got = [r.o for r in df.select(s.overlap(F.col("c"), F.col("h")).alias("o")).collect()]
    assert got == ["Ali", "Bo Xu"]
    r = df.select(s.quoted(F.lit("O'Neil")).alias("a"), s.quoted(F.lit("Ana")).alias("b"), s.walk_note(F.lit(None).cast("string"), F.lit("X")).alias("c")).first()
    assert (r.a, r.b, r.c) == ('"O\'Neil"', "'Ana'", "absent from the client record, recorded as 'X' in the hit")


def test_column_choice():
    assert src.name_column(["id", " Client_Name ", "name"]) == " Client_Name "
    assert src.name_column(["id", "x"], "x") == "x"
    assert src.name_column(["id", "x"]) == "id"


def test_csv_source_and_first_wins(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text('id,name\n1,"AL-ZOMOR, Dr. Ahmed"\n2,NA\n3,ahmed al-zomor\n4,\n5,ACME LLC\n', encoding="utf-8")
    got = src.load_names(spark, str(path), augment=False, generate=False).collect()
    assert [(r.name, r.src) for r in got] == [("Ahmed Al-Zomor", "csv")]
    assert src.load_names(spark, str(tmp_path / "none.csv"), augment=False, generate=False).count() == 122
    assert src.generated_names(spark, 0).count() == 0
    with pytest.warns(UserWarning):
        some = src.generated_names(spark, 30, ["cs_CZ", "xx_XX", "es_ES"]).collect()
    assert {r.ord // 30 for r in some} == {0, 2}
    assert {r.name.split()[-1] for r in some if r.ord < 30} <= set(src.locale_names("pl_PL")[1])


def test_made_up_names_draw_from_every_token(spark):
    from hashlib import md5

    from alertloom.functions.strings import SEED
    from alertloom.operators import capability

    code = lambda k: "".join(chr(97 + k // 26**i % 26) for i in range(3))
    givens = [f"G{code(k)}" for k in range(6000)]
    names = spark.createDataFrame([(f"{g} S{code(k)}",) for k, g in enumerate(givens)], "client_name string")
    least = sorted(givens, key=lambda g: md5(f"{g}{SEED}".encode()).hexdigest())
    ranks, n = capability.numbered(names.selectExpr("split(client_name, ' ')[0] AS x"))
    assert n == 6000 and [r.x for r in ranks.orderBy("ix").collect()] == least and ranks.where("ix = 5999").count() == 1
    made = {r.client_name.split()[0] for r in capability.synthesised(spark, names, "DISP_PHONETIC_SURNAME_DIVERGENCE", 300).collect()}
    assert made & set(least[4096:]) and made <= set(givens)
