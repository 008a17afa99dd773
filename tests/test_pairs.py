import pytest
from pyspark.sql import functions as F

from alertloom.functions import vocab as v
from alertloom.operators import audit, capability, mutate

GOLDEN = [
    ("DISP_TOKEN_ORDER_SWAP", "Wei Zhang", "Zhang Wei", "Wei Zhang"),
    ("DISP_TOKEN_ORDER_SWAP", "Li Wei Chen", "Chen Li Wei", "Li Wei Chen"),
    ("DISP_MIDDLE_NAME_ABBREVIATED", "Ivan Petrovich Sidorov", "Ivan P. Sidorov", "Ivan Sidorov"),
    ("DISP_MIDDLE_NAME_OMITTED", "Ana Maria Lopez Diaz", "Ana Lopez Diaz", "Ana Diaz"),
    ("DISP_DIACRITIC_STRIPPED", "Jose Perez", "José Perez", "Perez"),
    ("DISP_DIACRITIC_STRIPPED", "František Ševčík", "Frantisek Ševčík", "Ševčík"),
    ("DISP_COMPOUND_NAME_RESTRUCTURED", "Jean-Paul Belmondo", "Jean Paul Belmondo", "Belmondo"),
    ("DISP_COMPOUND_NAME_RESTRUCTURED", "Omar Al-Fassi", "Omar Al Fassi", "Omar"),
    ("DISP_COMPOUND_NAME_RESTRUCTURED", "Jean Paul Belmondo", "Jean-Paul Belmondo", "Belmondo"),
    ("DISP_GIVEN_NAME_GENDER_VARIANT", "Daniel Martin", "Daniela Martin", "Martin"),
    ("DISP_GIVEN_NAME_GENDER_VARIANT", "Jose Garcia", "Josefa Garcia", "Garcia"),
    ("DISP_GIVEN_NAME_GENDER_VARIANT", "Carlos Ruiz", "Carla Ruiz", "Ruiz"),
    ("DISP_GIVEN_NAME_GENDER_VARIANT", "Carla Ruiz", "Carl Ruiz", "Ruiz"),
    ("DISP_EXACT_NAME_MATCH", "Kofi Osei", "Kofi Osei", "Kofi Osei"),
    ("DISP_PHONETIC_SURNAME_DIVERGENCE", "Erik Jackson", "Erik Jacksen", "Erik"),
    ("DISP_PHONETIC_SURNAME_DIVERGENCE", "Ian Murray", "Ian Murraey", "Ian"),
    ("DISP_PHONETIC_SURNAME_DIVERGENCE", "Jan Hoff", "Jan Hoph", "Jan"),
]


def test_golden_hits(spark):
    for code in {g[0] for g in GOLDEN}:
        want = {(c, h, m) for k, c, h, m in GOLDEN if k == code}
        names = spark.createDataFrame(sorted({(c,) for c, _, _ in want}), "client_name string")
        got = {(r.client_name, r.hit_name, r.matching_text) for r in mutate.candidates(names, code).collect()}
        assert got == want, code


def test_sets_and_refusals(spark):
    one = lambda name, code: {r.hit_name for r in mutate.candidates(spark.createDataFrame([(name,)], "client_name string"), code).collect()}
    assert one("Marco Rossi", "DISP_PHONETIC_SURNAME_DIVERGENCE") == {"Marco Rosi", "Marco Russo", "Marco De Rossi"}
    assert one("Tariq Khan", "DISP_TRANSLITERATION_VARIANT") == {"Tarik Khan", "Tareck Khan", "Tarek Khan"}
    assert one("Carla Carl", "DISP_GIVEN_NAME_GENDER_VARIANT") == set()
    assert "Alin Li" in one("Ali Li", "DISP_MINOR_TYPO")
    with pytest.raises(ValueError):
        mutate.candidates(None, "X")
    with pytest.raises(ValueError):
        capability.capable(F.lit("A B"), "X")


def test_trace(spark):
    r = mutate.candidates(spark.createDataFrame([("Daniel Martin",)], "client_name string"), "DISP_GIVEN_NAME_GENDER_VARIANT").first()
    assert r.thinking.startswith("Client 'Daniel Martin' vs hit 'Daniela Martin'. Given: client carries the masculine form 'Daniel', hit carries its feminine counterpart 'Daniela'. Middle: absent from both records. Surname: 'Martin' matches exactly. ")
    assert r.thinking.endswith("Therefore: DISP_GIVEN_NAME_GENDER_VARIANT -> disqualify.")


AUDITS = [
    ("DISP_MINOR_TYPO", "Anna Li", "Ana Li", None),
    ("DISP_MINOR_TYPO", "Martin Li", "Martina Li", "cross-gender"),
    ("DISP_MINOR_TYPO", "Anna Li", "Bobby Li", "distance"),
    ("DISP_TOKEN_ORDER_SWAP", "Ali Ali", "Ali Ali", "no reordering"),
    ("DISP_MIDDLE_NAME_ABBREVIATED", "A Bcd E", "A B. E", None),
    ("DISP_MIDDLE_NAME_ABBREVIATED", "A d'Angelo E", "A d. E", "not shortened"),
    ("DISP_MIDDLE_NAME_OMITTED", "A E", "A X. E", None),
    ("DISP_TRANSLITERATION_VARIANT", "Umar Li", "Omar Li", None),
    ("DISP_DIACRITIC_STRIPPED", "Jørgen Li", "Jrgen Li", None),
    ("DISP_COMPOUND_NAME_RESTRUCTURED", "Ha-eun Choi", "Ha Eun Choi", None),
    ("DISP_SURNAME_CONFLICT", "Ana Li", "Ana Osei", None),
    ("DISP_SURNAME_CONFLICT", "Ana Li", "Ana Zzz", "not from the curated"),
    ("DISP_MIDDLE_NAME_CONFLICT", "A Bob E", "A Zzz E", None),
    ("DISP_PHONETIC_SURNAME_DIVERGENCE", "Marco Rossi", "Marco De Rossi", None),
    ("DISP_PHONETIC_SURNAME_DIVERGENCE", "Ana Novak", "Ana Novaks", "single character"),
    ("DISP_EXACT_NAME_MATCH", "Ana Li", "Ana Lo", "not an identical"),
    ("DISP_GIVEN_NAME_GENDER_VARIANT", "Ana Li", "Ana Lo", "gendered"),
    ("X", "Ana Li", "Ana Li", "unknown disposition code"),
]


def test_audit(spark):
    df = spark.createDataFrame([(c, h, k, w) for k, c, h, w in AUDITS], "client_name string, hit_name string, disposition_code string, want string")
    for r in audit.audit_pairs(df).collect():
        assert (r.problem is None) == (r.want is None) and (r.want is None or r.want in r.problem), r


def test_capability_agrees_with_generators(spark):
    names = spark.createDataFrame([(n,) for xs in v.WORLD_NAMES.values() for n in xs], "client_name string")
    matrix = {(r.code, r.client_name) for r in capability.capability_matrix(names).collect()}
    for code in ("DISP_TRANSLITERATION_VARIANT", "DISP_COMPOUND_NAME_RESTRUCTURED", "DISP_DIACRITIC_STRIPPED", "DISP_GIVEN_NAME_GENDER_VARIANT"):
        assert {(code, r.client_name) for r in mutate.candidates(names, code).select("client_name").distinct().collect()} == {m for m in matrix if m[0] == code}
