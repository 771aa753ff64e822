"""Column functions against tables of cases and plain Python models."""

import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paragrid.functions import dates, hashing, keys, text, yaml


def values(spark, column, cases):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string").select("i", column(F.col("x")).alias("v")).collect()
    return [r["v"] for r in sorted(rows, key=lambda r: r["i"])]


def model(x):
    kept = "".join(c for c in unicodedata.normalize("NFC", x) if c not in "​‌‍﻿").replace(" ", " ")
    kept = "".join(c for c in kept if c in "\n\t" or unicodedata.category(c) != "Cc")
    return re.sub(r"\s+", " ", kept).strip()


def test_canonical_text_cases(spark):
    cases = ["über", "a \t b", "wo​rt\u0007e", None, "", " \n ", "x\ry", "a b"]
    got = values(spark, text.canonical_text, cases)
    assert got == ["über", "a b", "worte", "", "", "", "xy", "a b"]
    assert values(spark, text.canonical_text, got) == got


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from("aÄü  ​﻿\t\n\r\x0b\x85 ́é\x07"), max_size=12), min_size=1, max_size=30))
def test_canonical_text_is_the_model(spark, cases):
    assert values(spark, text.canonical_text, cases) == [model(c) for c in cases]


def test_slug_and_classes(spark):
    assert values(spark, text.slugify_ascii, ["Ärzte-GebO §5", "  ", None, "a.b_c"]) == ["arzte-gebo-5", "", "", "a.b_c"]
    assert values(spark, text.class_tokens, ["Ti-Art  oj-normal ti-art", None]) == [["ti-art", "oj-normal"], []]


def test_designators(spark):
    cases = ["§ 1", "§ 14a", "Artikel 5", "Art 5", "Anlage 2", "Anlage", "", "Erster Teil", "§ 14ab", "Anlage II", "Anlage V", "§ 14 a", "§§ 3 bis 5", "§ 12345", None]
    got = values(spark, keys.classify_designator, cases)
    assert [None if g is None else tuple(g) for g in got] == [
        ("paragraph", "0001"), ("paragraph", "0014a"), ("article", "art-0005"), ("article", "art-0005"), ("annex", "0002"), ("annex", "0000"), None, None,
        None, ("annex", "0000"), ("annex", "0000v"), ("paragraph", "0014"), ("paragraph", "0003"), ("paragraph", "12345"), None,
    ]


def test_file_keys(spark):
    assert values(spark, keys.pad_ordinal, ["1.10", "2", "1..2.", "100.3", "a.1"]) == ["01.10", "02", "01.02", "100.03", "a.01"]
    assert values(spark, keys.pad_article, ["5", "12A", "", None, "5-7 bis", "12345"]) == ["0005", "0012a", "0000", "0000", "5-7-bis", "12345"]
    assert values(spark, keys.article_file, ["0", "", "Praeambel", "ANHANG", "3b"]) == ["0000-praeambel.md", "0000-praeambel.md", "0000-praeambel.md", "9000-anhang.md", "0003b.md"]
    assert values(spark, keys.celex_type, ["32016R0679", "32000L0001", "32000D0001", "32000X0001", "3200"]) == ["eu-verordnung", "eu-richtlinie", "eu-beschluss", "sonstige", "sonstige"]
    labels = ["laws/B/paragraphs/0007g.md", "laws/B/paragraphs/art-0005.md", "laws/B/annexes/0002.md", "laws/B/annexes/0000.md", "laws/B/paragraphs/0010__1.md", "laws/B/meta.json", "x.md"]
    assert values(spark, keys.unit_label, labels) == ["§ 7g", "Artikel 5", "Anlage 2", "Anlage", "§ 10", "laws/B/meta.json", "x.md"]
    assert values(spark, keys.slug_from_link, ["https://host.example/bgb/xml.zip"]) == ["bgb"]
    assert values(spark, keys.article_number, ["Artikel 12", "Art. 7a Zweck", "ohne"]) == ["12", "7a", ""]


def test_ecli(spark):
    assert values(spark, keys.ecli_path, ["ecli:de:bgh:2024:1/5:0", "ECLI:DE:BGH:2024", "x"]) == ["decisions/DE/BGH/2024/1_5-0", None, None]
    made = values(spark, lambda c: keys.build_ecli(c, F.lit("2024-02-01"), F.lit("VI ZR 1/24")), ["BGH", "", None])
    assert made == ["ECLI:DE:BGH:2024:240201VIZR124", "", ""]


def test_dates(spark):
    assert values(spark, dates.german_date, ["31.02.2024", "1.2.49", "1.2.50", "1.2.123", "x", None]) == ["2024-02-31", "2049-02-01", "1950-02-01", "0123-02-01", None, None]
    assert values(spark, dates.decision_date, ["2024-01-02", " 3.4.2020 ", "April"]) == ["2024-01-02", "2020-04-03", "April"]
    assert values(spark, lambda c: dates.long_german_date(F.lit("5"), c, F.lit("2001")), ["März", "maerz", "7", "Foo"]) == ["2001-03-05", "2001-03-05", "2001-07-05", None]
    assert values(spark, lambda c: dates.effective_date(c, "2024-06-30"), ["2020-01-01", "", None]) == ["2020-01-01", "2024-06-30", "2024-06-30"]
    assert spark.range(1).select(dates.first_stand_date(F.array(F.lit("neu"), F.lit("Stand: 1.2.2003 und 5.5.2005"), F.lit("3.3.2010")))).first()[0] == "2003-02-01"


@pytest.mark.parametrize("scalar", [yaml.law_scalar, yaml.portal_scalar])
def test_yaml_round_trip(spark, scalar):
    cases = ["", "plain", "§ 1", ' lead: "q" \\x', "a-b", "[x]", "#", "tab\tx"]
    got = values(spark, scalar, cases)
    assert values(spark, yaml.unquote, got) == cases
    assert got[0] == '""' and got[1] == "plain"
    assert values(spark, yaml.law_scalar, ["a-b", "§ 1"]) == ['"a-b"', '"§ 1"'] and values(spark, yaml.portal_scalar, ["a-b", "§ 1"]) == ["a-b", "§ 1"]


def test_hashes(spark):
    import hashlib

    kind = "array<struct<number:string,heading:string,paragraphs:array<string>>>"
    row = spark.createDataFrame([([("1", None, ["a", "b"]), ("2", "H", [])],)], f"a {kind}").select(hashing.article_hash(F.col("a"))).first()[0]
    assert row == hashlib.sha256(b"1\0\0a\1b\1\2" + b"2\0H\0\2").hexdigest()
    out = spark.createDataFrame([(b'<?xml version="1.0" encoding="latin-1"?><a c="1" b="2"><!-- x -->\xe4</a>',), (b"<a",), (None,)], "x binary").select(hashing.canonical_xml(F.col("x")).alias("r")).select("r.*").collect()
    assert bytes(out[0]["xml"]) == '<?xml version="1.0" encoding="UTF-8"?>\n<a b="2" c="1">ä</a>\n'.encode() and out[1]["error"] and out[2]["xml"] is None
    assert hashing.canonical_xml_bytes(bytes(out[0]["xml"])) == bytes(out[0]["xml"])


def test_sql_functions_equal_the_columns(spark):
    """The functions for ``spark.sql`` give what the column functions give."""
    from paragrid.functions import text

    keys.register(spark)
    texts = [
        "§ 1", "§ 14a", "Artikel 5", "Art 5", "Anlage 2", "Anlage", "", "Erster Teil", "§ 14ab", "Anlage II", "Anlage V", "§ 14 a", "§§ 3 bis 5", None, "  § 7\t", "1.10", "2", "1..3.x", "5b", "anhang", "0",
        "Präambel", "32016R0679", "32016", "ECLI:DE:BAG:2020:01.U/1:2", "x:y", "laws/A/paragraphs/0001a__2.md", "laws/A/paragraphs/art-0005.md", "laws/A/annexes/0000.md", "laws/A/annexes/0012b.md", "a.md", "https://h/bgb/xml.zip", "a\u0308\u200b\u00a0\u0007 b",
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    pairs = {n: getattr(keys, n) for n in ("classify_designator", "pad_ordinal", "pad_article", "article_file", "celex_type", "ecli_path", "unit_label", "slug_from_link")}
    pairs |= {"canonical_text": text.canonical_text, "slugify_ascii": text.slugify_ascii}
    for name, column in pairs.items():
        row = frame.select("t", column(F.col("t")).alias("a"), F.expr(f"{name}(t)").alias("b")).where("not (a <=> b)")
        assert row.collect() == [], name
    made = frame.select(keys.build_ecli(F.col("t"), F.lit("2020-01-02"), F.lit("I ZR 1/2")).alias("a"), F.expr("build_ecli(t, '2020-01-02', 'I ZR 1/2')").alias("b"))
    assert made.where("not (a <=> b)").count() == 0
