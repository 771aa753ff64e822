"""Readers and parsers on own fixtures."""

import io
import zipfile

from pyspark.sql import functions as F

from paragrid.sources import decisions, laws, markup, portals, readers


def norm(meta, body=""):
    return f"<norm><metadaten>{meta}</metadaten><textdaten>{body}</textdaten></norm>"


def text_of(*blocks):
    return '<text format="XML"><Content>' + "".join(f"<P>{b}</P>" for b in blocks) + "</Content></text>"


BASIC = "<dokumente>" + norm(
    "<jurabk>PrG</jurabk><amtabk>PrG</amtabk><langue>Gesetz zur Probe</langue><ausfertigung-datum>2001-02-03</ausfertigung-datum>"
    "<standangabe><standtyp>Stand</standtyp><standkommentar>Geändert durch Art. 1 G v. 5.6.2019</standkommentar></standangabe>"
    "<standangabe><standtyp>Hinweis</standtyp><standkommentar>ab 1.1.2030</standkommentar></standangabe>"
) + norm("<enbez>§ 1</enbez><titel>Zweck</titel>", text_of("(1) Das ist eins.", "(2) Das ist zwei.")) + norm("<enbez>Anlage 3</enbez>", text_of("Ohne Nummer")) + "</dokumente>"

MARKED = "<dokumente>" + norm("<jurabk>X</jurabk>") + norm(
    "<enbez>§ 7g</enbez>",
    text_of(
        '(1) <SUP class="Rec">1</SUP>Satz eins. <SUP class="Rec">2</SUP>Wenn<DL><DT>1.</DT><DD>der Fall<DL><DT>a)</DT><DD>tief</DD></DL></DD><DT>2.</DT><DD>sonst</DD></DL>gilt.',
        '<SUP class="Rec">1</SUP>Weiter.',
        "(2) (weggefallen)",
        '(3) <SUP class="Rec">x</SUP>Einer mit <I>kursiv</I> und <B>fett</B>.',
        "Tabelle: <table><tbody><row><entry>a</entry><entry>1</entry></row><row><entry/><entry/></row><row><entry>b</entry><entry>2</entry></row></tbody></table>",
    ),
) + "</dokumente>"


def unit(number, name):
    return f"<gliederungseinheit><gliederungskennzahl>{number}</gliederungskennzahl><gliederungsbez>{name}</gliederungsbez></gliederungseinheit>"


CRUMBS = "<dokumente>" + norm("<jurabk>C</jurabk>") + "".join(
    norm(unit(k, b)) + norm(f"<enbez>§ {i}</enbez>", text_of("x")) for i, (k, b) in enumerate((("010", "A"), ("020", "B"), ("020010", "BA"), ("030", "C")), 1)
) + "</dokumente>"


def parsed(spark, *documents, mode="compat"):
    raw = spark.createDataFrame([(f"B{i}", d if isinstance(d, bytes) else d.encode()) for i, d in enumerate(documents)], "bjnr string, xml binary")
    return {r["bjnr"]: r for r in laws.parse_laws(raw, mode).collect()}


def test_law_head_and_absaetze(spark):
    law = parsed(spark, BASIC)["B0"]
    assert (law["jurabk"], law["title"], law["stand_datum"], law["ausfertigung_datum"]) == ("PrG", "Gesetz zur Probe", "2019-06-05", "2001-02-03")
    one, annex = law["sections"]
    assert (one["kind"], one["padded"], one["heading"]) == ("paragraph", "0001", "Zweck")
    assert [(a["absatz"], a["intro"], [(s["nummer"], s["text"]) for s in a["saetze"]]) for a in one["absaetze"]] == [("1", "", [(1, "Das ist eins.")]), ("2", "", [(1, "Das ist zwei.")])]
    assert annex["kind"] == "annex" and annex["absaetze"][0]["absatz"] == "1"


def test_law_sentences(spark):
    a = parsed(spark, MARKED)["B0"]["sections"][0]["absaetze"]
    assert [x["absatz"] for x in a] == ["1", "2", "3"]
    assert [(s["nummer"], s["text"]) for s in a[0]["saetze"]] == [(1, "Satz eins."), (2, "Wenn 1. der Fall a) tief 2. sonst gilt."), (3, "Weiter.")]
    assert a[1]["saetze"][0]["text"] == "(weggefallen)"
    assert [(s["nummer"], s["text"]) for s in a[2]["saetze"]] == [(1, "Einer mit *kursiv* und **fett**."), (2, "Tabelle: [a | 1; b | 2]")]


def test_law_crumbs_both_ways(spark):
    crumbs = lambda mode: [list(s["breadcrumb"]) for s in parsed(spark, CRUMBS, mode=mode)["B0"]["sections"]]
    assert crumbs("compat") == [["A"], ["A", "B"], ["A", "B", "BA"], ["A", "C"]]
    assert crumbs("fixed") == [["A"], ["B"], ["B", "BA"], ["C"]]


def test_law_errors_and_files(spark):
    got = parsed(spark, "<dokumente/>", "<a", MARKED.replace("§ 7g", "§ 7"))
    assert got["B0"]["error"] == "no norm" and got["B1"]["error"] and got["B2"]["error"] is None
    raw = spark.createDataFrame([("B", MARKED.replace("</dokumente>", norm("<enbez>§ 7g</enbez>") + "</dokumente>").encode())], "bjnr string, xml binary")
    rows = laws.section_table(laws.parse_laws(raw)).orderBy("seq").collect()
    assert [r["path"] for r in rows] == ["laws/B/paragraphs/0007g.md", "laws/B/paragraphs/0007g__1.md"]


DECISION = """<?xml version="1.0" encoding="utf-8"?><dokument><ecli>ECLI:DE:BGH:2024:1</ecli><gericht>BGH</gericht><entscheidungsdatum>2024-02-01</entscheidungsdatum>
<aktenzeichen>VI ZR 1/24</aktenzeichen><doktyp>Urteil</doktyp><leitsatz><p>Erster.</p><p>Zweiter.</p></leitsatz><tenor><p>Tenor.</p></tenor><gruende><p>A<br/>B</p><p>C</p></gruende>
<norm>§ 1 X</norm><norm>§ 2 X</norm><norm>§ 1 X</norm></dokument>"""
OLD = '<?xml version="1.0" encoding="iso-8859-1"?><dokument><gericht>BVerwG</gericht><entscheidungsdatum>03.04.1999</entscheidungsdatum><aktenzeichen>1 C 2.98</aktenzeichen><entscheidungsart>Beschluß</entscheidungsart><leitsatz>eins\n\nzwei</leitsatz><tatbestand><p>T</p></tatbestand><entscheidungsgruende><p>G</p></entscheidungsgruende></dokument>'


def test_decisions(spark):
    raw = spark.createDataFrame([("n", DECISION.encode()), ("o", OLD.encode("latin-1")), ("bad", b"<x")], "key string, xml binary")
    d = {r["key"]: r for r in decisions.parse_decisions(raw).collect()}
    assert list(d["n"]["leitsaetze"]) == ["Erster.", "Zweiter."] and list(d["n"]["normrefs"]) == ["§ 1 X", "§ 2 X"] and list(d["n"]["gruende"]) == ["A\nB", "C"] or list(d["n"]["gruende"]) == ["AB", "C"]
    assert d["o"]["date"] == "1999-04-03" and d["o"]["ecli"] == "ECLI:DE:BVERWG:1999:9904031C298" and list(d["o"]["gruende"]) == ["T", "G"] and d["o"]["decision_type"] == "Beschluß"
    assert list(d["o"]["leitsaetze"]) == ["eins", "zwei"] and d["bad"]["error"]


REGULATION = """<html><head><title>t</title></head><body><h1 class="jnoverview">Titel der Vorschrift</h1><p class="jnsmall">VwV Probe</p><p class="jnsmall">Vom 5. März 2001 mit einem langen Zusatz dahinter</p>
<p class="jnenbez">1. Allgemeines</p><p class="jnenbez">2. Zweites</p><p class="jnenbez">2.1 Unter</p><div class="jnhtml"><p>Eins</p><p>Zwei</p></div><p class="jnenbez">ohne Zahl</p><p class="jnenbez">2.10 Zehn</p><div class="jnhtml">Nur Text</div></body></html>"""


def test_regulation_pages(spark):
    d = portals.regulation_pages(spark.createDataFrame([("d", "u", REGULATION)], "doc string, url string, html string")).first()
    assert (d["title"], d["short"], d["promulgation_date"]) == ("Titel der Vorschrift", "VwV Probe", "2001-03-05")
    assert [(s["ordinal"], s["heading"], s["text"]) for s in d["sections"]] == [("1", "Allgemeines", ""), ("2", "Zweites", ""), ("2.1", "Unter", "Eins\n\nZwei"), ("2.10", "Zehn", "Nur Text")]
    assert list(d["warnings"]) == ["unparsed ordinal: ohne Zahl"]


LISTING = """<body><h2>Bund</h2><h3>Amt</h3><ul><li><a href="./a/x.html">VwV-X Über X</a><li><a href="b.html">Kurz</a></ul><p class="jncategory">Gruppe</p><a href="/inhalt/y">Y  Z</a><!-- <a href="no.html">n</a> -->
<h2>Land</h2><a href="https://other.example/z">weg</a><a href="https://h.example/w.html">W W</a></body>"""


def test_regulation_listing(spark):
    rows = portals.regulation_listing(spark.createDataFrame([("d", LISTING)], "doc string, html string"), "https://host.example/").orderBy("pos").collect()
    assert [(r["short"], r["title"], r["url"], list(r["breadcrumb"])) for r in rows] == [
        ("VwV-X", "Über X", "https://host.example/a/x.html", ["Bund", "Amt"]),
        ("Kurz", "Kurz", "b.html", ["Bund", "Amt"]),
        ("Y", "Z", "https://host.example/inhalt/y", ["Bund", "Amt", "Gruppe"]),
        ("W", "W", "https://h.example/w.html", ["Land"]),
    ]


EU = """<html><head><title>Verordnung X - EUR-Lex</title><link rel="canonical" href="https://h.example/eli/reg/2016/679"></head><body><p class="oj-hd-coll">L 119</p><p class="oj-hd-info">4.5.2016, S. 1</p>
<p class="oj-normal">In Erwägung</p><p class="ti-art">Artikel 1</p><p class="sti-art">Gegenstand</p><p class="oj-normal">Eins&nbsp;a</p><p class="ti-art">Artikel 2</p><p class="oj-normal">b</p><p class="oj-normal">c</p><p class="oj-ti-art">Artikel 99</p></body></html>"""


def test_eu_pages(spark):
    frame = spark.createDataFrame([("32016R0679", "de", EU), ("32000L0001", "de", "<body><p>Siehe ABl. L 200/12 dort</p></body>"), ("x", "de", "<p>nichts</p>")], "celex string, language string, html string")
    d = {r["celex"]: r for r in portals.eu_pages(frame).collect()}
    one = d["32016R0679"]
    assert (one["title"], one["eli"], one["doc_type"], one["oj_reference"]) == ("Verordnung X", "https://h.example/eli/reg/2016/679", "eu-verordnung", "L 119/1")
    assert [(a["number"], a["heading"], list(a["paragraphs"])) for a in one["articles"]] == [("0", "Praeambel", ["In Erwägung"]), ("1", "Gegenstand", ["Eins a"]), ("2", "", ["b", "c"]), ("99", "", [])]
    assert d["32000L0001"]["oj_reference"] == "L 200/12" and d["x"]["oj_reference"] == ""
    assert portals.probe(frame.where("celex = '32016R0679'")).first()["eli"].endswith("679")


def test_readers(spark, tmp_path):
    (tmp_path / "toc.xml").write_text("<items><item><title>B</title><link>http://h.example/bgb/xml.zip</link></item><item><title> </title><link>x</link></item><item><title>C</title></item></items>")
    assert [tuple(r) for r in readers.law_listing(spark, str(tmp_path / "toc.xml")).collect()] == [("B", "https://h.example/bgb/xml.zip", "bgb")]
    item = "<item><gericht>{0}</gericht><entscheidungsdatum>1.2.2024</entscheidungsdatum><aktenzeichen>1</aktenzeichen><ecli>{1}</ecli><link>l</link></item>"
    (tmp_path / "dec.xml").write_text("<r xmlns='u:x'>" + item.format("BGH", "E1") + item.format("BAG", "") + item.format("BAG", "E3") + "</r>")
    assert [r["ecli"] for r in readers.decision_listing(spark, str(tmp_path / "dec.xml"), court="bag").collect()] == ["E3"]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("pic.gif", b"g")
        z.writestr("z.xml", b"<z/>")
        z.writestr("a.xml", b"<a/>")
    (tmp_path / "zips").mkdir()
    (tmp_path / "zips" / "one.zip").write_bytes(data.getvalue())
    (tmp_path / "zips" / "two.zip").write_bytes(b"no")
    by_name = {r["path"][-7:]: r for r in readers.archives(spark, str(tmp_path / "zips"), ordered=True).collect()}
    assert by_name["one.zip"]["stem"] == "a" and sorted(by_name["one.zip"]["extra_files"]) == ["pic.gif", "z.xml"] and by_name["two.zip"]["error"]
    assert readers.archives(spark, str(tmp_path / "zips"), ordered=False).where("error is null").first()["xml_filename"] == "z.xml"
    (tmp_path / "l.json").write_text('{"results":{"bindings":[{"celex":{"value":"32016R0679"},"title":{"value":" T "},"date":{"value":"2016-04-27T00:00"}},{"title":{"value":"x"}}]}}')
    rows = readers.read_listing(spark, str(tmp_path / "l.json"))
    assert [(r["celex"], r["title"], r["date"]) for r in rows.collect()] == [("32016R0679", "T", "2016-04-27")]
    assert readers.delta_query(rows, "2016-01-01", "^3", 0).count() == 0 and readers.delta_query(rows, "2016-01-01", "^3", 9999).count() == 1 and readers.clamp_window(0) == 1
    assert readers.window_query(rows, "2016-04-27", "2016-04-28", "^3").count() == 1 and readers.window_query(rows, "2016-04-01", "2016-04-27", "^3").count() == 0
    event = spark.range(1).select(readers.promulgation(F.lit('{"eli":"e","stand_datum":"2020-01-01","amendingAct":{"title":"A"},"affectedLaws":["x"]}')).alias("p")).first()["p"]
    assert event["effective_date"] == "2020-01-01" and event["amending_act_title"] == "A" and list(event["affected_law_ids"]) == ["x"] and list(event["affected_sections"]) == []
    assert spark.range(1).select(readers.promulgation(F.lit("no json")).alias("p")).first()["p"]["eli"] == ""
    assert readers.json_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0


def test_markup_recovers():
    root = markup.html_tree("<body><p>a<p>b<table><tr><td>c<td>d</table></b>e")
    assert [n.text() for n in root.walk() if n.tag == "p"] == ["a", "b"] and [n.text() for n in root.walk() if n.tag == "td"][-1] == "d"
    assert markup.decode_bytes(b"\xff") == "ÿ" and markup.decode_bytes("﻿ä".encode()) == "ä" and markup.decode_bytes(b'<?xml encoding="nope"?>\xe4').endswith("ä")


def test_nested_texts_stand_once():
    deep = "".join(f"<span class='k{i}'>t{i} " for i in range(3000))
    tokens, texts, _ = portals.tokens_of(deep)
    assert len(tokens) == 3000 and len(texts) == 3000 and sum(map(len, texts)) < len(deep)
    assert [(t[3], t[4]) for t in tokens] == [(i, 3000) for i in range(3000)]
    page = "<body>a<div class=x>b<p>c<b>d</b>e<p>f</div>g<ul><li>h<li>i<table><tr><td>j</table></ul></i></div>"
    tokens, texts, _ = portals.tokens_of(page)
    elements = [n for n in markup.html_tree(page).walk() if n.tag in portals.KEPT or n.get("class")]
    assert ["".join(texts[t[3] : t[4]]) for t in tokens] == [n.text() for n in elements] and len(elements) == 6


def test_markup_of_any_depth():
    deep = "<div class=jnhtml>" + "<i>" * 5000 + "x" + "</i>" * 5000 + "<br>y</div>z"
    node = next(n for n in markup.html_tree(deep).walk() if n.tag == "div")
    assert node.html() == '<div class="jnhtml">' + "<i>" * 5000 + "x" + "</i>" * 5000 + "<br>y</div>"
    # end tags and closing start tags without an open element don't search the whole stack
    root = markup.html_tree("<span>" * 20000 + "</b><h1>k</h1>" * 20000)
    assert sum(n.tag == "h1" for n in root.walk()) == 20000
    root = markup.html_tree("<p>a<b><p>b</b></p></p>c<ul><li>d<ul><li>e</ul><li>f</ul>")
    assert [n.text() for n in root.walk() if n.tag in ("p", "li")] == ["a", "b", "de", "e", "f"]


def test_regulation_pages_nested(spark):
    inner = '<p class="jnenbez">1. Kopf <b>fett</b></p><div class="jnhtml"><p>Eins</p><ul><li>a</li><li>b</li></ul></div>'
    page = "<h1>T <i>U</i></h1>" + '<div class="jnnorm">' * 400 + "Vom 5. März 2001 " + inner + "</div>" * 400
    frame = spark.createDataFrame([("d", "u", page), ("n", "u", None), ("e", "u", "")], "doc string, url string, html string")
    d = {r["doc"]: r for r in portals.regulation_pages(frame).collect()}
    assert (d["d"]["title"], d["d"]["promulgation_date"]) == ("T U", "2001-03-05")
    assert [(s["ordinal"], s["heading"], s["text"]) for s in d["d"]["sections"]] == [("1", "Kopf fett", "Eins\n\na\n\nb")]
    assert d["n"]["error"] == "no document" and not d["n"]["sections"] and d["e"]["title"] == "" and not d["e"]["sections"]
