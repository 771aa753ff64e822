"""Command line and registry."""

import io
import zipfile

import pytest

from paragrid.cli import main
from paragrid.operators.store import load
from paragrid.sources import registry
from test_sources import BASIC, MARKED


def archive(place, name, xml):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr(f"{name}.xml", xml)
    place.mkdir(exist_ok=True)
    (place / f"{name.lower()}.zip").write_bytes(data.getvalue())


def test_federal_runs(spark, tmp_path, capsys):
    source, store = tmp_path / "in", str(tmp_path / "store")
    sections = lambda: {r["path"]: r["md"] for r in spark.read.parquet(f"{store}/sections").collect()}
    events = lambda: sorted(p.parent.name for p in (tmp_path / "store" / "events").rglob("*.json"))
    archive(source, "BJNR1", BASIC)
    archive(source, "BJNR2", MARKED)
    assert main(["bund", "snapshot", str(source), store]) == 0
    first = sections()
    assert sorted(first) == ["laws/BJNR1/annexes/0003.md", "laws/BJNR1/paragraphs/0001.md", "laws/BJNR2/paragraphs/0007g.md"]
    assert first["laws/BJNR1/paragraphs/0001.md"].endswith("# § 1 Zweck\n\n(1) Das ist eins.\n\n(2) Das ist zwei.\n")
    assert main(["verify", store]) == 0 and main(["commit-events", store, "--as-of", "2024-06-30"]) == 0
    assert events() and main(["commit-events", store, "--as-of", "2024-06-30"]) == 0
    before = events()
    capsys.readouterr()
    assert main(["snapshot", str(source), store]) == 0 and "unchanged 2" in capsys.readouterr().out
    (source / "bjnr2.zip").unlink()  # a run over fewer archives leaves the other laws alone
    archive(source, "BJNR1", BASIC.replace("Das ist zwei", "Das ist drei"))
    (source / "bad.zip").write_bytes(b"x")
    assert main(["snapshot", str(source), store]) == 1
    again = sections()
    assert sorted(again) == sorted(first) and "drei" in again["laws/BJNR1/paragraphs/0001.md"] and again["laws/BJNR2/paragraphs/0007g.md"] == first["laws/BJNR2/paragraphs/0007g.md"]
    assert {r["slug"] for r in load(spark, store, "index").collect()} == {"bjnr1", "bjnr2"}
    assert main(["bund", "commit-events", store, "--as-of", "2024-07-01"]) == 0 and set(before) <= set(events())
    assert main(["bund", "rerender", store]) == 0 and sections() == again
    assert main(["bund", "export", store, str(tmp_path / "corpus")]) == 0
    assert "| 2 | 3 |" in capsys.readouterr().out and len(spark.read.text(str(tmp_path / "corpus")).collect()) == 3
    (source / "bad.zip").unlink()
    assert main(["bund", "sync", str(source), store, "--as-of", "2024-07-02"]) == 0
    (report,) = (tmp_path / "store" / "reports").glob("*.json")
    assert report.read_text() == '{"commit-events": 0, "sync": 0, "verify": 0}'
    assert main(["diff", f"{store}/sections", f"{store}/sections", str(tmp_path / "d")]) == 0
    assert spark.read.parquet(str(tmp_path / "d")).count() == 0


def test_portal_runs(spark, tmp_path, capsys):
    (tmp_path / "vwv").mkdir()
    page = "<html><body><h1 class='jnoverview'>Titel</h1><p class='jnsmall'>VwV Eins</p><p class='jnsmall'>Vom 5. März 2001</p>@</body></html>"
    part = "<p class='jnenbez'>%s Kopf</p><div class='jnhtml'><p>Text %s</p></div>"
    (tmp_path / "vwv" / "a.html").write_text(page.replace("@", part % ("1.", 1) + part % ("2.10", 2)), encoding="utf-8")
    store = tmp_path / "store"
    names = lambda: sorted(str(p.relative_to(store)) for p in store.rglob("*.md"))
    assert main(["vwv", "sync", str(tmp_path / "vwv"), str(store)]) == 0 and names() == ["vwv/vwv-eins/01.md", "vwv/vwv-eins/02.10.md"]
    capsys.readouterr()
    assert main(["vwv", "sync", str(tmp_path / "vwv"), str(store)]) == 0 and capsys.readouterr().out == "unchanged 2\n"
    (tmp_path / "vwv" / "a.html").write_text(page.replace("@", part % ("1.", 9)), encoding="utf-8")
    assert main(["vwv", "sync", str(tmp_path / "vwv"), str(store)]) == 0 and names() == ["vwv/vwv-eins/01.md"]
    assert capsys.readouterr().out == "deleted 1, written 1\n"
    assert main(["vwv", "status", str(store)]) == 0 and capsys.readouterr().out == "vwv: full, files 1\n"
    (tmp_path / "land").mkdir()
    (tmp_path / "land" / "l.html").write_text("<h2>A</h2><a href='/x/1.html'>VwV  Zwei Worte</a>")
    assert main(["vwv", "list", str(tmp_path / "land")]) == 0 and "VwV" in capsys.readouterr().out

    (tmp_path / "eu").mkdir()
    (tmp_path / "eu" / "32016R0679.de.html").write_text("<html><title>Akt - EUR-Lex</title><body><p class='ti-art'>Artikel 1</p><p class='oj-normal'>eins</p></body></html>")
    assert main(["eu", "sync", str(tmp_path / "eu"), str(store)]) == 0 and "eu/eu-verordnung/32016R0679/de/0001.md" in names()
    assert main(["eu", "parse", str(tmp_path / "eu"), str(tmp_path / "parsed")]) == 0 and spark.read.json(str(tmp_path / "parsed")).first()["celex"] == "32016R0679"
    assert main(["eu", "probe", str(tmp_path / "eu")]) == 0 and "32016R0679" in capsys.readouterr().out
    assert main(["eu", "backfill", "x", "2020-01-01", "2020-02-01", "o", "c", "--window-days", "20", "--dry-run"]) == 0
    assert capsys.readouterr().out == "2020-01-01 2020-01-21\n2020-01-21 2020-02-01\n"

    decision = "<dokument><ecli>ECLI:DE:BAG:2020:010120.U.1</ecli><gericht>%s</gericht><entscheidungsdatum>1.1.2020</entscheidungsdatum><aktenzeichen>1</aktenzeichen><doktyp>Urteil</doktyp><gruende><p>g</p></gruende></dokument>"
    archive(tmp_path / "dec", "D1", decision % "BAG")
    assert main(["rechtsprechung", "sync", str(tmp_path / "dec"), str(store), "--court", "bgh"]) == 0 and not [n for n in names() if n.startswith("decisions")]
    assert main(["rechtsprechung", "sync", str(tmp_path / "dec"), str(store), "--court", "bag"]) == 0
    assert "decisions/DE/BAG/2020/010120.U.1/decision.md" in names()


def test_misuse(spark, tmp_path, small):
    assert main(["query", "nope", small, str(tmp_path / "q")]) == 2
    assert main(["query", "q08_kind_counts", small, str(tmp_path / "q")]) == 0
    assert main(["states", "--sync", "by"]) == 2 and main(["states"]) == 0
    assert main(["backfill", "x", "2020-01-01", "2020-02-01", str(tmp_path / "o"), str(tmp_path / "c"), "--window-days", "0"]) == 2
    assert main(["init", "--database", "pg_cli"]) == 0
    with pytest.raises(SystemExit):
        main([])


def test_registry(spark):
    assert registry.states(spark).count() == 16
    assert isinstance(registry.adapter("bund"), registry.FederalLaws)
    assert isinstance(registry.adapter("eu"), registry.EuActs) and isinstance(registry.adapter("vwv"), registry.Regulations)
    with pytest.raises(ValueError):
        registry.EuActs(languages=("de", ""))
    with pytest.raises(NotImplementedError):
        registry.adapter("land/nw")
