"""The pull parser against the tree: the same sections, and memory that does not grow with the law."""

import io
import tracemalloc
import zipfile

import pytest

from paragrid.sources import laws, lawstream


def norm(n, unit="", body="<P>(1) Eins. <SUP class='Rec'>1</SUP>Zwei.</P>"):
    return f"<norm><metadaten><enbez>§ {n}</enbez><titel>T{n}</titel>{unit}</metadaten><textdaten><text format='XML'><Content>{body}</Content></text></textdaten></norm>"


def unit(number, title):
    return f"<gliederungseinheit><gliederungskennzahl>{number}</gliederungskennzahl><gliederungsbez>{title}</gliederungsbez></gliederungseinheit>"


HEAD = "<norm><metadaten><jurabk>AB</jurabk><langue>Lang</langue><standangabe><standtyp>Stand</standtyp><standkommentar>Stand 1.2.2020</standkommentar></standangabe></metadaten></norm>"
LAWS = {
    "A": f"<dokumente>vor{HEAD}<x/>" + "".join(norm(n % 7, unit(("010", "010010", "", "020")[n % 4], f"U{n}") if n % 3 == 0 else "") for n in range(200)) + "nach</dokumente>",
    "B": f"<dokumente>{HEAD}<teil>{norm('1a')}{norm('2', body='<P>x</P><P>y</P>')}</teil><norm/></dokumente>",
    "Leer": "<dokumente/>",
    "Bruch": f"<dokumente>{HEAD}{norm(1)}",
    "Ohne": f"<dokumente><norm/>{norm(1)}</dokumente>",
    "Nichts": " ",
}


@pytest.mark.parametrize("mode", ["compat", "fixed"])
def test_same_sections(spark, tmp_path, mode):
    for name, xml in LAWS.items():
        if name == "B":
            with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
                z.writestr("z.xml", "<x/>")
                z.writestr("B.xml", xml)
        else:
            (tmp_path / f"{name}.xml").write_text(xml)
    (tmp_path / "kaputt.zip").write_bytes(b"PK")
    (tmp_path / "leer.xml").write_bytes(b"")
    (tmp_path / "andere.txt").write_text("x")
    rows = lawstream.norm_table(spark, str(tmp_path), crumb_mode=mode)
    got = lawstream.section_table(rows).orderBy("bjnr", "seq").drop("seq").collect()
    raw = spark.createDataFrame([(k, v.encode()) for k, v in LAWS.items()], "bjnr string, xml binary")
    parsed = laws.parse_laws(raw, mode)
    want = laws.section_table(parsed).orderBy("bjnr", "seq").select(*got[0].asDict()).collect()
    assert got == want and len(got) == 202
    errors = {r["bjnr"] for r in rows.where("error is not null").collect()}
    assert errors == {r["bjnr"] for r in parsed.where("error is not null").collect()} | {"kaputt"} == {"Leer", "Bruch", "Ohne", "Nichts", "kaputt"}


class Endless(io.RawIOBase):
    """A law of ``n`` norms that is made while it is read."""

    def __init__(self, n):
        self.parts, self.rest = self._made(n), b""

    def _made(self, n):
        yield f"<dokumente>{HEAD}".encode()
        for k in range(n):
            yield norm(k, body=f"<P>({k}) {'Wort ' * 60}</P>").encode()
        yield b"</dokumente>"

    def readable(self):
        return True

    def readinto(self, buffer):
        while len(self.rest) < len(buffer) and (part := next(self.parts, None)) is not None:
            self.rest += part
        got, self.rest = self.rest[: len(buffer)], self.rest[len(buffer) :]
        buffer[: len(got)] = got
        return len(got)


def test_memory_stays():
    peaks = []
    for n in (300, 6000):
        tracemalloc.start()
        assert sum(r["error"] is None for r in lawstream.law_rows("E", Endless(n))) == n + 1
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 2 * peaks[0] + 200_000
