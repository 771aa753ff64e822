import hashlib
import io

import pytest

from paragrid.llm import warc


def archive(records, **options):
    out = io.BytesIO()
    warc.write_archive(iter(records), out, **options)
    return out.getvalue()


def record(i, payload=b"x", responder=None):
    return warc.build_record(i, f"http://h.example/{i}", payload, responder, "2024-01-01T00:00:00Z")


@pytest.mark.parametrize("n", [0, 1, 3, 300])
def test_round_trip_with_and_without_dictionary(n):
    payloads = [f"<html>seite {i} {'text ' * 200}</html>".encode() for i in range(n)]
    rows = list(warc.read_archive(io.BytesIO(archive([record(i, p) for i, p in enumerate(payloads)], dict_bytes=4096)), "a"))
    assert [r["payload"] for r in rows] == payloads and all(r["error"] is None for r in rows)
    assert len({r["frame_offset"] for r in rows}) == n


def test_each_frame_decodes_alone():
    import struct

    import zstandard

    data = archive([record(i, b"seite " * 500 + str(i).encode()) for i in range(200)], dict_bytes=4096)
    size = struct.unpack_from("<I", data, 4)[0]
    assert size > 0
    rows = list(warc.read_archive(io.BytesIO(data), "a"))
    one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size])).decompressobj().decompress(data[rows[117]["frame_offset"] :])
    assert warc.parse_record(one)["page_id"] == 117


def test_bad_archives_give_error_rows():
    good = archive([record(1), record(2)])
    read = lambda data: list(warc.read_archive(io.BytesIO(data), "a"))
    assert read(b"")[0]["error"] and read(b"\x28\xb5\x2f\xfd1234")[0]["error"]
    cut = read(good[:-3])
    assert [bool(r["error"]) for r in cut] == [False, True]
    broken = [record(1).replace(b"Content-Length: 7", b"Content-Length: 8", 1), record(2).replace(b"WARC-Date", b"WARC-Dote"), b"junk", record(3)]
    rows = read(archive([broken[1], broken[2], record(4, b"abc").replace(b"abc", b"abd"), record(3)]))
    assert [bool(r["error"]) for r in rows] == [True, True, True, False]


def test_operator_edges(spark, tmp_path):
    pages = [(1, "http://a/ä b\n", "same", 9), (5, None, "same", 9), (3, "u", "same", 9), (2, "u", None, 9), (4, "u", "", 9), (None, "u", "alone", 9), (7, "u", "x" * 300_000, 9), (7, "u", "x" * 300_000, 9)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, digest int")
    got = warc.read_warc(warc.write_warc(frame)).collect()
    assert len(got) == len(pages) and not any(r["error"] for r in got)
    by = {r["page_id"]: r for r in got}
    assert {k: (by[k]["record_type"], by[k]["refers_to"]) for k in (1, 3, 5)} == {1: ("revisit", 5), 3: ("revisit", 5), 5: ("response", None)}
    assert (by[2]["record_type"], by[2]["refers_to"], by[2]["payload_bytes"]) == ("revisit", 4, 0) and by[4]["record_type"] == "response"
    assert [r["record_type"] for r in got if r["page_id"] == 7] == ["response", "response"] and by[None]["record_type"] == "response"
    assert by[1]["payload_bytes"] == 4 and by[1]["payload_digest"] == warc.sha1_base32(b"same")
    small = warc.read_warc(warc.write_warc(frame, min_payload_bytes=5)).where("payload_bytes < 5")
    assert {r["record_type"] for r in small.collect()} == {"response"}
    assert warc.read_warc(warc.write_warc(frame.where("false"))).count() == 0


def test_files_as_they_lie_on_disk(spark):
    import struct

    import zstandard

    frame = spark.range(60).selectExpr("id as page_id", "concat('http://h/', id) as url", "repeat(concat('seite ', id, ' '), 400) as html")
    manifest = warc.write_warc(frame.coalesce(1), dict_bytes=2048)
    rows = warc.read_warc(manifest).collect()
    sizes = {r["path"]: r["n_bytes"] for r in manifest.collect()}
    assert len(rows) == 60 and not any(r["error"] for r in rows)
    seen = 0
    for name, size in sizes.items():
        with open(name.removeprefix("file://"), "rb") as source:
            data = source.read()
        magic, length = struct.unpack_from("<II", data)
        assert (len(data), magic) == (size, warc.DICT_MAGIC)
        unpack = zstandard.ZstdDecompressor(dict_data=warc._dict_of(data[8 : 8 + length]))
        for r in (r for r in rows if r["archive"] == name):
            with open(name.removeprefix("file://"), "rb") as source:  # record k alone, by its place in the file
                source.seek(r["frame_offset"])
                one = unpack.decompressobj().decompress(source.read())
            assert warc.parse_record(one)["page_id"] == r["page_id"]
            seen += 1
    assert seen == 60


def test_query(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "html").collect()
    last = {}
    for p in pages:
        h = hashlib.sha1((p["html"] or "").encode()).hexdigest()
        last[h] = max(last.get(h, -1), p["page_id"])
    got = {r["page_id"]: r for r in warc.op1_warc_zstd(spark, small).collect()}
    assert len(got) == len(pages)
    for p in pages:
        data = (p["html"] or "").encode()
        top = last[hashlib.sha1(data).hexdigest()]
        r = got[p["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), warc.sha1_base32(data))
        assert (r["record_type"], r["refers_to"]) == (("response", None) if top == p["page_id"] else ("revisit", top))


def test_held_records_are_bounded():
    taken, written = [], []

    class Out(io.BytesIO):
        def write(self, data):
            written.append(len(taken))
            return super().write(data)

    def records():
        for i in range(40):
            taken.append(i)
            yield warc.build_record(i, "u", bytes([i]) * 1000, None, "2024-01-01T00:00:00Z")

    out = Out()
    assert warc.write_archive(records(), out, held_bytes=5000)[0] == 40 and written[0] <= 5
    out.seek(0)
    got = list(warc.read_archive(out, "a"))
    assert [(r["page_id"], r["payload"], r["error"]) for r in got] == [(i, bytes([i]) * 1000, None) for i in range(40)]
