import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paragrid.llm import media

PAGE = """<body><h1>Kopf</h1><p>eins <img src="sha256:aa" alt="alt"> zwei<figure><img src="b.png" data-digest="bb"><video src="c"></video><figcaption>Unter <b>schrift</b></figcaption></figure>
<script>var x = "<p>nein</p>"</script><!-- nein --><p>drei<p>vier<img><figure><img src="sha256:dd">"""


def test_interleaving_keeps_order_and_captions():
    items = media.parse_interleaved(PAGE)
    assert [i["position"] for i in items] == list(range(len(items)))
    assert [(i["kind"], i["text"], i["digest"], i["caption"]) for i in items] == [
        ("text", "Kopf", None, None), ("text", "eins", None, None), ("media", None, "aa", "alt"), ("text", "zwei", None, None), ("media", None, "bb", "Unter schrift"),
        ("media", None, None, "Unter schrift"), ("text", "drei", None, None), ("text", "vier", None, None), ("media", None, "dd", None),
    ]
    assert media.parse_interleaved(None) == [] and media.parse_interleaved("") == []


def test_png_round_trip_and_filters():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, (5, 7), dtype=np.uint8)
    assert (media.decode_png(media.encode_png(raw.tobytes(), 7)) == raw).all()
    lines = np.zeros((6, 8), dtype=np.uint8)
    lines[:, 0], lines[:, 1:] = [0, 1, 2, 3, 4, 0], rng.integers(0, 256, (6, 7))
    out = media._unfilter(lines)
    left = lambda y, x: int(out[y, x - 1]) if x else 0
    for y in range(6):
        for x in range(7):
            a, b, c = left(y, x), int(out[y - 1, x]) if y else 0, left(y - 1, x) if y else 0
            p = a + b - c
            paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
            guess = [0, a, b, (a + b) // 2, paeth, 0][y]
            assert out[y, x] == (int(lines[y, x + 1]) + guess) % 256
    good = media.encode_png(raw.tobytes(), 7)
    for bad in (b"", good[:-6], good[:40] + b"\0" + good[41:]):
        with pytest.raises(ValueError):
            media.decode_png(bad)


def expected(text):
    data = (text or "").encode()
    payload = data + b"\xff" * (max(576, -(-len(data) // 576) * 576) - len(data))
    stored = media.encode_png(payload)
    return (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest())


NAMES = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256")


def test_operator_edges(spark, edge_docs, edge_rows, no_docs, tmp_path):
    edge_docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = media.op3_media_columns(spark, str(tmp_path)).collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r["doc_id"], tuple(r[n] for n in NAMES)) for r in got), key=key) == sorted(((d, expected(t)) for d, t in edge_rows), key=key)
    assert len({r["feature"] for r in got if r["payload_sha256"] == got[0]["payload_sha256"]}) == 1
    assert all((r["caption"], r["position"], r["n_items"], r["origin_position"]) == (f"document {r['doc_id']}", 1, 4, 3) for r in got)
    origins = {r["doc_id"]: r["source"] for r in edge_docs.where("doc_id < 3").collect()}
    picture = lambda x: hashlib.sha256(media.payload_of(x)).hexdigest()
    assert all((r["origin_caption"], r["origin_sha256"]) == (f"origin {origins[r['doc_id']]}", picture(origins[r["doc_id"]])) for r in got if r["doc_id"] in origins)
    assert media.store_texts(no_docs).count() == 0


def test_resolve_keeps_positions(spark):
    pages = spark.createDataFrame([(1, PAGE, "x"), (2, None, "x"), (3, PAGE, "x")], "page_id long, html string, media string")
    items = media.interleave(pages, id_col="page_id")
    stored = spark.createDataFrame([("aa", 1, b"A"), ("bb", 2, b"B")], "digest string, size int, media binary")
    got = {r["page_id"]: r["sequence"] for r in media.resolve(items, stored, id_col="page_id", columns=["size", "media"]).collect()}
    assert [s["item"]["position"] for s in got[1]] == list(range(9)) and list(got[2]) == []
    assert [(s["media"]["size"], bytes(s["media"]["media"])) for s in got[3] if s["media"]] == [(1, b"A"), (2, b"B")]
    assert items.select(F.sum(F.size("items"))).first()[0] == 18


def test_real_pages_keep_their_order(spark, small):
    """Pages of the test data with pictures put between their paragraphs: items, positions and media stay aligned."""
    rows = [(r["page_id"], (r["html"] or "").replace("</p>", f"</p><figure><img src='sha256:{r['page_id'] % 7}'><figcaption>zu {r['page_id']}</figcaption></figure>")) for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    pages = spark.createDataFrame(rows, "page_id long, html string").repartition(3)
    known = spark.createDataFrame([(str(k), 10 * k) for k in range(6)], "digest string, size int")  # the seventh is not known
    got = {r["page_id"]: r["sequence"] for r in media.resolve(media.interleave(pages, id_col="page_id"), known, id_col="page_id", columns=["size"]).collect()}
    assert set(got) == {k for k, _ in rows}
    for k, html in rows:
        want = media.parse_interleaved(html)
        assert [s["item"].asDict() for s in got[k]] == want
        for s in got[k]:
            own = s["item"]["kind"] == "media" and s["item"]["digest"] is not None and k % 7 < 6
            assert (s["media"]["size"] if s["media"] else None) == (10 * (k % 7) if own else None)
            assert s["item"]["kind"] == "text" or s["item"]["digest"] is None or s["item"]["caption"] == f"zu {k}"
    assert sum(s["item"]["kind"] == "media" for x in got.values() for s in x) > len(rows)


def test_query(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in media.op3_media_columns(spark, small).collect()}
    assert got == {d: expected(t) for d, t in docs.items()}
