import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paragrid.llm import suffix


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, texts):
        cover = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                cover[i : i + length] = True
        runs = int((np.diff(np.concatenate(([0], cover.astype(int)))) == 1).sum())
        out.append((doc_id, len(b), int(cover.sum()), runs, hashlib.sha256(np.frombuffer(b, dtype=np.uint8)[~cover].tobytes()).hexdigest()))
    return Counter(out)


def run(frame, **options):
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.remove_repeats(frame, **options).collect())


def brute_words(rows, length):
    """Byte runs covered by strings of ``length`` words that start twice or more; runs by words, so blanks inside go too."""
    places = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for _, t in rows]
    words = [[(t or "").encode()[a:b] for a, b in p] for (_, t), p in zip(rows, places)]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (doc_id, t), w, p in zip(rows, words, places):
        data, cover = (t or "").encode(), np.zeros(len(w) + 1, dtype=int)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                cover[i : i + length] = 1
        edge = np.flatnonzero(np.diff(np.concatenate(([0], cover, [0]))))
        runs = [(p[a][0], p[b - 1][1]) for a, b in zip(edge[::2], edge[1::2])]
        kept, at = b"", 0
        for a, b in runs:
            kept, at = kept + data[at:a], b
        kept += data[at:]
        out.append((doc_id, len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=12, max_size=90), min_size=1, max_size=6), st.sampled_from([(2, 2), (2, 3), (4, 5), (1, 1)]), st.booleans(), st.randoms())
def test_corpus_order_finds_all_repeats(monkeypatch_module, texts, cut, as_words, r):
    texts = [t + texts[0][3:] if r.random() < 0.4 else t for t in texts]
    unit, length = ("words", 12) if as_words else ("bytes", 12)
    monkeypatch_module.setitem(suffix.CUT, unit, cut)
    phrases = [np.frombuffer(t.encode(), dtype=np.uint8).astype(np.uint64 if as_words else np.uint8).tobytes() for t in texts]
    weights = [r.choice([1, 1, 1, 2]) for _ in texts]
    seen = Counter()
    for t, n in zip(texts, weights):
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] += n
    got = suffix.repeated_windows(phrases, weights, length, unit)
    for t, flags in zip(texts, got):
        assert flags.tolist() == [seen[t[i : i + length]] > 1 for i in range(len(t) - length + 1)]


@pytest.fixture(scope="module")
def monkeypatch_module():
    with pytest.MonkeyPatch.context() as patch:
        yield patch


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="abc", min_size=1, max_size=60), st.integers(1, 20))
def test_suffix_ranks(text, depth):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    stop = np.full(len(data), len(data))
    rank = suffix.suffix_ranks(*suffix._first_codes(data, stop)[:1], stop, max(depth, 7), 7)
    tails = [text[i : i + max(depth, 7)] for i in range(len(text))]
    for i, x in enumerate(tails):
        for j, y in enumerate(tails):
            assert (rank[i] == rank[j]) == (x == y) and (rank[i] < rank[j]) == (x < y)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=150), max_size=5))
def test_phrases_hold_each_window_once(texts):
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)])
    joined = b"".join(data)
    doc, s, e, at, trig = suffix.parse_phrases(np.frombuffer(joined, dtype=np.uint8), bounds, 20, 4)
    held = sorted(i for a, b in zip(s, e) for i in range(a, b + 1))
    assert held == [i for a, b in zip(bounds, bounds[1:]) for i in range(a, b - 19)]
    names = {}
    for a, b, p, t in zip(s.tolist(), e.tolist(), at.tolist(), trig.tolist()):
        for i in range(a, b + 1):
            assert names.setdefault(joined[i : i + 20], (t, p - i)) == (t, p - i)  # equal windows, equal triggers at the same place


def rows_of(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(100) for _ in range(3)] + ["ä€" * 150, "ab" * 500, "z" * 900]
    rows = [(k, text(r.randint(0, 60)) + r.choice(passages)[r.randint(0, 40) :] + text(r.randint(0, 60)) + r.choice(passages)) for k in range(25)]
    return rows + [(100, rows[0][1]), (101, passages[0][:399]), (102, passages[0][:400]), (103, text(300)), (104, passages[4][1:]), (105, None), (105, ""), (None, rows[1][1]), (2, rows[2][1])]


@pytest.mark.parametrize("options", [{}, {"shard_phrases": 1}, {"shard_phrases": 3, "block": 50}])
def test_brute_force(spark, options):
    rows = rows_of()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert run(frame, **options) == brute(rows, 400)


@pytest.mark.parametrize("options", [{}, {"shard_phrases": 1, "block": 6}])
def test_words_brute_force(spark, options):
    rows = [(d, t and t.replace("ä€", "ä €\n").replace("ab", "a b ")) for d, t in rows_of(9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert run(frame, length=51, unit="words", **options) == brute_words(rows, 51)
    said = suffix.remove_repeats(frame, passage_words=51, **options).collect()
    assert Counter((r["doc_id"], r["n_passages"]) for r in said) == Counter({(d, n): c for (d, _, _, n, _), c in Counter((d, 0, 0, n, 0) for (d, _, _, n, _), k in brute_words(rows, 51).items() for _ in range(k)).items()})
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in said) == brute(rows, 400)


def test_long_text_of_words(monkeypatch):
    text = ("Wort für wort\n " * 700).encode()
    whole = suffix.symbols_of(text, "words"), suffix.word_places(text)
    monkeypatch.setattr(suffix, "CHUNK", 100)
    pieces = suffix.symbols_of(text, "words"), suffix.word_places(text)
    assert np.array_equal(whole[0], pieces[0]) and all(np.array_equal(a, b) for a, b in zip(whole[1], pieces[1]))
    assert [text[a:b] for a, b in zip(*whole[1])] == text.split() and len(set(whole[0].tolist())) == 3


def test_long_text_in_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix, "CHUNK", 1000)
    texts = [t for _, t in rows_of(5)[:8]]
    got = list(suffix._segments(pa.array(["".join(texts), None, texts[0]]), 400, "bytes"))
    assert sum(len(b) for _, b, _ in got) >= len("".join(texts).encode())
    one = "".join(texts).encode()
    starts = sorted({at for names, _, _ in got for row, at in names if row == 0})
    assert starts == list(range(0, len(one) - 399, 1000))


def test_edges(spark, edge_docs, edge_rows, no_docs):
    assert run(edge_docs) == brute(edge_rows, 400)
    assert run(no_docs) == Counter()
    assert run(edge_docs.where("length(text) < 50")) == brute([r for r in edge_rows if r[1] is not None and len(r[1]) < 50], 400)


def test_stage(spark, edge_docs):
    out = suffix.suffix_stage(spark, edge_docs, "")
    assert out.columns == edge_docs.columns
    rows = out.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows if r["doc_id"] in (9, 10))
    assert {0, 1, 2, 3} <= {r["doc_id"] for r in rows}  # null and empty texts, texts without a passage
    assert 5 not in {r["doc_id"] for r in rows}  # its only words are a passage found elsewhere


def test_no_passage_survives_in_two_documents(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(3, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(51), text(52), text(60)]
    assert all(len(p) < 400 for p in passages)
    rows = [(k, f"{text(80)} {p} {text(80)}", "de", "s", 0) for k, p in enumerate(passages * 4)] + [(50, text(200), "de", "s", 0), (51, f"{text(80)} {passages[0][: passages[0].rindex(' ')]} {text(80)}", "de", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {x["doc_id"]: x["text"].split() for x in suffix.suffix_stage(spark, docs, "").collect()}
    given = {x[0]: x[1].split() for x in rows}
    assert out[50] == given[50] and out[51] == given[51]
    assert all(len(out[k]) == 160 for k in range(12))
    seen = Counter(x for w in out.values() for x in {tuple(w[i : i + 51]) for i in range(len(w) - 50)})
    assert max(seen.values()) == 1


def test_kept_text_has_whole_characters(spark):
    rows = [(1, "ä" * 199 + "xy" + "q" * 50), (2, "€" + "ä" * 198 + "xy" + "r" * 50), (3, "ä" * 250)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for r in suffix.remove_repeats(frame, with_text=True).collect():
        assert "�" not in r["kept_text"]


def test_words_of_short_texts_are_hashed_together(monkeypatch):
    """Symbols don't depend on what is hashed at once, and short texts share a call."""
    texts = [b"", b"a b", b"b\n", b" a", b"a", b"\xc3\xa4 " * 60, b"  ", b"x" * 150 + b" y", b"z", b""]
    want = [suffix.symbols_of(t, "words").tolist() for t in texts]
    calls, hashes = [], suffix.word_hashes
    monkeypatch.setattr(suffix, "word_hashes", lambda data, *a, **k: calls.append(len(data)) or hashes(data, *a, **k))
    monkeypatch.setattr(suffix, "CHUNK", 100)
    assert [x.tolist() for x in suffix.symbols_of_all(texts, "words")] == want
    assert len(calls) == 7  # three of short texts, two pieces of each long one
    assert [x.tobytes() for x in suffix.symbols_of_all(texts, "bytes")] == texts


def test_what_is_ordered_at_once_fits_a_cache():
    """Hashes and ranks take eight bytes a symbol; at eight and twelve times these sizes the two steps took 3.5 and 1.5 times the CPU seconds."""
    assert suffix.CHUNK <= 1 << 16 and suffix.SHARD_BYTES <= 1 << 18
