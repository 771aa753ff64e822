import itertools
import zlib
from collections import Counter

import numpy as np
import pytest

from paragrid.llm import sampling

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sampling.PieceModel(PATH)


def segmentations(text, model):
    """All segmentations of a text with their probabilities, by plain recursion over the library's pieces."""
    rank = {}
    for i in range(model.library.vocab_size()):
        if not (model.library.is_byte(i) or model.library.is_control(i) or model.library.is_unknown(i)):
            rank[model.library.id_to_piece(i)] = (i, -np.log(len(rank) + 3.0))

    def unit(u):
        out = []

        def grow(at, ids, weight):
            if at == len(u):
                out.append((tuple(ids), weight))
                return
            for size in range(1, 17):
                piece = u[at : at + size].replace(" ", "▁")
                if at + size <= len(u) and piece in rank and "▁" not in u[at : at + size]:
                    grow(at + size, [*ids, rank[piece][0]], weight + rank[piece][1])
            c = u[at]
            if c == "▁" or c.replace(" ", "▁") not in rank:
                data = c.encode()
                grow(at + 1, [*ids, *(model.byte_ids[b] for b in data)], weight + len(data) * model.byte_weight)

        grow(0, [], 0.0)
        return out

    made = [(sum((i for i, _ in c), ()), sum(w for _, w in c)) for c in itertools.product(*(unit(u) for u in (u if u[0] == " " else " " + u for u in sampling.units_of(text))))]
    total = np.logaddexp.reduce([w for _, w in made])
    return {tuple(map(int, i)): float(np.exp(w - total)) for i, w in made}


@pytest.mark.parametrize("text", ["the ab", "in▁x", "日\n語", "a  b", ""])
def test_samples_are_distinct_and_exact(model, text):
    want = segmentations(text, model)
    k = 3
    for made, kappa, lattice in sampling.sample_batch([text] * 20, list(range(20)), model, k=k, seed=1):
        ids = [tuple(sampling.path_ids(lattice, p).tolist()) for p in made]
        assert len(set(ids)) == len(ids) == min(k, len(want))
        assert all(abs(np.exp(p.log_p) - want[i]) < 1e-9 for p, i in zip(made, ids))
        assert [p.value for p in made] == sorted((p.value for p in made), reverse=True) and kappa <= made[-1].value
        assert all(model.decode(list(i)) == text for i in ids)
    (made, kappa, _), = sampling.sample_batch([text], [1], model, k=len(want) + 5)
    assert len(made) == len(want) and kappa == -np.inf


def test_frequencies_and_inclusion(model):
    text, n = "the ab", 6000
    want = segmentations(text, model)
    first, pair, weight = Counter(), Counter(), 0.0
    for at in range(0, n, 2000):
        for made, kappa, lattice in sampling.sample_batch([text] * 2000, list(range(at, at + 2000)), model, k=2, seed=9):
            a, b = (tuple(sampling.path_ids(lattice, p).tolist()) for p in made)
            first[a] += 1
            pair[a, b] += 1
            weight += sum(np.exp(p.log_p) / -np.expm1(-np.exp(p.log_p - kappa)) for p in made)
    top = sorted(want, key=want.get, reverse=True)[:2]
    for a in top:
        assert abs(first[a] / n - want[a]) < 4 * np.sqrt(want[a] / n)
    second = want[top[0]] * want[top[1]] / (1 - want[top[0]])
    assert abs(pair[top[0], top[1]] / n - second) < 4 * np.sqrt(second / n)
    assert abs(weight / n - 1) < 0.05  # inverse inclusion weights are unbiased


def test_rows_do_not_depend_on_their_batch(model):
    texts = ["eins zwei", "drei  vier\nfünf", "x" * 500, "eins zwei"]
    whole = sampling.sample_batch(texts, [1, 2, 3, 1], model, k=2)
    for i, text in enumerate(texts):
        (alone, kappa, lattice), = sampling.sample_batch([text], [[1, 2, 3, 1][i]], model, k=2)
        made, other, big = whole[i]
        assert [sampling.path_ids(lattice, p).tolist() for p in alone] == [sampling.path_ids(big, p).tolist() for p in made] and abs(kappa - other) < 1e-9 or kappa == other


def test_library_encoding_decodes(model):
    for text in ("Ein Satz.", "a  b\nc", "日本 😀"):
        assert model.decode(model.encode(text)) == text


def test_operator_edges(spark, edge_docs, edge_rows, no_docs):
    got = sampling.sample_segmentations(edge_docs, PATH).collect()
    assert all(r["round_trip"] for r in got) and all(0 < r["inclusion"] <= 1 for r in got)
    per = Counter(r["doc_id"] for r in got)
    assert per[1] == 1 and per[0] == 1 and per[4] == 2 and per[5] == 6
    assert len({(r["sample"], r["ids_crc32"]) for r in got if r["doc_id"] == 5}) == 2
    assert sampling.sample_segmentations(no_docs, PATH).count() == 0


def test_query(spark, small, model):
    got = {(r["doc_id"], r["sample"]): r for r in sampling.op8_gumbel_segmentations(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert {d for d, _ in got} == {r["doc_id"] for r in docs}
    for r in docs[:40]:
        (made, _, lattice), = sampling.sample_batch([r["text"]], [r["doc_id"]], model, k=2)
        for k, p in enumerate(made):
            ids = sampling.path_ids(lattice, p)
            assert got[r["doc_id"], k]["ids_crc32"] == zlib.crc32(ids.astype("<u4").tobytes()) and got[r["doc_id"], k]["round_trip"]


def test_short_documents_by_enumeration(spark, model):
    """Whole short documents through the operator: every sample is one of all segmentations, with its probability."""
    texts = ["Reorea. Nd.", "Withthesones |", "La aitreré èé", "ab\ncd", "Zu und"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {}
    for r in sampling.sample_segmentations(frame, PATH, k=4).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for k, text in enumerate(texts):
        want = segmentations(text, model)
        by_crc = {zlib.crc32(np.array(i, dtype="<u4").tobytes()): (len(i), p) for i, p in want.items()}
        assert len({r["ids_crc32"] for r in got[k]}) == len(got[k]) == min(4, len(want))
        for r in got[k]:
            n, p = by_crc[r["ids_crc32"]]
            assert r["n_tokens"] == n and abs(np.exp(r["log_prob"]) - p) < 1e-9


def test_null_keys(spark, model):
    text = " ".join(f"wort{i} und satz" for i in range(30))
    made = {r["doc_id"]: r["ids_crc32"] for r in sampling.sample_segmentations(spark.createDataFrame([(None, text), (-1, text), (0, text)], "doc_id long, text string"), PATH, k=1).collect()}
    assert len(set(made.values())) == 3  # a null key is a key of its own


def test_store_of_units_changes_nothing(model):
    texts = ["eins zwei eins", "drei  vier eins\nfünf", "日 eins 日 zwei", "", "neu eins zwei"] * 2
    plain = [sampling.sample_batch([t], [i], model, k=3)[0] for i, t in enumerate(texts)]
    store = sampling.UnitStore(limit=30)
    stored = [x for at in range(0, len(texts), 2) for x in sampling.sample_batch(texts[at : at + 2], [at, at + 1], model, k=3, store=store)]
    assert 0 < len(store.index) and len(store.lattice.first_arc) - 1 <= 30
    for (a, _, x), (b, _, y) in zip(plain, stored):
        assert [sampling.path_ids(x, p).tolist() for p in a] == [sampling.path_ids(y, p).tolist() for p in b]


def test_largest_draw_stays_in_its_state(model, monkeypatch):
    below = np.nextafter(1.0, 0.0)
    monkeypatch.setattr(sampling, "uniform", lambda seed, *_: np.full(np.shape(seed), below))
    monkeypatch.setattr(sampling, "_unit", lambda x: np.full(len(x), below), raising=False)
    text = "eins zweifach dreiundvierzig"
    for made, _, lattice in sampling.sample_batch([text] * 3, [1, 2, 3], model, k=2):
        assert len(made) == 2 and all(model.decode(sampling.path_ids(lattice, p).tolist()) == text for p in made)


def test_units_with_line_ends_are_built_once(model, monkeypatch):
    """A byte that is no piece has one token wherever it stands, so its unit is kept as others are."""
    built, build = [], sampling.build_lattice
    monkeypatch.setattr(sampling, "build_lattice", lambda units, model: built.append(list(units)) or build(units, model))
    store = sampling.UnitStore()
    texts = ["Satz.\nNeu und Satz.\nNeu", "🂡\n und 🂡\n"]
    first, again = (sampling.sample_batch(texts, [1, 2], model, k=2, store=store) for _ in range(2))
    assert "Satz.\nNeu" in built[0] and set(built[1]) == {"🂡\n"}
    for (a, _, x), (b, _, y), text in zip(first, again, texts):
        assert [sampling.path_ids(x, p).tolist() for p in a] == [sampling.path_ids(y, p).tolist() for p in b]
        assert all(model.decode(sampling.path_ids(y, p).tolist()) == text for p in b)


def test_numbers_of_a_unit_do_not_depend_on_others(model):
    many = [f"wort{i}" for i in range(sampling.UNITS_AT_ONCE + 5)]
    alone, crowd = sampling.build_lattice(["unabhängigkeit"], model), sampling.build_lattice([*many, "unabhängigkeit"], model)
    begin = crowd.first_arc[crowd.start[-1]]
    assert len(crowd.start) == len(many) + 1
    assert crowd.through[begin:].tolist() == alone.through.tolist() and crowd.log_p[begin:].tolist() == alone.log_p.tolist()
    assert (crowd.go[begin:] - begin).tolist() == alone.go.tolist()
