import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paragrid.llm import bpe, pfor

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTES, WORDS = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))


def round_trip(parts, flush=1024):
    f = io.BytesIO()
    w = pfor.TokenFileWriter(f, flush_ids=flush)
    for i, p in enumerate(parts):
        w.add(i if i != 1 else None, np.asarray(p, dtype=np.uint32))
    w.close()
    return list(pfor.read_documents(f, f.tell(), step_blocks=2))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2**32 - 1)), max_size=1300), max_size=4))
def test_blocks_round_trip(parts):
    got = round_trip(parts)
    assert [x[2].tolist() for x in got] == parts and [x[0] for x in got] == [None if i == 1 else i for i in range(len(parts))]
    assert [x[1] for x in got] == np.cumsum([0, *map(len, parts)])[:-1].tolist()


def test_exceptions_keep_blocks_narrow():
    ids = np.full(pfor.BLOCK, 7, dtype=np.uint32)
    ids[::100] = 2**31
    (block,) = pfor.encode_blocks(ids)
    size, width, _, exceptions, low = pfor.HEAD.unpack_from(block)
    assert (size, width, exceptions, low) == (512, 0, 6, 7) and len(block) == pfor.HEAD.size + 6 * 6
    with pytest.raises(ValueError):
        list(pfor.read_documents(io.BytesIO(b"\0" * 60), 60))


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_cached_ids_are_the_library_s(path, edge_rows):
    texts = [t or "" for _, t in edge_rows] + ["it's I'LL  a\xa0b ''s 'tis x'S\n\n  y  ", "İstanbul ǅ é", "12 345 ½ ª ß ÿ Ÿ – “q” €5", "\x85\x1c"]
    texts += ["a <|endoftext|> b", "a<|endoftext|>b <|ENDOFTEXT|>", "<|startoftext|>  x", "<|", "a <| endoftext |> <|endoftext", "<|endoftext|>" * 40]
    coder = bpe.CachedEncoder(path, cache_words=50)
    got = [np.frombuffer(b, dtype="<u4").tolist() for k in range(0, len(texts), 3) for b in coder.encode_batch(texts[k : k + 3])]
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)  # untouched
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def check(spark, frame, got):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTES)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    at, want = 0, []
    for doc_id, text in rows:
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got.collect()), key=lambda r: r[1]) == want


def test_operator_edges(spark, edge_docs, no_docs):
    check(spark, edge_docs, pfor.read_tokens(pfor.write_tokens(edge_docs, BYTES)))
    assert pfor.read_tokens(pfor.write_tokens(no_docs, BYTES)).count() == 0


def test_query(spark, small):
    check(spark, spark.read.parquet(f"{small}/documents.parquet"), pfor.op2_pfor_tokens(spark, small))


def test_starts_over_blocks_of_files(spark):
    counts = {k: (k * 37) % 11 for k in range(0, 60, 2) if k not in range(20, 32)}  # gaps: partitions without a row have no file
    rows = spark.createDataFrame([(k, f"p{k}", 1, n) for k, n in counts.items()], pfor.MANIFEST).repartition(5)
    want, total = {}, 0
    for k, n in sorted(counts.items()):
        want[k], total = total, total + n
    for block in (1, 3, 7, pfor.FILE_BLOCK):
        got = pfor.with_starts(rows, block)
        assert got.columns == [*rows.columns, "first"] and {r["file_no"]: r["first"] for r in got.collect()} == want
    assert pfor.with_starts(rows.limit(0)).count() == 0
