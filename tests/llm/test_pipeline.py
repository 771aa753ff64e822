"""The pipeline against brute-force stages, and the entry's registrations."""

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from paragrid.llm import catalog, quality
from test_jaccard import brute as components
from test_linededup import brute as lines
from test_packing import verify


def repeats_gone(rows, length=51):
    """Texts without strings of ``length`` words that start twice or more; a text that loses all its words goes."""
    places = [[m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")] for _, t in rows]
    words = [[t[a:b] for a, b in p] for (_, t), p in zip(rows, places)]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (d, t), w, p in zip(rows, words, places):
        gone = bytearray(len(w))
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = b"\1" * length
        runs = [(p[m.start()][0], p[m.end() - 1][1]) for m in re.finditer(rb"\x01+", bytes(gone))]
        left, at = "", 0
        for a, b in runs:
            left, at = left + t[at:a], b
        if not runs or (left + t[at:]).strip(" \t\n\x0b\x0c\r"):
            out.append((d, left + t[at:] if runs else t))
    return out


def test_stages_against_brute_force(spark, small):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "ngram_jaccard", "suffix_dedup", "best_fit_packing"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plain = lambda f: sorted((r["doc_id"], r["text"]) for r in f.select("doc_id", "text").collect())
    kept = {r["doc_id"] for r in quality.op10_quality_rules(spark, small).where("kept").collect()}
    want = [r for r in plain(docs) if r[0] in kept]
    for k, step in enumerate((lambda r: r, lambda r: [x for x in lines(r) if re.search(r"[^\x20\x09-\x0D]", x[1])], lambda r: [x for x in r if x[0] in {c for _, _, c in components(r)}], repeats_gone)):
        staged = corpus_pipeline.STAGES[k][1](spark, docs, small)
        docs = spark.createDataFrame(staged.collect(), docs.schema)
        want = sorted(step(want))
        assert plain(docs) == want, names[k]
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    verify(docs, corpus_pipeline.STAGES[4][1](spark, docs, small))


def test_run_is_the_stages_in_turn(spark, small):
    out = corpus_pipeline.run(spark, small)
    assert out.count() > 0 and "sequence_id" in out.columns


def test_repeated_and_unnamed_rows_through_all_stages(spark, tmp_path):
    spark.createDataFrame([(9, 1, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    texts = [" ".join(f"{c}wort{i}" for i in range(120)) for c in "abcd"]
    given = [(1, texts[0]), (1, texts[0]), (None, texts[1]), (None, texts[1] + " ende"), (None, texts[2]), (None, "kurz"), (1, texts[3]), (1, "knapp")]
    docs = spark.createDataFrame([(d, t, "de", "s", len(t)) for d, t in given], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:4]:
        staged = stage(spark, docs, str(tmp_path))
        docs = spark.createDataFrame(staged.collect(), docs.schema)
    left = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert len(left) == 4 and set(left) <= set(given)
    assert {t[0] for _, t in left} == set("abcd")
    packed = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in packed if r["start"] == 0) == ["1", "1", "None", "None"]


def test_stages_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() == 0
    assert corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).count() == 0


def test_a_copy_without_an_id_does_not_cost_both_texts(spark, tmp_path):
    """Of equal texts, one with and one without an id, one row reaches the packing with its whole text."""
    spark.createDataFrame([(9, 1, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    text = "\n".join(" ".join(f"wort{k}x{i}" for i in range(30)) for k in range(4))
    docs = spark.createDataFrame([(3, text, "de", "s", len(text)), (None, text, "de", "s", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.STAGES[2][1](spark, docs, str(tmp_path))
    left = corpus_pipeline.STAGES[3][1](spark, spark.createDataFrame(left.collect(), docs.schema), str(tmp_path))
    assert [(r["doc_id"], r["text"]) for r in left.collect()] == [(3, text)]


def test_stages_with_clashing_columns(spark, tmp_path, edge_docs):
    """Names that a stage might use itself stay the caller's, through all stages, repeated rows and long lines of one word included."""
    spark.createDataFrame([(9, 1, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    text = "\n".join(" ".join(f"wort{k}x{i}" for i in range(30)) for k in range(4))
    more = [(50, text), (50, text), (51, text + "\nneu dazu"), (52, text + " " + "x " * 5000), (53, "y " * 5000 + "\n" + text.replace("wort", "satz"))]
    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars").unionAll(spark.createDataFrame([(d, t, "de", "s", len(t)) for d, t in more], "doc_id long, text string, lang string, source string, n_chars long"))
    names = ["_text", "_own", "_id", "_mark", "_stays", "_stratum", "row", "id", "own", "mark", "kept_text", "new_text", "new_id", "key", "at"]
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in names})
    plain = spark.createDataFrame(docs.drop(*names).collect(), docs.drop(*names).schema)
    for _, stage in corpus_pipeline.STAGES[:4]:
        staged = stage(spark, docs, str(tmp_path))
        assert staged.columns == docs.columns
        docs = spark.createDataFrame(staged.collect(), docs.schema)
        plain = spark.createDataFrame(stage(spark, plain, str(tmp_path)).collect(), plain.schema)
        assert sorted(map(str, docs.drop(*names).collect())) == sorted(map(str, plain.collect()))
        assert docs.where(F.expr(" or ".join(f"{n} <> concat('{n}', doc_id)" for n in names))).isEmpty()
    assert corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).count() >= docs.count() > 0


def test_registered_names():
    import __spark_entry__ as entry

    found = entry.queries()
    assert "pipeline" in found and sorted(int(n[2:].split("_")[0]) for n in found if re.match(r"op\d+_", n)) == list(range(1, 14))
    assert set(catalog.oracle_sql()) <= set(found)
