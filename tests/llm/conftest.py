"""Fixtures shared by the operator tests."""

import pytest

LONG = " ".join(f"wort{i * 7919 % 1013}" for i in range(6000))
BASE = " ".join(f"alpha{i}" for i in range(60))
EDGE_TEXTS = [
    None, "", " \n\t ", "ein", "zwei drei vier fünf", BASE, BASE, BASE.upper(), BASE + " extra", LONG, LONG + " ende",
    "a\n\nb\n" + BASE + "\n" + BASE, "tab\tseparated\x0bwords\x0cand\rmore " * 12, "日本語 текст 😀 " * 30, "<|im_end|>\\<|x|> <|endoftext|>",
    "aaaa" * 400, "aaaa" * 401,
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, repeated rows, a null id, an id used twice, extra columns with clashing names."""
    rows = [(i, t, "de" if i % 2 else None, f"s{i % 3}", len(t or ""), i, "x") for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[5], rows[5], (None, BASE, "de", "s", 1, 1, "y"), (3, "anderer Text mit gleicher Kennung " * 20, "de", "s", 1, 1, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words int, kept string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")


@pytest.fixture(scope="session")
def edge_rows(edge_docs):
    return [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
