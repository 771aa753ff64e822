import re
import time

from pyspark.sql import functions as F

from paragrid.llm import linededup


def words(line):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", line) if w]


def near(a, b):
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    """Kept text of each row; an earlier equal line drops a line with a word, one of at least five words within one edit such a line."""
    lines = [((d is not None, d or 0, n), k, words(x)) for k, (d, t) in enumerate(rows) if t is not None for n, x in enumerate(t.split("\n"))]
    long = [x for x in lines if len(x[2]) >= 5]
    gone = {(k, at[2]) for at, k, w in long if any(o < at and near(w, v) for o, _, v in long)}
    gone |= {(k, at[2]) for at, k, w in lines if w and any(o < at and w == v for o, _, v in lines)}
    return [(d, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (k, n) not in gone)) for k, (d, t) in enumerate(rows)]


CASES = [
    (1, "a b c d e f g\nkurz\n\na b c d e f g"), (2, "a b c d e f\nX b c d e f g\nb c d e f g\na  b c\td e f g"), (3, "a b c d X Y g\nkurz"), (4, "a a b c d e f g\na b c d e g f"),
    (5, "v w x y z\nv w x y\nv w x y q\nv w q y z zz"), (6, None), (7, ""), (8, "v w x y z zz\nw x y z"), (9, "p q p q p q p\nq p q p q p\np p q p q p q"),
]


def run(frame):
    return sorted(((r["doc_id"], r["kept_text"]) for r in linededup.dedup_lines(frame).collect()), key=str)


def test_brute_force(spark):
    frame = spark.createDataFrame(CASES, "doc_id long, text string").repartition(3)
    assert run(frame) == sorted(brute(CASES), key=str)


def test_hashes_that_meet_by_chance(spark, monkeypatch):
    """Keys cut to a few bits: most witnesses fail, and no line that has a true one is lost."""
    plain = linededup.deletion_keys
    cut = lambda words: plain(words).withColumn("keys", F.transform("keys", lambda k: k.bitwiseAND(F.lit(7).cast("long"))))
    monkeypatch.setattr(linededup, "deletion_keys", cut)
    rows = [*CASES, (20, "eins zwei drei vier fünf sechs\nganz andere Worte stehen hier"), (21, "eins zwei drei VIER fünf sechs\nganz andere Worte stehen hier jetzt")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert run(frame) == sorted(brute(rows), key=str)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    assert run(edge_docs) == sorted(brute(edge_rows), key=str)
    assert run(no_docs) == []


def test_keys_of_long_lines(spark):
    line = [f"w{i % 97}" for i in range(1500)]
    rows = [(1, " ".join(line)), (2, " ".join(line[:700] + line[701:])), (3, " ".join(line[:64] + ["neu"] + line[65:])), (4, " ".join(line[:64] + ["neu", "neu"] + line[66:]))]
    got = dict(run(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [got[k] == "" for k in (1, 2, 3, 4)] == [False, True, True, True]  # the fourth is one edit from the third


def test_lines_of_one_word(spark):
    """Runs of equal words: their deletions are one variant, found by lines that differ anywhere in them."""
    x = ["x"] * 7
    lines = [x, x[:3] + ["y"] + x[4:], ["y", *x[1:]], x[1:], x[2:], [*x[:6], "y"], ["a", "a", "b", "b", "c", "c"], ["a", "b", "b", "c", "c"], ["a", "a", "q", "b", "c", "c"], ["a", "a", "a", "b", "c", "c"]]
    for order in (lines, lines[::-1], lines[3:] + lines[:3]):
        rows = [(k, " ".join(w)) for k, w in enumerate(order)]
        assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == sorted(brute(rows), key=str)


def test_long_lines_of_one_word(spark):
    """Two lines of a hundred thousand equal words, and one with another word among them, in seconds."""
    n = 100_000
    rows = [(1, "x " * n), (2, "x " * (n - 1)), (3, "x " * 70_000 + "y " + "x " * 29_999), (4, "x " * (n - 3))]
    began = time.monotonic()
    assert [r[1] == "" for r in run(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))] == [False, True, True, False]
    assert time.monotonic() - began < 60


def test_verification(spark):
    pairs = [([1, 2, 3], [1, 2, 3]), ([1, 2, 3], [1, 9, 3]), ([1, 2, 3], [1, 3]), ([1, 3], [1, 2, 3]), ([1, 2, 3], [2, 3, 1]), ([1, 2, 3, 4], [1, 2]), ([1, 2], [3, 4]), ([1], [])]
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, x array<int>, y array<int>")
    got = [r[0] for r in frame.orderBy("i").select(linededup.within_one_edit("x", "y")).collect()]
    assert got == [near(a, b) for a, b in pairs]


def test_stage_keeps_columns(spark, edge_docs):
    out = linededup.line_stage(spark, edge_docs, "")
    assert out.columns == edge_docs.columns
    assert out.where(F.col("text").isNull()).count() == 1
