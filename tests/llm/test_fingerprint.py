import hashlib
import random

from pyspark.sql import functions as F
from text_fixtures import EDGE_TEXTS

from shiftmetrics.llm import fingerprint as P


def successor(rows):
    """Distinct (id, text) by descending id, null last, each with the next text."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    return {a: b[1] for a, b in zip(order, order[1:] + order[:1])}


def test_edited_texts_and_fingerprints(documents):
    r = random.Random(3)
    texts = [t or "" for t in EDGE_TEXTS[:8]] + ["\n".join(" ".join("".join(r.choices("abcé", k=5)) for _ in range(r.randrange(12)))
                                                           for _ in range(r.randrange(1, 9))) for _ in range(60)]
    rows = [(7 * i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[10]) for i in range(3)] + [(None, "without id")]
    out = P.compare(documents(rows, 4)).collect()
    following, text_of = successor(rows), dict(rows)
    assert sorted((x["doc_id"] for x in out), key=str) == sorted((i for i, _ in rows), key=str)
    prints = {}
    for x in out:
        t = text_of[x["doc_id"]]
        k = len(t) // 3
        edited = t[:len(t) - k] + following[x["doc_id"], t][:k]
        assert x["n_chars"] == len(t) and x["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for text, mark in ((t, x["fingerprint"]), (edited, x["edited_fingerprint"])):
            assert prints.setdefault(text, mark) == mark
        assert 0 <= x["near_edited"] <= 1 and 0 <= x["near_next"] <= 1
        assert (x["fingerprint"] == x["edited_fingerprint"]) <= (x["near_edited"] == 1)
    # Different multisets of lines, different fingerprints.
    assert len(set(prints.values())) == len({tuple(sorted(t.split("\n"))) for t in prints})
    long = [x for x in out if x["n_chars"] > 150 and x["doc_id"] is not None and x["doc_id"] < 1000]
    assert sum(x["near_edited"] > x["near_next"] for x in long) >= 0.95 * len(long)


def lanes_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    return {r["k"]: r["_lanes"] for r in P.lanes(df, "text", ["k"]).collect()}


def test_order_does_not_matter_but_counts_do(spark):
    got = lanes_of(spark, ["a b c\nd e\nf", "f\na b c\nd e", "a b c\nd e", "a b c\nd e\nf\nf", "a b\nc d e\nf"])
    assert got[0] == got[1] and len({tuple(v) for v in got.values()}) == 4


def test_paragraphs_are_inserted_and_deleted(spark):
    one, two = "first line of words here\nsecond line", "third one\nsecond line"
    got = lanes_of(spark, [one, two, f"{one}\n{two}"])
    df = spark.createDataFrame([(got[0], got[1], got[2])], "a array<long>, b array<long>, c array<long>")
    row = df.select(P.combine(F.col("a"), F.col("b")).alias("plus"), P.combine(F.col("c"), F.col("b"), -1).alias("minus")).first()
    assert row["plus"] == got[2] and row["minus"] == got[0]


def test_likeness_of_equal_similar_and_unrelated(spark):
    r = random.Random(1)
    words = ["".join(r.choices("abcdefgh", k=6)) for _ in range(400)]
    got = lanes_of(spark, [" ".join(words[:200]), " ".join(words[:150] + words[200:250]), " ".join(words[200:])])
    df = spark.createDataFrame([(got[0], got[1], got[2])], "a array<long>, b array<long>, c array<long>")
    same, near, far = df.select(P.likeness(F.col("a"), F.col("a")), P.likeness(F.col("a"), F.col("b")), P.likeness(F.col("a"), F.col("c"))).first()
    assert same == 1 and near > 0.5 and far < 0.4


def test_repeats_clashes_one_row_and_empty_table(clashing, documents):
    out = P.compare(clashing([(1, "a b c d e f"), (1, "a b c d e f"), (1, "other text"), (0, None)])).collect()
    assert sorted(x["doc_id"] for x in out) == [0, 1, 1, 1] and len({x["fingerprint"] for x in out}) == 3
    only = P.compare(documents([(4, "abcdef")])).first()
    assert only["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and only["near_next"] == 1
    assert P.compare(documents([])).count() == 0


def test_no_python_in_the_plan(documents):
    plan = P.compare(documents([(1, "a b"), (2, "c d")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
