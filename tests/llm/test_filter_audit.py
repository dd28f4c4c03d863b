import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest
from text_fixtures import CLASHING, EDGE_TEXTS

from shiftmetrics.llm import filter_audit as A


def failing(rows):
    """The failed letters of each (doc_id, text), by plain rules."""
    least = {}
    for i, t in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t in rows:
        t = t or ""
        words = re.findall("[^\x20\x09-\x0D]+", t)
        bad = set()
        if len(words) < 200:
            bad.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            bad.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            bad.add("C")
        if set(t) & set("#$%&*|"):
            bad.add("D")
        if i is not None and least[t] < i:
            bad.add("E")
        out.append(bad)
    return out


def expected(rows, sources, labels):
    """Every order replayed row by row."""
    good, toxic = ({i for i, *ys in labels if ys[k] == 1 and i is not None} for k in (0, 1))
    parts = defaultdict(list)
    for (i, _), source, bad in zip(rows, sources, failing(rows), strict=True):
        parts[source or ""].append((i, bad))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = docs
            for k, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), k] = (
                    len(left), len(gone), sum(f in b for _, b in docs) - len(gone), sum(b == {f} for _, b in docs),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), f)
        for key in [x for x in out if x[0] == part]:
            out[key] = (*out[key][:6], shapley[out[key][6]])
    return out


def found(df):
    return {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"],
                                                        r["toxic_lost"], r["shapley"]) for r in df.collect()}


def tables(spark, rows, sources, labels, clash=False):
    docs = spark.createDataFrame([(i, t, s) for (i, t), s in zip(rows, sources, strict=True)], "doc_id long, text string, source string")
    if clash:
        names = CLASHING + ", failed int, digest string, id long, least long, good int, toxic int, coalition int, total long"
        for c in names.split(", "):
            name, kind = c.split(" ")
            docs = docs.selectExpr("*", f"cast(null as {kind}) as {name}")
    return docs.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("seed", range(2))
def test_against_replayed_orders(spark, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Big", "ALL", "cost$", "5%", "a|b"]
    texts = [None, "", " \n"] + EDGE_TEXTS[4:]
    texts += [" ".join(r.choices(words[:r.choice([40, 150, 400, 405])], k=r.choice([3, 199, 200, 260, 400]))) for _ in range(40)]
    rows = [(i, r.choice(texts)) for i in range(160)] + [(5, texts[-1]), (5, texts[-1]), (None, texts[-1]), (None, None), (-4, texts[-2])]
    sources = [r.choice([None, "", "a", "a", "b"]) for _ in rows]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 200, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    want = expected(rows, sources, labels)
    assert len(want) == len(set(x or "" for x in sources)) * 600
    for clash in (False, True):
        assert found(A.audit(*tables(spark, rows, sources, labels, clash))) == want


def test_a_third_of_the_rows_are_copies_in_many_parts(spark):
    rows = [(i, "same copy") for i in range(100)] + [(1000 + i, f"text {i}") for i in range(200)]
    sources = [f"s{i % 7}" for i in range(300)]
    assert found(A.audit(*tables(spark, rows, sources, []))) == expected(rows, sources, [])


def test_empty_tables(spark):
    assert A.audit(*tables(spark, [], [], [])).collect() == []


@pytest.mark.parametrize("n", (2, 3, 5))
def test_weights_are_the_classic_ones(n):
    # |s|! (n - |s| - 1)! / n! with the sign of membership.
    for i, row in enumerate(A.shapley_weights(n)):
        for s, w in enumerate(row):
            size = s.bit_count()
            if s >> i & 1:
                want = Fraction(factorial(size - 1) * factorial(n - size), factorial(n))
            else:
                want = -Fraction(factorial(size) * factorial(n - size - 1), factorial(n))
            if s:   # the empty coalition removes nothing
                assert w == want


def test_solve_is_exact():
    r = random.Random(2)
    m = [[Fraction(r.randrange(-9, 9)) for _ in range(4)] for _ in range(4)]
    m[0][0] = Fraction(0)
    x = [[Fraction(r.randrange(-9, 9), 7)] for _ in range(4)]
    right = [[sum(a * b[0] for a, b in zip(row, x, strict=True))] for row in m]
    assert A.solve(m, right) == x
