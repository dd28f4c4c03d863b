import hashlib
import random
import re

import pytest
from text_fixtures import EDGE_TEXTS, by_id, lower

from shiftmetrics.llm import decontaminate as D


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def expected(text, items):
    own, hit, found = words(text), set(), set()
    for i, t in items:
        w = words(t)
        size = min(10, len(w))
        for a in range(len(w) - size + 1 if size else 0):
            for b in range(len(own) - size + 1):
                if own[b:b + size] == w[a:a + size]:
                    hit.update(range(b, b + size))
                    found.add("" if i is None else str(i))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(own), len(hit), len(found), digest, bool(hit)


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def random_case(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["é", "日本", "A1"]
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([0, 1, 2, 3, 5, 9, 10, 11, 14, 30])))) for i in range(12)]
    items += [(3, "repeated id of three"), (None, "an item without an id at all here"), (77, None), (78, "-- ..")]
    texts = EDGE_TEXTS[:8] + [" ".join(r.choices(vocabulary, k=30)) for _ in range(10)]
    for _ in range(40):
        parts = []
        for _ in range(r.randrange(1, 4)):
            parts += r.choices(vocabulary, k=r.randrange(8))
            w = words(r.choice(items)[1])
            a = r.randrange(len(w) + 1)
            parts += w[a:a + r.randrange(1, 16)]
        texts.append(r.choice([" ", "-", ".\n"]).join(parts).title())
    return list(enumerate(texts)), items


@pytest.mark.parametrize("seed, block", [(1, D.BLOCK_BYTES), (2, D.BLOCK_BYTES), (3, 120)])
def test_equals_search_for_every_window(documents, table, monkeypatch, seed, block):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    rows, items = random_case(seed)
    got = by_id(D.digest(D.mark(documents(rows), table(items))))
    for i, t in rows:
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == expected(t, items), (t, items)


def test_drop_keeps_clean_rows_and_columns(clashing, table):
    item = " ".join(f"b{i}" for i in range(25))
    rows = [(1, f"x {item} y"), (2, "clean text"), (2, "clean text"), (3, None), (None, ""), (4, " ".join(item.split()[:9]))]
    df = clashing(rows)
    out = D.drop_contaminated(df, table([(0, item)]))
    assert out.columns == df.columns
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == [2, 2, 3, 4, None]


def test_empty_tables(documents, table):
    assert D.mark(documents([]), table([(1, "a b")])).count() == 0
    r = D.digest(D.mark(documents([(1, "a b c")]), table([]))).first()
    assert (r["n_words"], r["n_hit"], r["contaminated"]) == (3, 0, False)
