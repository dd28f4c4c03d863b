import random

import numpy as np
import pytest
from text_fixtures import EDGE_TEXTS, by_id, fold

from shiftmetrics.llm import quality, toxicity
from shiftmetrics.llm.common import labelled_sample
from shiftmetrics.llm.queries import op1_quality, op5_toxicity


def prose(r, lines=6):
    return "\n".join(" ".join("".join(r.choices("abcdefghij", k=r.randrange(2, 9))) for _ in range(r.randrange(4, 14))).capitalize() + "."
                     for _ in range(r.randrange(1, lines)))


def junk(r):
    kind, words = r.randrange(3), [("".join(r.choices("abcdefghij", k=4))) for _ in range(20)]
    line = " ".join(w + "%%%" for w in words) if kind == 0 else " ".join([words[0]] * 30) if kind == 1 else " | ".join(words)
    return prose(r, 3) + "\n" + line + "\n" + line


def hateful(r):
    words = prose(r).split(" ")
    for _ in range(3 + len(words) // 15):
        words.insert(r.randrange(len(words)), r.choice(["grobulous", "snarfweed", "plonkhead"]) + r.choice(["", "er", "ish"]))
    return " ".join(words)


def auc(pairs):
    a, b = (np.array([s for s, y in pairs if y == v]) for v in (1, 0))
    return float((a[:, None] > b).mean() + (a[:, None] == b).mean() / 2)


@pytest.fixture
def tables(spark, written):
    def build(make, label):
        r = random.Random(9)
        rows = [(i, make(r) if i % 3 == 0 else prose(r)) for i in range(700)] + [(2000 + i, t) for i, t in enumerate(EDGE_TEXTS)]
        marks = [(i, int((i % 3 == 0) == (label == "toxic")) if label == "toxic" else int(i % 3 != 0)) for i in range(700)]
        labels = [(i, y, y) for i, y in marks] + [(5000, 1, 1), (None, 0, 0), (1, None, None)]
        return written(rows, labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int")), dict(rows), dict(marks)
    return build


@pytest.mark.parametrize("query, make, label, threshold", [(op1_quality, junk, "quality", 0.5), (op5_toxicity, hateful, "toxic", 0.7)])
def test_held_out_accuracy_and_columns(spark, tables, query, make, label, threshold):
    folder, texts, marks = tables(make, label)
    got = by_id(query(spark, folder))
    assert set(got) == set(texts)
    for i, r in got.items():
        assert r["held_out"] == (fold(i, 3) == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
    held = [(got[i]["score"], y) for i, y in marks.items() if got[i]["held_out"]]
    assert auc(held) > 0.97
    assert np.mean([(s >= threshold) == y for s, y in held]) > 0.93


def test_labels_of_held_out_rows_are_not_read(spark, tables):
    folder, texts, marks = tables(hateful, "toxic")
    sample = labelled_sample(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"), "toxic", 10_000)
    assert len(sample) == sum(fold(i, 3) != 1 for i in marks)
    few = labelled_sample(spark.read.parquet(f"{folder}/documents.parquet").repartition(7), spark.read.parquet(f"{folder}/labels.parquet"), "toxic", 20)
    assert len(few) == 40 and sum(y for _, y in few) == 20
    assert few == labelled_sample(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"), "toxic", 20)


@pytest.mark.parametrize("op", [quality, toxicity])
def test_one_class_nulls_repeats_clashes_and_empty_table(clashing, documents, op):
    model = op.fit([("good text", 1)])
    out = op.score(clashing([(1, "x y"), (1, "x y"), (None, None), (2, "")]), model).collect()
    assert len(out) == 4 and len({r["score"] for r in out if r["doc_id"] == 1}) == 1
    assert op.score(documents([]), model).count() == 0


def brute_marginals(u, start, step):
    """P(bad) of each line by summing over all label sequences."""
    n = len(u)
    weight = np.zeros((n, 2))
    for code in range(2 ** n):
        y = [(code >> t) & 1 for t in range(n)]
        s = start[y[0]] + sum(u[t] * y[t] for t in range(n)) + sum(step[y[t - 1], y[t]] for t in range(1, n))
        for t in range(n):
            weight[t, y[t]] += np.exp(s)
    return weight[:, 1] / weight.sum(axis=1)


def test_forward_backward_equals_all_sequences():
    r = np.random.default_rng(0)
    f, k = len(quality.FEATURES), quality.BINS
    model = quality.Model(np.sort(r.random((f, k - 1)), axis=1), r.normal(size=(f, k)), r.normal(size=(f, k)), r.normal(size=(f, k)),
                          r.normal(size=2), r.normal(size=(2, 2)), np.zeros(3), 0.5)
    texts = ["one line", "", "a\nb b\n\nccc ccc!\nDDD", "x y z\nx y z", None]
    c = model.chains(texts)
    bad, pairs = model.marginals(c)
    u = model.unary(c)
    want = [brute_marginals(u[a:a + n], model.start, model.step) for a, n in zip(c.first, c.count, strict=True) if n]
    assert np.allclose(bad, np.concatenate(want))
    assert pairs.sum() == pytest.approx((~c.is_first).sum())


def test_a_line_is_judged_by_its_neighbours():
    r = random.Random(2)
    model = quality.fit([(prose(r), 1) for _ in range(150)] + [(junk(r), 0) for _ in range(150)])
    between = "a%%% b%%% c%%%\nplain words here\na%%% b%%% d%%%"
    alone = "Some words.\nplain words here\nOther words."
    bad = [model.marginals(model.chains([t]))[0][1] for t in (between, alone)]
    assert bad[0] > bad[1]


def test_label_model_finds_accuracies_and_correlations():
    r = np.random.default_rng(1)
    y = r.random(4000) < 0.3
    def voter(hit, false):
        return np.where(y, r.random(4000) < hit, r.random(4000) < false).astype(int)
    good, weak, other = voter(0.9, 0.02), voter(0.5, 0.3), voter(0.8, 0.05)
    votes = np.stack([good, weak, other, voter(0.7, 0.1), weak, weak], axis=1)
    model = toxicity.fit_label_model(votes, 0.3, np.clip(votes.mean(axis=1), 0.05, 0.95))
    p = np.exp(model.log_p[:, :, 2])
    assert abs(p[0, 1] - 0.9) < 0.06 and abs(p[0, 0] - 0.02) < 0.05
    assert model.weight[1] < 0.6 < model.weight[0]           # thrice the same voter
    assert np.mean((model.posterior(votes) > 0.5) == y) > 0.93


def test_lexicon_entries_need_many_surroundings():
    r = random.Random(4)
    copied = "grobulous copied text of one page"
    sample = [(prose(r) + " " + copied, 1) for _ in range(60)] + [(hateful(r), 1) for _ in range(60)] + [(prose(r), 0) for _ in range(120)]
    lexicon = toxicity.mine(sample)
    assert lexicon.entry("plonkheadish") and lexicon.entry("page") is None


def test_filter_keeps_rows_and_columns(clashing):
    r = random.Random(6)
    model = toxicity.fit([(hateful(r), 1) for _ in range(200)] + [(prose(r), 0) for _ in range(200)])
    clean, bad = prose(r), hateful(r)
    df = clashing([(1, clean), (2, bad), (3, None), (3, None), (4, "")])
    out = toxicity.keep_clean(df, model)
    assert out.columns == df.columns and sorted(x["doc_id"] for x in out.collect()) == [1, 3, 3, 4]


def test_sample_reads_one_text_of_a_repeated_id(spark, documents):
    docs = documents([(0, "b")] * 50 + [(0, "a"), (0, None), (2, "c"), (3, None)])
    labels = spark.createDataFrame([(0, 1)] * 30 + [(2, 0), (3, 0)], "doc_id long, toxic int")
    want = sorted(("a" if i == 0 else t or "", y) for i, t, y in [(0, "a", 1), (2, "c", 0), (3, None, 0)] if fold(i, 3) != 1)
    assert sorted(labelled_sample(docs, labels, "toxic", 2)) == want
