import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from text_fixtures import EDGE_TEXTS, lower

from shiftmetrics.llm import spelling as S


def counts(rows):
    """By one plain loop over texts."""
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(words):
    """All pairs held against each other."""
    near = defaultdict(list)
    for a in words:
        for b in words:
            if abs(len(a) - len(b)) < 2 and a != b and one_edit(a, b):
                near[a].append(b)
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= 10 * n:
                form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return out


def found(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def variants(spark, words):
    return found(S.variants(spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)))


def test_edges_of_texts(documents, clashing):
    r = random.Random(3)
    stems = ["".join(r.choices("abcdeé", k=r.randrange(6, 11))) for _ in range(40)]
    rows = [(i, " ".join(r.choice(stems) + r.choice(["", "", "s", "É", "ing"]) for _ in range(60))) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(EDGE_TEXTS)] + [(200, rows[0][1]), (200, rows[0][1]), (None, rows[1][1])]
    rows += [(300, "×÷Àßþÿ× " * 3), (301, "ABCDEFG abcdefg ÀBCDEFG àbcdefg 1abcdefg2 abcdef-gh")]
    rows += [(302 + i, "x" * 100_000 + " " + "x" * 50_000 + "y" + "x" * 49_999) for i in range(2)]
    words = counts(rows)
    assert any(len(w) == 100_000 for w in words)
    for build in (documents, clashing):
        df = S.count_words(build(rows))
        assert {r["word"]: r["n"] for r in df.collect()} == words
        assert found(S.variants(df)) == expected(words)


def test_the_noise_takes_the_named_code_point(documents):
    i = next(i for i in range(10_000) if zlib.crc32(f"{i}:planted-".removesuffix("-").encode()) % 31 == 0)
    h = zlib.crc32(f"{i}:planted".encode())
    assert S.noisy("planted", h) == "planted"[:h % 7] + "planted"[h % 7 + 1:]
    assert S.count_words(documents([(i, "planted planted")])).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_near_words_by_all_pairs(spark, seed):
    # Small alphabets and shared beginnings: runs of equal letters, shifts, dense tries.
    r = random.Random(seed)
    letters = ["ab", "aab", "abc", "aé\U0001F600"][seed % 4]
    words = {}
    while len(words) < 150:
        w = "".join(r.choices(letters, k=r.randrange(7, 12)))
        words.setdefault(w, r.choice([2, 3, 25, 40, 40, 700, 9000]))
    assert variants(spark, words) == expected(words)


def test_chains_ties_and_roots(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20_000, "aabbbbb": 200_000, "zzzzzzz": 5}
    got = {w: (form, root) for w, form, root, *_ in variants(spark, words)}
    assert got["aaaaaaa"] == ("aaaaaab", "aabbbbb") and got["aabbbbb"] == (None, "aabbbbb") and got["zzzzzzz"] == (None, "zzzzzzz")
    ties = {"mmmmmmm": 2, "mmmmmmz": 30, "mmmmmmb": 30, "mmmmmmmm": 30}
    assert {r[0]: r[1] for r in variants(spark, ties)}["mmmmmmm"] == "mmmmmmb"
    assert variants(spark, ties) == expected(ties)


def test_prefixes_one_after_another_and_long_words(spark):
    # A chain of words, each the beginning of the next, and two long words that differ late.
    words = {"k" * n: 2 + n for n in range(7, 30)} | {"q" * 3000 + "a" + "q" * 10: 2, "q" * 3000 + "b" + "q" * 10: 90, "q" * 3010: 3}
    assert variants(spark, words) == expected(words)


def test_empty_table(documents):
    df = S.variants(S.count_words(documents([])))
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"] and df.collect() == []


def test_a_word_that_holds_a_third_of_all_runs(documents):
    rows = [(i, "pervasive " * 40 + " ".join(f"worda{chr(97 + i % 26)}{chr(97 + k)}" for k in range(26))) for i in range(120)]
    words = counts(rows)
    df = S.count_words(documents(rows, 8))
    assert {r["word"]: r["n"] for r in df.collect()} == words
    assert found(S.variants(df)) == expected(words)


def test_counts_do_not_depend_on_flushes(documents, monkeypatch):
    rows = [(i, f"number{'abcdefghij'[i % 10]} number{'klmnopqrst'[i % 7]}") for i in range(50)]
    monkeypatch.setattr(S, "FLUSH", 3)
    assert {r["word"]: r["n"] for r in S.count_words(documents(rows).repartition(F.col("doc_id"))).collect()} == counts(rows)


def test_no_join_collects_a_table_in_the_driver(spark, monkeypatch):
    """Written words are small as files and large in memory: whatever Spark takes their size for, they are shuffled."""
    plans, frame, written, is_empty = [], type(spark.range(0)), S.write_table, type(spark.range(0)).isEmpty

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(S, "write_table", lambda df: written(seen(df)))
    monkeypatch.setattr(frame, "isEmpty", lambda df: is_empty(seen(df)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        words = {"abcdefg": 1000, "abcdefh": 50, "abcdefhi": 3, "zzzzzzz": 2}
        rows = seen(S.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
        assert found(rows) == expected(words)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(p.count("SortMergeJoin") for p in plans) >= 7
    assert not [p for p in plans if "Broadcast" in p]
