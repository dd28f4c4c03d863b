"""Columns of the input that are named like helper columns of the operators pass through as they are."""

from pyspark.sql import functions as F

from shiftmetrics.llm import decontaminate, pii, trie_join

NAMES = ["_spans", "_masked", "_n_words", "_hit_words", "_hit_items", "_gone", "_stays", "_first", "_least"]


def test_stages_leave_columns_alone(spark, documents):
    item = " ".join(f"bench{i}" for i in range(12))
    rows = [(1, "write to a@b.co please"), (2, f"see {item} here"), (3, "one two three four five six"), (4, "one two three four five six"),
            (None, None)]
    df = documents(rows)
    for c in NAMES:
        df = df.withColumn(c, F.lit(f"mine {c}"))
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = pii.mask(decontaminate.drop_contaminated(trie_join.keep_one(df, trie_join.link(documents(rows))), benchmark))
    assert out.columns == df.columns
    found = {r["doc_id"]: r for r in out.collect()}
    assert set(found) == {1, 3, None} and found[1]["text"] == "write to [EMAIL] please"
    assert all(r[c] == f"mine {c}" for r in found.values() for c in NAMES)
