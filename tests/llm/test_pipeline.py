import random

import corpus_pipeline
from test_classifiers import hateful, prose
from test_packing import check, reference  # noqa: F401

from shiftmetrics.llm import queries
from shiftmetrics.llm.queries import fit_toxicity


def corpus(spark, written):
    r = random.Random(11)
    item = " ".join(f"bench{i}" for i in range(20))
    rows = []
    for i in range(300):
        rows.append((i, hateful(r) if i % 3 == 0 else prose(r)))
    for i in range(300, 340):
        rows.append((i, prose(r, 9)))
    copies = [(400 + i, rows[300 + i][1] + " tail") for i in range(5)] + [(410, rows[300][1])]
    leaks = [(500 + i, f"{prose(r)} {item} {prose(r)}") for i in range(4)]
    private = [(600 + i, f"Write to a{i}@b.co. {prose(r)}") for i in range(4)]
    rows += copies + leaks + private + [(700, None), (701, "")]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(300)]
    folder = written(rows, labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
                     benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"))
    return folder, dict(rows), item


def test_stages_and_run(spark, written, reference):  # noqa: F811
    folder, texts, item = corpus(spark, written)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "private", "packing"]
    model = fit_toxicity(spark, folder)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    # Plain versions of each decision, on what the stage before kept.
    left = {i for i, t in texts.items() if model.score(t) < 0.7}
    assert set(kept["toxicity"]) == left and sum(i < 300 and i % 3 == 0 for i in left) < 10
    assert sum(300 <= i < 340 for i in left) >= 39
    from test_trie_join import expected
    left = {i for i, (_, root) in expected({i: texts[i] for i in left}).items() if i == root}
    assert set(kept["near_duplicates"]) == left and not {400, 410} & left and {700, 701} <= left
    left = {i for i in left if item not in (texts[i] or "")}
    assert set(kept["decontamination"]) == left and not {500, 501, 502, 503} & left
    assert set(kept["private"]) == left
    for i in left:
        want = texts[i] if i < 600 or i >= 700 else texts[i].replace(f"a{i - 600}@b.co", "[EMAIL]")
        assert kept["private"][i] == want
    rows = corpus_pipeline.run(spark, folder).collect()
    check(rows, kept["private"], reference)


def test_empty_tables_pass_through(spark, written):
    folder = written([], labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
                     benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_queries_are_registered():
    import __spark_entry__

    found = __spark_entry__.queries()
    assert [n for n in found if n in queries.QUERIES] == list(queries.QUERIES)
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)] and "pipeline" in found
