import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F
from text_fixtures import EDGE_TEXTS

from shiftmetrics.llm import resharding as R


def least_cost(supply, capacity, cost):
    """By trying every whole-number flow."""
    n, m = len(supply), len(capacity)
    best = None

    def splits(total, k):
        if k == 1:
            yield (total,)
            return
        for x in range(total + 1):
            for rest in splits(total - x, k - 1):
                yield (x, *rest)
    for rows in itertools.product(*(list(splits(s, m)) for s in supply)):
        if all(sum(r[j] for r in rows) <= capacity[j] for j in range(m)):
            c = sum(rows[i][j] * cost[i][j] for i in range(n) for j in range(m))
            best = c if best is None else min(best, c)
    return best


@pytest.mark.parametrize("seed", range(25))
def test_flow_is_the_cheapest(seed):
    r = random.Random(seed)
    supply = [r.randrange(5) for _ in range(3)]
    capacity = [r.randrange(6) for _ in range(3)]
    cost = [[r.randrange(4) for _ in range(3)] for _ in range(3)]
    want = least_cost(supply, capacity, cost)
    if want is None:
        with pytest.raises(ValueError):
            R.min_cost_flow(supply, capacity, cost)
        return
    flow = R.min_cost_flow(supply, capacity, cost)
    assert [sum(x) for x in flow] == supply
    assert all(sum(x[j] for x in flow) <= capacity[j] for j in range(3))
    assert sum(flow[i][j] * cost[i][j] for i in range(3) for j in range(3)) == want


def test_equal_shards_move_only_the_surplus():
    flow = R.min_cost_flow([30, 10, 20], R.equal_capacities(60, 4), [[int(i != j) for j in range(4)] for i in range(3)])
    assert [flow[i][i] for i in range(3)] == [15, 10, 15]


def placed(df, shards=4, old_shards=3, **more):
    old = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(old_shards))
    return R.place(df, shards, old, old_shards, **more)


def test_law_slots_and_groups(documents):
    r = random.Random(1)
    texts = EDGE_TEXTS[:7] + ["".join(r.choices("abé ", k=r.randrange(1, 400))) for _ in range(1500)]
    rows = list(enumerate(texts + r.choices(texts, k=500)))
    out = placed(documents(rows)).collect()
    assert len(out) == len(rows)
    size, slots, groups = {}, {}, {}
    for x in out:
        assert x["_size"] == len((x["text"] or "").encode()) + 1
        size[x["_shard"]] = size.get(x["_shard"], 0) + x["_size"]
        slots.setdefault(x["_shard"], []).append(x["_slot"])
        groups.setdefault(x["text"] or "", set()).add(x["_shard"])
    assert sorted(size) == [0, 1, 2, 3] and max(size.values()) <= 1.02 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())


def test_little_more_than_the_surplus_moves(documents):
    r = random.Random(2)
    out = placed(documents([(i, "".join(r.choices("abc", k=50))) for i in range(3000)]), 4, 3).collect()
    moved = sum(x["_size"] for x in out if x["_old"] != x["_shard"])
    assert moved <= 1.1 * sum(x["_size"] for x in out) / 4


def test_one_text_of_a_third_of_all_rows_is_split(documents):
    rows = [(i, "the same text") for i in range(1000)] + [(1000 + i, f"text {i}" * 2) for i in range(2000)]
    out = placed(documents(rows)).collect()
    size = {}
    for x in out:
        size[x["_shard"]] = size.get(x["_shard"], 0) + x["_size"]
    assert max(size.values()) <= 1.1 * min(size.values())


def test_groups_of_equal_texts_stay_together(documents):
    # 20 texts of equal weight on 8 shards: none is too large, so none is split.
    out = placed(documents([(i, f"text {i % 20:02d}" * 9) for i in range(60)]), 8, 6).collect()
    groups = {}
    for x in out:
        groups.setdefault(x["text"], set()).add(x["_shard"])
    assert len(groups) == 20 and all(len(s) == 1 for s in groups.values())


def test_any_names_of_other_columns(documents):
    df = documents([(i, f"text {i % 9}") for i in range(40)])
    names = ["_bucket", "_sub", "_parts", "_place", "_base", "_hash", "_heavy", "bytes", "rows"]
    for c in names:
        df = df.withColumn(c, F.lit("mine"))
    for r in placed(df).collect():
        assert all(r[c] == "mine" for c in names)
    for c in R.ADDED:
        df = df.withColumn(c, F.lit("replaced"))
    assert all(r["_size"] == 7 for r in placed(df).collect())
    kept = placed(df, added=("o", "s", "h", "l"))
    assert all(r["_old"] == "replaced" and r["s"] == 7 for r in kept.collect())


def test_rewrite_touches_affected_shards_only(spark, documents, tmp_path):
    df = documents([(i, f"text {i}") for i in range(400)])
    # Shards 0 and 1 are as large as they may become; 2 gives half to the new shard 3.
    old = F.when(F.col("doc_id") < 100, 0).when(F.col("doc_id") < 200, 1).otherwise(2)
    total = df.agg(F.sum(F.length("text") + 1)).first()[0]
    sizes = [df.where(old == i).agg(F.sum(F.length("text") + 1)).first()[0] for i in range(3)]
    out = R.place(df, 4, old, 3, capacities=[sizes[0], sizes[1], total // 4, total])
    dirs = {}
    for i in range(3):
        dirs[i] = f"{tmp_path}/old/{i}"
        df.where(old == i).write.parquet(dirs[i])
    new = R.rewrite(out, dirs, f"{tmp_path}/new")
    assert new[0] == dirs[0] and new[1] == dirs[1] and new[2] != dirs[2] and sorted(new) == [0, 1, 2, 3]
    ids = [r["doc_id"] for d in new.values() for r in spark.read.parquet(d).collect()]
    assert sorted(ids) == list(range(400))


def test_nulls_repeats_clashes_and_empty_table(clashing, documents):
    df = clashing([(1, "a"), (1, "a"), (None, None), (None, "b"), (2, "")])
    out = placed(df)
    assert set(df.columns) < set(out.columns) and out.count() == 5
    assert placed(documents([])).count() == 0


def test_query_columns(spark, written):
    from shiftmetrics.llm.queries import op8_resharding

    texts = {1: "é", 2: None, 3: "", 4: "plain"}
    rows = {r["doc_id"]: r for r in op8_resharding(spark, written(list(texts.items()))).collect()}
    for i, t in texts.items():
        data = (t or "").encode()
        assert (rows[i]["size"], rows[i]["text_crc32"], rows[i]["law"], rows[i]["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "bytes", None)
