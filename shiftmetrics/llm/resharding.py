"""Resharding by minimum-cost flow.

Documents lie in old shards; the new shards have capacities (equal shares of
all bytes unless given).  What leaves which shard for which other is the
cheapest flow from old sizes to new capacities, a byte costing nothing where
it stays and one where it moves (or what ``cost`` says).  The flow is a table
of old times new shards.  It is carried out by whole blocks: the documents of
an old shard are dealt into ``BLOCKS`` blocks by a hash of their text, so that
equal texts stay together.  A block of more than a ``HOT``-th of a new shard is
split by a second hash of the text, and a single text of that size by id, so
that no task numbers a large group.  The parts of such a text still go to one
shard, unless its copies hold more than half a new shard and would unbalance it.

Sizes are summed where the rows lie.  The driver sees one row a block, whose
number is bounded by the parameters.

Defined results: a null text has size 1 and the checksum of nothing; rows that
repeat an id and a text share a block; an empty table gives no rows.  Columns
are read by name, others pass through ``place``, but for ones that are named
like the columns that it adds (``added``), which are replaced.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftmetrics.llm.common import fresh

#: Blocks of an old shard, and part of a new shard beyond which a block is split.
BLOCKS, HOT = 1024, 8


def size_of(text: Column) -> Column:
    """UTF-8 bytes and one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """[i][j] units that go from i to j: all supply, no capacity exceeded, at the least cost.

    Successive cheapest paths from a source through old and new shards to a sink.
    """
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    to, room, price, edges = [], [], [], [[] for _ in range(n + m + 2)]

    def edge(a: int, b: int, units: int, each: int) -> int:
        for x, y, u, c in ((a, b, units, each), (b, a, 0, -each)):
            edges[x].append(len(to))
            to.append(y)
            room.append(u)
            price.append(c)
        return len(to) - 2

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
    between = [[edge(i, n + j, supply[i], cost[i][j]) for j in range(m)] for i in range(n)]
    for j, c in enumerate(capacity):
        edge(n + j, sink, c, 0)
    left = sum(supply)
    while left:
        best, via = [None] * (n + m + 2), [-1] * (n + m + 2)
        best[source], queue, queued = 0, deque([source]), {source}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for e in edges[a]:
                b = to[e]
                if room[e] and (best[b] is None or best[a] + price[e] < best[b]):
                    best[b], via[b] = best[a] + price[e], e
                    if b not in queued:
                        queue.append(b)
                        queued.add(b)
        if best[sink] is None:
            raise ValueError("the new shards cannot hold all documents")
        units, b = left, sink
        while b != source:
            units, b = min(units, room[via[b]]), to[via[b] ^ 1]
        b = sink
        while b != source:
            room[via[b]] -= units
            room[via[b] ^ 1] += units
            b = to[via[b] ^ 1]
        left -= units
    return [[room[e ^ 1] for e in row] for row in between]


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def carry_out(blocks: pd.DataFrame, flow: list[list[int]]) -> list[int]:
    """The new shard of each block (columns ``old``, ``bytes``): from the largest block on, each goes
    where its old shard's flow is furthest from being met."""
    need = [list(row) for row in flow]
    shard = [0] * len(blocks)
    order = blocks.sort_values(["bytes", "old", "bucket", "sub"], ascending=[False, True, True, True]).index
    for k in order:
        row = need[blocks.at[k, "old"]]
        j = max(range(len(row)), key=lambda j: (row[j], -j))
        row[j] -= int(blocks.at[k, "bytes"])
        shard[k] = j
    return shard


#: Columns that ``place`` adds: old shard, size, new shard, place there.
ADDED = ("_old", "_size", "_shard", "_slot")


def place(docs: DataFrame, shards: int, old: Column, old_shards: int, text_col: str = "text", key: str = "doc_id",
          capacities: list[int] | None = None, cost: list[list[int]] | None = None, added: tuple[str, ...] = ADDED) -> DataFrame:
    """``docs`` with the columns ``added``; slots are gapless.  ``old``: the present shard, 0 to ``old_shards`` - 1."""
    spark = docs.sparkSession
    old_c, size_c, shard_c, slot_c = added
    # Named in one step, so that no helper column hides one that ``old`` reads.
    own = [c for c in docs.columns if c not in added]
    hash_c, bucket, sub, parts_c, heavy_c, base_c, place_c = fresh(
        docs, "_hash", "_bucket", "_sub", "_parts", "_heavy", "_base", "_place")
    hashed = F.xxhash64(F.coalesce(text_col, F.lit("")))
    rows = docs.select(*[F.col(f"`{c}`") for c in own], old.cast("int").alias(old_c), size_of(F.col(text_col)).alias(size_c),
                       hashed.alias(hash_c), F.pmod(F.shiftright(hashed, 16), F.lit(BLOCKS)).cast("int").alias(bucket))
    coarse = rows.groupBy(old_c, bucket).agg(F.sum(size_c).alias("bytes")).toPandas()
    total = int(coarse["bytes"].sum())
    limit, half = max(1, total // (shards * HOT)), max(1, total // (shards * 2))

    def small(data: list[tuple], schema: str) -> DataFrame:
        return F.broadcast(spark.createDataFrame(data, schema))

    # Single texts of more than a block's limit (a bounded number), looked for in blocks that are as large.
    large = coarse[coarse["bytes"] > limit]
    large = [(int(o), int(b), int(-(-n // limit))) for o, b, n in large[[old_c, bucket, "bytes"]].itertuples(index=False, name=None)]
    schema = f"{old_c} int, {bucket} int, {parts_c} int"
    found = rows.join(small(large, schema), [old_c, bucket], "left_semi").groupBy(old_c, hash_c).agg(
        F.sum(size_c).alias("bytes")).where(F.col("bytes") > limit).collect() if large else []
    heavy, whole, at = [], [], 0        # whole: the first part of the text that a part belongs to
    for r in sorted(found, key=lambda r: (r[old_c], r[hash_c])):
        n = -(-r["bytes"] // limit)
        heavy.append((r[old_c], r[hash_c], n, at))
        whole += [at] * n if r["bytes"] <= half else range(at, at + n)
        at += n
    rows = rows.join(small(large, schema), [old_c, bucket], "left")
    rows = rows.join(small(heavy, f"{old_c} int, {hash_c} long, {heavy_c} long, {base_c} long"), [old_c, hash_c], "left")
    by_id = -1 - F.col(base_c) - F.pmod(F.xxhash64(key, F.lit("part")), F.col(heavy_c))
    by_text = F.pmod(F.xxhash64(hash_c, F.lit("part")), F.col(parts_c))
    rows = rows.withColumn(sub, F.coalesce(by_id, by_text, F.lit(0)).cast("int")).drop(parts_c, heavy_c, base_c)
    blocks = rows.groupBy(old_c, bucket, sub).agg(F.sum(size_c).alias("bytes"), F.count(F.lit(1)).alias("rows")).toPandas()
    blocks = blocks[[old_c, bucket, sub, "bytes", "rows"]].set_axis(["old", "bucket", "sub", "bytes", "rows"], axis=1)
    blocks = blocks.sort_values(["old", "bucket", "sub"], ignore_index=True)
    supply = [int(blocks.loc[blocks["old"] == i, "bytes"].sum()) for i in range(old_shards)]
    capacities = capacities or equal_capacities(total, shards)
    cost = cost or [[int(i != j) for j in range(shards)] for i in range(old_shards)]
    blocks["unit"] = [s if s >= 0 else -1 - whole[-1 - s] for s in blocks["sub"]]
    units = blocks.groupby(["old", "bucket", "unit"], as_index=False)["bytes"].sum().rename(columns={"unit": "sub"})
    units["shard"] = carry_out(units, min_cost_flow(supply, capacities, cost))
    blocks = blocks.merge(units.rename(columns={"sub": "unit"})[["old", "bucket", "unit", "shard"]], on=["old", "bucket", "unit"], how="left")
    blocks["base"] = blocks.groupby("shard")["rows"].cumsum() - blocks["rows"]
    plan = small([tuple(map(int, x)) for x in blocks[["old", "bucket", "sub", "shard", "base"]].itertuples(index=False, name=None)],
                 f"{old_c} int, {bucket} int, {sub} int, {shard_c} int, {base_c} long")
    in_block = Window.partitionBy(old_c, bucket, sub).orderBy(F.col(f"`{key}`"), size_c, hash_c)
    joined = rows.withColumn(place_c, F.row_number().over(in_block)).join(plan, [old_c, bucket, sub])
    return joined.select(*[F.col(f"`{c}`") for c in own], old_c, size_c, shard_c, (F.col(base_c) + F.col(place_c) - 1).alias(slot_c))


def rewrite(placed: DataFrame, old_dirs: dict[int, str], out_dir: str) -> dict[int, str]:
    """Write the shards that gain or lose documents; the directory of every shard, old or new.

    ``placed``: from ``place``, with all columns to be kept.  Each shard is
    written in the order of its slots, in as many files as tasks write it.
    """
    moved = placed.where("_old <> _shard").select(F.explode(F.array("_old", "_shard")).alias("s")).distinct()
    affected = {r["s"] for r in moved.collect()} | {r["s"] for r in placed.select(F.col("_shard").alias("s")).distinct().collect()
                                                     if r["s"] not in old_dirs}
    dirs = {s: d for s, d in old_dirs.items() if s not in affected}
    keep = [c for c in placed.columns if c not in ("_old", "_size", "_slot", "_shard")]
    rows = placed.where(F.col("_shard").isin(sorted(affected))).repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    rows.select(*keep, F.col("_shard").alias("shard")).write.partitionBy("shard").parquet(out_dir)
    written = {r["s"] for r in placed.select(F.col("_shard").alias("s")).distinct().collect()}
    return dirs | {s: f"{out_dir}/shard={s}" for s in affected if s in written}
