"""Interaction audit of row filters: what each removes alone, together and in every order.

Every document gets one bit a filter (set: it fails).  The documents of a part
are then tabulated for all coalitions of filters (for five filters 32): how
many a coalition removes.  All else follows from these tables:

* a filter's step after the filters ``p`` removes ``v(p + i) - v(p)``;
* its Shapley value is the solution of the least squares fit
  ``v(s) ~ sum of phi(i) over i in s`` over all proper coalitions, weighted by
  the Shapley kernel and constrained to ``sum of phi = v(all)`` (efficiency).
  The normal equations with their Lagrange multiplier are solved once, in
  rationals, as a matrix over coalitions (``shapley_weights``); its products
  with the tables are whole numbers after scaling by the number of orders.

Texts are never shuffled: rows travel as (part, text digest, bits, id), equal
ones summed before.  A group of equal texts is one row per part and label, so
that a large group of copies is neither gathered nor joined row by row.

Defined results: a null text is empty, a null or empty part is the part "";
rows that repeat an id count one by one; an id's label is 1 if any of its
label rows says so; a row without id fails "same as a smaller id" never and
makes no other fail; an empty table gives no parts.  Columns are read by name,
so others, whatever their names, change nothing.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: White space between words, as a class of regular expressions.
BLANKS = r"[\x20\x09-\x0D]+"
LETTERS = "ABCDE"
COPIES = "E"


def text_failures(text: Column, min_words: int = 200, distinct_percent: int = 50, capitals_percent: int = 2) -> dict[str, Column]:
    """The failure conditions that a text alone decides, by letter."""
    words = F.array_remove(F.split(text, BLANKS), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": F.size(words) < min_words,
        "B": 100 * F.size(F.array_distinct(words)) < distinct_percent * F.size(words),
        "C": 100 * capitals > capitals_percent * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def marked(docs: DataFrame, labels: DataFrame, text_col: str = "text", part_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """Documents by ``part, failed, good, toxic`` (``failed``: the bits of the filters that they fail) with their number ``n``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(id_col).alias("id"), text.alias("text"))
    bits = sum((F.when(fails, bit(k)).otherwise(0) for k, fails in text_failures(F.col("text")).items()), F.lit(0))
    rows = rows.select("part", "id", F.sha2("text", 256).alias("digest"), bits.cast("int").alias("failed"))
    rows = rows.groupBy("part", "digest", "failed", "id").agg(F.count(F.lit(1)).alias("n"))
    said = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        *[F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(y) for c, y in (("quality", "good"), ("toxic", "toxic"))])
    rows = rows.join(said, "id", "left").fillna({"good": 0, "toxic": 0})
    # One row for the copies of a text in a part: all, those of its smallest id, and those without id.
    copies = rows.groupBy("digest", "part", "failed", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("n_least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    copies = copies.withColumn("first", F.min("least").over(Window.partitionBy("digest")))
    stays = F.col("n_null") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    copies = copies.select("part", "failed", "good", "toxic", F.explode(F.array(
        F.struct(F.lit(0).alias("copy"), stays.alias("n")),
        F.struct(F.lit(bit(COPIES)).alias("copy"), (F.col("n") - stays).alias("n")))).alias("c"))
    failed = F.col("failed").bitwiseOR(F.col("c.copy"))
    return copies.groupBy("part", failed.alias("failed"), "good", "toxic").agg(F.sum("c.n").alias("n")).where("n > 0")


def coalition_tables(counts: DataFrame) -> DataFrame:
    """One row a part: ``total`` and, indexed by coalition, how many documents, good and toxic ones it removes."""
    n_coalitions = 1 << len(LETTERS)
    rows = counts.select("part", "failed", "n", (F.col("n") * F.col("good")).alias("good"), (F.col("n") * F.col("toxic")).alias("toxic"),
                         F.explode(F.sequence(F.lit(0), F.lit(n_coalitions - 1))).alias("coalition"))
    hit = F.col("failed").bitwiseAND(F.col("coalition")) != 0
    taken = rows.groupBy("part", "coalition").agg(
        F.sum("n").alias("total"), *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")])
    table = taken.groupBy("part").agg(F.max("total").alias("total"), F.sort_array(F.collect_list(
        F.struct("coalition", "n", "good", "toxic"))).alias("t"))
    return table.select("part", "total", F.col("t.n").alias("removed"), F.col("t.good").alias("good"), F.col("t.toxic").alias("toxic"))


def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X of ``matrix X = right`` by elimination in rationals."""
    n = len(matrix)
    rows = [list(a) + list(b) for a, b in zip(matrix, right, strict=True)]
    for k in range(n):
        pivot = next(i for i in range(k, n) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(n):
            if i != k and rows[i][k]:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k], strict=True)]
    return [r[n:] for r in rows]


def shapley_weights(n: int) -> list[list[Fraction]]:
    """[i][s]: the weight of the removals of coalition ``s`` in the Shapley value of filter ``i``.

    The fit's normal equations ``X'KX phi + lambda = X'K v`` with ``sum of phi =
    v(all)``; X has a row for each proper coalition, K is the Shapley kernel
    ``(n - 1) / (C(n, |s|) |s| (n - |s|))``.  Solved for every unit vector ``v``.
    """
    everyone = (1 << n) - 1
    proper = range(1, everyone)
    kernel = {s: Fraction(n - 1, comb(n, size) * size * (n - size)) for s in proper for size in [s.bit_count()]}
    has = lambda s, i: s >> i & 1
    normal = [[sum((kernel[s] for s in proper if has(s, i) and has(s, j)), Fraction(0)) for j in range(n)] + [Fraction(1)] for i in range(n)]
    normal.append([Fraction(1)] * n + [Fraction(0)])
    right = [[kernel[s] if s in kernel and has(s, i) else Fraction(0) for s in range(everyone + 1)] for i in range(n)]
    right.append([Fraction(int(s == everyone)) for s in range(everyone + 1)])
    return solve(normal, right)[:n]


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part, order of the filters and step of that order."""
    table = coalition_tables(marked(docs, labels, **columns))
    n = len(LETTERS)
    orders = factorial(n)
    values = []
    for weights in shapley_weights(n):
        scaled = [w * orders for w in weights]
        if any(w.denominator != 1 for w in scaled):
            raise ArithmeticError("the scaled weights are not whole")
        values.append(sum((F.lit(int(w)) * F.col("removed")[s] for s, w in enumerate(scaled) if w), F.lit(0)).cast("long"))
    steps, everyone = [], (1 << n) - 1
    for order in permutations(LETTERS):
        before = 0
        for k, letter in enumerate(order, 1):
            steps.append(("".join(order), k, LETTERS.index(letter), bit(letter), before))
            before |= bit(letter)
    # A table of n! * n rows, fixed by the number of filters, beside each part's row.
    fixed = F.from_json(F.lit("[" + ",".join(f'{{"o":"{o}","k":{k},"i":{i},"b":{b},"p":{p}}}' for o, k, i, b, p in steps) + "]"),
                        "array<struct<o:string,k:int,i:int,b:int,p:int>>")
    rows = table.select("part", "total", "removed", "good", "toxic", F.array(*values).alias("values"), F.explode(fixed).alias("s"))
    own, after = F.col("s.b"), F.col("s.b").bitwiseOR(F.col("s.p"))

    def step(name: str) -> Column:
        return F.col(name)[after] - F.col(name)[F.col("s.p")]

    return rows.select(
        "part", F.col("s.o").alias("filter_order"), F.col("s.k").alias("step"),
        (F.col("total") - F.col("removed")[after]).alias("kept"), step("removed").alias("removed"),
        (F.col("removed")[own] - step("removed")).alias("redundant"),
        (F.col("removed")[everyone] - F.col("removed")[F.lit(everyone).bitwiseXOR(own)]).alias("unique_fails"),
        step("good").alias("good_lost"), step("toxic").alias("toxic_lost"), F.col("values")[F.col("s.i")].alias("shapley"))


#: The query's result in DuckDB SQL: failures row by row, then every order replayed.
ORACLE_SQL = r"""
with base as (
  select coalesce(source, '') as part, doc_id, coalesce(text, '') as text from documents),
judged as (
  select part, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
         min(doc_id) over (partition by text) as least from base),
bits as (
  select part, doc_id,
         (len(words) < 200)::int + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::int
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::int
         + 8 * regexp_matches(text, '[#$%&*|]')::int + 16 * coalesce(doc_id > least, false)::int as failed
  from judged),
said as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
counts as (
  select part, failed, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from bits left join said using (doc_id) group by part, failed),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f, unnest([1, 2, 4, 8, 16]) as b),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order, [a.b, b.b, c.b, d.b, e.b] as bs
  from letters a, letters b, letters c, letters d, letters e
  where a.b + b.b + c.b + d.b + e.b = 31 and len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5),
steps as (
  select filter_order, k as step, bs[k] as own, list_sum(bs[1:k])::int - bs[k] as before
  from orders, range(1, 6) t(k)),
replayed as (
  select part, filter_order, step, own,
         sum(case when failed & (before | own) = 0 then n else 0 end) as kept,
         sum(case when failed & before = 0 and failed & own <> 0 then n else 0 end) as removed,
         sum(case when failed & before <> 0 and failed & own <> 0 then n else 0 end) as redundant,
         sum(case when failed = own then n else 0 end) as unique_fails,
         sum(case when failed & before = 0 and failed & own <> 0 then good else 0 end) as good_lost,
         sum(case when failed & before = 0 and failed & own <> 0 then toxic else 0 end) as toxic_lost
  from counts, steps group by part, filter_order, step, own)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       sum(removed) over (partition by part, own)::bigint as shapley
from replayed
"""
