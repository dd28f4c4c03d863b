"""Document fingerprints: a homomorphic multiset hash of paragraphs.

DataFrame functions only.  Each paragraph (line) is hashed to a wide vector,
and a document's fingerprint is the sum of its paragraphs' vectors modulo
powers of two.  The order of paragraphs does not matter, and a paragraph is
inserted or deleted by adding or subtracting its vector (``combine``).

A paragraph's vector has two parts:

* ``EXACT`` lanes of 32 bits, each its own hash of the whole paragraph: equal
  sums mean equal multisets of paragraphs, but for collisions;
* ``SKETCH`` lanes of 16 bits, in which every run of three words of the
  paragraph adds or subtracts one in one lane: the cosine of two documents'
  lanes estimates how many runs they share.  Long words count as several, so
  that texts without blanks have runs too.

Defined results: a null text counts as empty, and the empty text has one empty
paragraph.  Rows are told apart by id and text, so ids may repeat; rows that
repeat both are one document, returned as often as it occurs.  Rows of one id
follow each other by a hash of their text; a null id comes last.  Other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftmetrics.llm.common import write_table

EXACT, SKETCH = 8, 64
_EXACT_SPACE, _SKETCH_SPACE = 1 << 32, 1 << 16
#: Letters of a word that count as one; in paragraphs of fewer letters than SHORT each letter counts as a word.
WORD, SHORT = 12, 40


def _runs(paragraph: Column) -> Column:
    """Hashes of all runs of three words of a paragraph (shorter ones at its end); one of the
    empty paragraph."""
    short = F.length(paragraph) < SHORT
    words = F.when(short, F.regexp_extract_all(paragraph, F.lit("."), F.lit(0))).otherwise(
        F.regexp_extract_all(paragraph, F.lit(rf"\S{{1,{WORD}}}"), F.lit(0)))

    def hashed(w: Column) -> Column:
        return F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    # Inside the outer function the words are found already, not found again for every run.
    runs = F.element_at(F.transform(F.array(words), hashed), 1)
    return F.when(F.size(runs) > 0, runs).otherwise(F.array(F.xxhash64(F.lit(""))))


def _exact_lane(i: int) -> Column:
    hashed = F.pmod(F.xxhash64(F.lit(i), F.col("_paragraph")), F.lit(_EXACT_SPACE))
    return F.sum(F.when(F.col("_place") == 0, hashed).otherwise(F.lit(0)))


def _sketch_lane(i: int) -> Column:
    hashed = F.col("_run")
    sign = F.when(hashed.bitwiseAND(SKETCH) == 0, F.lit(1)).otherwise(F.lit(-1))
    return F.sum(F.when(hashed.bitwiseAND(SKETCH - 1) == i, sign).otherwise(F.lit(0)))


def lanes(df: DataFrame, text_col: str, keys: list[str], times: str | None = None) -> DataFrame:
    """(keys, ``_lanes``) of every row; ``keys`` tell rows apart, or the one called ``times`` tells
    how many equal rows have equal keys.

    A row's runs lie in the task that holds it, so they are summed before
    anything is shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    paragraphs = df.select(*keys, F.explode(F.split(text, "\n", -1)).alias("_paragraph"))
    runs = paragraphs.select(*keys, "_paragraph", F.posexplode(_runs(F.col("_paragraph"))).alias("_place", "_run"))
    sums = runs.groupBy(*keys).agg(*(_exact_lane(i).alias(f"_e{i}") for i in range(EXACT)),
                                   *(_sketch_lane(i).alias(f"_s{i}") for i in range(SKETCH)))

    def reduced(name: str, space: int) -> Column:
        total = F.expr(f"{name} div {times}") if times else F.col(name)
        return F.pmod(total, F.lit(space)).cast("long")
    both = [reduced(f"_e{i}", _EXACT_SPACE) for i in range(EXACT)] + [reduced(f"_s{i}", _SKETCH_SPACE) for i in range(SKETCH)]
    return sums.select(*keys, F.array(*both).alias("_lanes"))


def combine(one: Column, other: Column, sign: int = 1) -> Column:
    """Lanes of a document with the paragraphs of another inserted (or, with -1, deleted)."""
    def lane(a: Column, b: Column, space: int) -> Column:
        return F.pmod(a + sign * b, F.lit(space))
    first = F.zip_with(F.slice(one, 1, EXACT), F.slice(other, 1, EXACT), lambda a, b: lane(a, b, _EXACT_SPACE))
    rest = F.zip_with(F.slice(one, EXACT + 1, SKETCH), F.slice(other, EXACT + 1, SKETCH), lambda a, b: lane(a, b, _SKETCH_SPACE))
    return F.concat(first, rest)


def text_of(vector: Column) -> Column:
    """A fingerprint's lanes as lowercase hex digits."""
    def digits(x: Column, n: int) -> Column:
        return F.lower(F.lpad(F.hex(x), n, "0"))
    return F.concat(F.array_join(F.transform(F.slice(vector, 1, EXACT), lambda x: digits(x, 8)), ""),
                    F.array_join(F.transform(F.slice(vector, EXACT + 1, SKETCH), lambda x: digits(x, 4)), ""))


def likeness(one: Column, other: Column) -> Column:
    """0 to 1: 1 for equal fingerprints, else the cosine of the sketch lanes (as signed numbers), at least 0."""
    def signed(vector: Column) -> Column:
        half = _SKETCH_SPACE // 2
        return F.transform(F.slice(vector, EXACT + 1, SKETCH),
                           lambda x: F.when(x >= half, x - _SKETCH_SPACE).otherwise(x).cast("double"))

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(signed(a), signed(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    size = F.sqrt(dot(one, one) * dot(other, other))
    cosine = F.when(size > 0, dot(one, other) / size).otherwise(F.lit(0.0))
    return F.when(one == other, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


# --- each document, its edited text and the next document --------------------------------


def successors(ids: DataFrame) -> DataFrame:
    """Rows (``_id``, ``_key``, ...) with ``_next``: the key of the row that follows by descending
    ``_id`` (then ``_key``), the first following the last.  Keys are distinct.

    Ids alone are sorted over the tasks; the row after a task's last is the
    first of the next task that has any.
    """
    order = [F.col("_id").desc_nulls_last(), F.col("_key")]
    dealt = write_table(ids.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
                        .withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy(*order))))
    heads = dealt.where("_place = 1").select("_part", "_key")
    # One row for each task's part: a table as small as the number of parts.
    around = Window.orderBy("_part")
    first = F.first("_key").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("_part", F.coalesce(F.lead("_key").over(around), first).alias("_after"))
    follow = F.lead("_key").over(Window.partitionBy("_part").orderBy("_place"))
    return dealt.withColumn("_follow", follow).join(F.broadcast(heads), "_part").withColumn(
        "_next", F.coalesce("_follow", "_after")).drop("_part", "_place", "_follow", "_after")


def compare(docs: DataFrame, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """Every row's fingerprint, that of its edited text, and their likeness to each other and to the next row's.

    Texts are shuffled once, by a key of id and text, and the beginnings that
    go into edited texts once more.
    """
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(F.col(key).alias("_id"), text.alias("_text")).withColumn(
        "_key", F.concat_ws(":", F.coalesce(F.col("_id").cast("string"), F.lit("null")), F.hex(F.xxhash64("_text"))))
    need = F.floor(F.length("_text") / 3).cast("int")
    pairs = write_table(successors(rows.groupBy("_id", "_key", need.alias("_need")).agg(F.count(F.lit(1)).alias("_times"))))
    texts = rows.select("_key", "_text")
    # The next row gives the start of its text to the row before it: a third of that row's length at most.
    given = pairs.select(F.col("_key").alias("_to"), F.col("_next").alias("_key"), "_need", F.col("_times").alias("_to_times"))
    starts = texts.join(given, "_key").select(
        F.col("_to").alias("_key"), F.col("_to_times").alias("_times"), "_need", F.substring("_text", F.lit(1), F.col("_need")).alias("_start"))
    starts = starts.groupBy("_key", "_times", "_need").agg(F.first("_start").alias("_start"))
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), F.length("_text") - F.col("_need")), "_start")
    both = texts.join(starts, "_key").select("_key", "_times", "_text", edited.alias("_edited")).select(
        "_key", "_times", F.length("_text").cast("long").alias("_n"), F.sha2(F.col("_edited").cast("binary"), 256).alias("_sha"),
        F.posexplode(F.array("_text", "_edited")).alias("_kind", "_both"))
    made = write_table(lanes(both, "_both", ["_key", "_times", "_n", "_sha", "_kind"], "_times"))
    own = made.where("_kind = 0").drop("_kind")
    changed = made.where("_kind = 1").select("_key", F.col("_lanes").alias("_changed"))
    after = own.select(F.col("_key").alias("_next"), F.col("_lanes").alias("_next_lanes"))
    full = own.join(changed, "_key").join(pairs.select("_id", "_key", "_next"), "_key").join(after, "_next")
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("_times").cast("int"))).alias("_again")
    return full.select(
        F.col("_id").alias(key), F.col("_n").alias("n_chars"), F.col("_sha").alias("edited_sha256"),
        text_of(F.col("_lanes")).alias("fingerprint"), text_of(F.col("_changed")).alias("edited_fingerprint"),
        likeness(F.col("_lanes"), F.col("_changed")).alias("near_edited"),
        likeness(F.col("_lanes"), F.col("_next_lanes")).alias("near_next"), repeated).drop("_again")
