"""Benchmark decontamination by a prefix-filtered join of shingle sets.

A benchmark item is a set of windows of ``WINDOW`` consecutive words (an item
of fewer words is one window), a window an ordered set of short shingles.  A
window is contained in a document only if all its shingles are, so the
necessary prefix of the order by rarity is one shingle: the one with the
fewest occurrences in the corpus, counted over all documents.  Documents are
joined on these prefix shingles alone; a match is given up if the item does
not fit at that place (length and position), and is verified word by word to
the longest common run, whose windows are the occurrences.

The benchmark is read in blocks of about ``BLOCK_BYTES``, each sent to the
tasks, and all documents are held against every block: no shuffle of texts,
and no group of documents or of matches is gathered anywhere.

Defined results: null texts, and texts without words, have no words, are no
items and are never hit; repeated documents are judged one by one; items that
share an id count once; a null id counts as an empty one.  Other columns,
whatever their names, pass through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftmetrics.llm.common import cut_lineage, fresh
from shiftmetrics.llm.hashing import ALPHANUMERIC, batches, runs_of, words_of

WINDOW = 10
#: Words of a shingle (windows of fewer words are one shingle).
SHINGLE = 4
#: Text of the benchmark that is sent to the tasks at once.
BLOCK_BYTES = 32_000_000
#: Columns that ``mark`` adds: number of words, bitmap of hit words, ids of items with occurring windows.
ADDED = ("_n_words", "_hit_words", "_hit_items")

_MASK = np.uint64((1 << 20) - 1)


@dataclass
class Block:
    """Items of one block and the shingles they are searched by."""

    ids: list[str]
    words: list[np.ndarray]                    # word hashes of each item
    keys: dict[int, np.ndarray] = field(default_factory=dict)    # shingle width: sorted hashes
    seen: dict[int, np.ndarray] = field(default_factory=dict)    # width: bitmap of the hashes' low bits
    places: dict[int, list[list[tuple[int, int]]]] = field(default_factory=dict)  # width: (item, place) of each hash

    def widths(self) -> set[int]:
        return {min(SHINGLE, len(w)) for w in self.words if len(w)}

    def shingles(self) -> dict[int, np.ndarray]:
        """All distinct shingles of the items by width."""
        out = {}
        for width in self.widths():
            own = [runs_of(w, width) for w in self.words if min(SHINGLE, len(w)) == width]
            out[width] = np.unique(np.concatenate(own))
        return out

    def choose(self, counts: dict[int, Counter]) -> None:
        """Keep, for each window, its rarest shingle (of equals, the smallest hash)."""
        for width in self.widths():
            places: dict[int, set[tuple[int, int]]] = {}
            for item, words in enumerate(self.words):
                if not len(words) or min(SHINGLE, len(words)) != width:
                    continue
                runs = runs_of(words, width).tolist()
                span = min(WINDOW, len(words)) - width + 1
                rank = [(counts[width][h], h, p) for p, h in enumerate(runs)]
                for first in range(len(runs) - span + 1):
                    _, h, p = min(rank[first:first + span])
                    places.setdefault(h, set()).add((item, p))
            order = sorted(places)
            self.keys[width] = np.array(order, np.uint64)
            self.seen[width] = _bitmap(self.keys[width])
            self.places[width] = [sorted(places[h]) for h in order]


def _bitmap(keys: np.ndarray) -> np.ndarray:
    table = np.zeros(int(_MASK) + 1, bool)
    table[keys & _MASK] = True
    return table


def _found(runs: np.ndarray, keys: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``runs`` whose hash is one of ``keys``, and which one."""
    at = np.flatnonzero(seen[runs & _MASK])
    k = np.searchsorted(keys, runs[at])
    k[k == len(keys)] = 0
    same = keys[k] == runs[at] if len(keys) else np.zeros(0, bool)
    return at[same], k[same]


def occurrences(words: np.ndarray, bounds: np.ndarray, block: Block) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, first word, end) of the longest common runs that hold a window; words count over the batch."""
    for width, keys in block.keys.items():
        runs = runs_of(words, width)
        at, which = _found(runs, keys, block.seen[width])
        doc = np.searchsorted(bounds, at, side="right") - 1
        done: dict[tuple[int, int, int], int] = {}
        for q, k, d in zip(at.tolist(), which.tolist(), doc.tolist(), strict=True):
            first, end = int(bounds[d]), int(bounds[d + 1])
            if q + width > end:
                continue
            for item, p in block.places[width][k]:
                own = block.words[item]
                need = min(WINDOW, len(own))
                if end - first < need or done.get((d, item, q - p), -1) > q:
                    continue
                low, high = max(0, p - (q - first)), min(len(own), p + (end - q))
                if high - low < need:
                    continue
                same = own[low:high] == words[q - p + low:q - p + high]
                gaps = np.flatnonzero(~same)
                left = np.searchsorted(gaps, p - low)
                a = low + (int(gaps[left - 1]) + 1 if left else 0)
                b = low + (int(gaps[left]) if left < len(gaps) else len(same))
                done[d, item, q - p] = q - p + b
                if b - a >= need and a <= p < b:
                    yield d, item, q - p + a, q - p + b


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text").where(
        F.col("text").isNotNull())


def _blocks(benchmark: DataFrame) -> Iterator[Block]:
    items = _items(benchmark)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    for i in range(n):
        mine = items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i)
        rows = sorted(map(tuple, mine.distinct().collect()))
        words = [words_of([t.encode("utf-8", "surrogatepass")], ALPHANUMERIC)[0] for _, t in rows]
        yield Block([k for k, _ in rows], words)


def _counts(docs: DataFrame, shingles: dict[int, np.ndarray], text_col: str) -> dict[int, Counter]:
    """Occurrences of the given shingles in all documents."""
    tables = {w: (keys, _bitmap(keys)) for w, keys in shingles.items()}
    sent = docs.sparkSession.sparkContext.broadcast(tables)

    def counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {w: np.zeros(len(keys), np.int64) for w, (keys, _) in sent.value.items()}
        for batch in rows:
            for _, encoded in batches(batch.column(0).to_pylist()):
                words, bounds = words_of(encoded, ALPHANUMERIC)
                for w, (keys, seen) in sent.value.items():
                    at, which = _found(runs_of(words, w), keys, seen)
                    inside = at + w <= bounds[np.searchsorted(bounds, at, side="right")] if len(at) else np.zeros(0, bool)
                    totals[w] += np.bincount(which[inside], minlength=len(keys))
        for w, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), w), pa.int32()), pa.array(some, pa.int64()), pa.array(total[some], pa.int64())],
                ["width", "which", "n"])

    rows = docs.select(text_col).mapInArrow(counted, "width int, which long, n long").groupBy("width", "which").agg(
        F.sum("n").alias("n")).collect()
    counts = {w: Counter() for w in shingles}
    for r in rows:
        counts[r["width"]][int(shingles[r["width"]][r["which"]])] = r["n"]
    return counts


def mark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", added: tuple[str, ...] = ADDED) -> DataFrame:
    """``docs`` with the columns ADDED (or other names for them, where ``docs`` has such columns)."""
    schema = T.StructType([*docs.schema.fields, T.StructField(added[0], T.LongType()),
                           T.StructField(added[1], T.BinaryType()), T.StructField(added[2], T.ArrayType(T.StringType()))])
    texts, out = docs, docs
    for i, block in enumerate(_blocks(benchmark)):
        block.choose(_counts(texts, block.shingles(), text_col))
        if i:
            out = cut_lineage(out)
        out = out.mapInArrow(_marker(docs, block, text_col, bool(i), added), schema)
    return out


def _marker(docs: DataFrame, block: Block, text_col: str, more: bool, added: tuple[str, ...]):
    sent, at, names = docs.sparkSession.sparkContext.broadcast(block), docs.columns.index(text_col), [*docs.columns, *added]
    width = len(docs.columns)

    def marked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            n_words, hit_words, hit_items = [], [], []
            before = batch.columns[width:] if more else None
            for first, encoded in batches(batch.column(at).to_pylist()):
                words, bounds = words_of(encoded, ALPHANUMERIC)
                hit = np.zeros(len(words), bool)
                items: list[set[str]] = [set() for _ in encoded]
                for d, item, a, b in occurrences(words, bounds, sent.value):
                    hit[a:b] = True
                    items[d].add(sent.value.ids[item])
                for d in range(len(encoded)):
                    mask = hit[bounds[d]:bounds[d + 1]]
                    if more:
                        old = np.frombuffer(before[1][first + d].as_py(), np.uint8)
                        mask = mask | np.unpackbits(old, count=len(mask)).astype(bool) if len(old) else mask
                        items[d].update(before[2][first + d].as_py())
                    n_words.append(len(mask))
                    hit_words.append(np.packbits(mask).tobytes() if mask.any() else b"")
                    hit_items.append(sorted(items[d]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(n_words, pa.int64()), pa.array(hit_words, pa.binary()),
                 pa.array(hit_items, pa.list_(pa.string()))], names)

    return marked


def digest(marked: DataFrame) -> DataFrame:
    """Counts and hash of the items that ``mark`` found, one row per document."""
    # Bits of the bitmap, byte by byte.
    n_hit = F.aggregate(F.sequence(F.lit(1), F.length(ADDED[1])), F.lit(0), lambda a, i: a + F.bit_count(
        F.conv(F.hex(F.substring(F.col(ADDED[1]), i, F.lit(1))), 16, 10).cast("int")))
    n_hit = F.when(F.length(ADDED[1]) > 0, n_hit).otherwise(F.lit(0)).cast("long")
    return marked.select(
        "doc_id", F.col(ADDED[0]).alias("n_words"), n_hit.alias("n_hit"), F.size(ADDED[2]).cast("long").alias("n_items"),
        F.sha2(F.array_join(ADDED[2], ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without any hit word."""
    added = tuple(fresh(docs, *ADDED))
    return mark(docs, benchmark, text_col, added).where(F.length(added[1]) == 0).drop(*added)
