"""Spelling variants: words at one edit from each other, by a relational trie frontier.

The words lie in tries, one for each word length and direction (the words, and
the words reversed).  A trie is a table of edges ``(parent, label, child)``:
nodes are prefixes named by a hash, chains of nodes with one child are one
edge, and the root part that no search enters is left out.

The search is a frontier of states ``(word, node, path, edits)``, joined with the
edges level by level.  A state without an edit goes along an edge whose label
equals the word's next characters; where they first differ by one character
replaced, or one that the label has more, it goes on as a state with an edit,
which from then on follows equal labels only.  A state with an edit that
arrives at a leaf is a pair of words; a pair is found from its shorter word, or
for equal lengths from the smaller one, and then counts for both.

Of two words at one edit, the first or the last half of the searching word is
untouched.  So a search enters a trie at the node of the word's first half, and
the trie of reversed words at that of its last half: the crowded levels near
the root are never searched, whatever the vocabulary.

Paths are spelled out by the labels and looked up among the words at the end,
so hashes of prefixes only steer the search and cannot make a wrong pair.

Defined results: null texts have no words; a null id counts as an empty one in
the checksum; equal rows count each; ties of a form go to the smallest word in
code-point order; an empty table gives no words.  Columns are read by name,
others change nothing.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftmetrics.llm.common import never_sent, write_table
from shiftmetrics.llm.hashing import mix

#: Words of fewer code points, or fewer occurrences, are left out.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form occurs at least so many times as often as its variant.
FORM_RATIO = 10
#: One run in so many loses a code point in the query.
NOISE = 31
#: Distinct words that a task counts before it hands them on.
FLUSH = 100_000
#: Longer words are named by a digest where rows are grouped by word.
LONG_WORD = 64

_RUN = re.compile("[a-zÀ-ÿ]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def noisy(run: str, checksum: int) -> str:
    """The run, without the code point that its checksum names if ``NOISE`` divides it."""
    if checksum % NOISE:
        return run
    k = checksum % len(run)
    return run[:k] + run[k + 1:]


def count_words(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``word, n``: words of enough code points and occurrences in all texts."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text")).where("text is not null")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return made

        for batch in batches:
            for row_id, text in zip(batch.column(0), batch.column(1), strict=True):
                seed = zlib.crc32(f"{row_id.as_py()}:".encode())
                # bytes.lower() changes A-Z only.
                runs = Counter(_RUN.findall(text.as_py().encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                for run, n in runs.items():
                    if len(run) >= LEAST_LENGTH:
                        word = noisy(run, zlib.crc32(run.encode(), seed))
                        if len(word) >= LEAST_LENGTH:
                            total[word] += n
                if len(total) >= FLUSH:
                    yield out()
        yield out()

    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def entries(length: int, back: bool) -> tuple[int, int]:
    """Depths at which the trie of words of ``length`` is entered: by words shorter by one, and by words of that length."""
    return (length // 2, (length + 1) // 2) if back else ((length - 1) // 2, length // 2)


class Prefixes:
    """Hashes of all prefixes of many words: polynomials of the code points, read off running sums."""

    def __init__(self, words: list[str]):
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.arange(len(self.codes)) - np.repeat(self.starts[:-1], self.lengths)
        steps = np.full(int(self.lengths.max(initial=0)) + 1, _BASE, np.uint64)
        steps[0] = 1
        power = np.multiply.accumulate(steps)
        self.sums = np.zeros(len(self.codes) + 1, np.uint64)
        np.cumsum((self.codes.astype(np.uint64) + np.uint64(1)) * power[place], out=self.sums[1:])

    def nodes(self, word: np.ndarray, depth: np.ndarray, length: np.ndarray, back: bool) -> np.ndarray:
        """Names of the nodes at ``depth`` on the paths of words (by index) in the tries of ``length``."""
        at = self.starts[word]
        mixed = mix(self.sums[at + depth] - self.sums[at])
        return mix(mixed ^ (depth.astype(np.uint64) << np.uint64(33)) ^ (length.astype(np.uint64) << np.uint64(1)) ^ np.uint64(back)).view(np.int64)


def _turned(words: list[str], back: bool) -> list[str]:
    return [w[::-1] for w in words] if back else words


def _ranges(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and value of all numbers of the ranges ``first[i]:end[i]``."""
    n = np.maximum(end - first, 0)
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[which]


def _entries(lengths: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
    return (lengths // 2, (lengths + 1) // 2) if back else ((lengths - 1) // 2, lengths // 2)


def _inner_nodes(words: DataFrame) -> DataFrame:
    """``word, back, depth, node, next``: the nodes of each word between its trie's entries and its leaf."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            keys = batch.column(1)
            for back in (False, True):
                p = Prefixes(_turned(own, back))
                which, depth = _ranges(_entries(p.lengths, back)[1] + 1, p.lengths)
                for at in range(0, len(which), 1 << 16):
                    w, d = which[at:at + (1 << 16)], depth[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(w)), pa.array(np.full(len(w), back)), pa.array(d.astype(np.int32)),
                         pa.array(p.nodes(w, d, p.lengths[w], back)), pa.array(p.codes[p.starts[w] + d].astype(np.int32))],
                        ["key", "back", "depth", "node", "next"])

    return words.select("word", "key").mapInArrow(listed, "key string, back boolean, depth int, node long, next int")


def _edges(words: DataFrame) -> DataFrame:
    """``level, parent, label, child`` of each word's path, given the depths of its branching nodes (``ahead``, ``behind``)."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            for back, branching in ((False, batch.column(1).to_pylist()), (True, batch.column(2).to_pylist())):
                turned = _turned(own, back)
                p = Prefixes(turned)
                which, depth, level = [], [], []
                for i, (w, inner) in enumerate(zip(turned, branching, strict=True)):
                    path = sorted({*entries(len(w), back), *(inner or ()), len(w)})
                    which += [i] * len(path)
                    depth += path
                    level += range(len(path))
                which, depth, level = np.array(which, np.int64), np.array(depth, np.int64), np.array(level, np.int32)
                nodes = p.nodes(which, depth, p.lengths[which], back)
                inside = np.flatnonzero(np.diff(which) == 0) if len(which) else np.zeros(0, np.int64)
                labels = [turned[i][a:b] for i, a, b in zip(which[inside].tolist(), depth[inside].tolist(), depth[inside + 1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(level[inside]), pa.array(nodes[inside]), pa.array(labels, pa.string()), pa.array(nodes[inside + 1])],
                    ["level", "parent", "label", "child"])

    return words.mapInArrow(listed, "level int, parent long, label string, child long").distinct()


def _starts(words: DataFrame) -> DataFrame:
    """The first frontier: every word at its two entries of both directions (``longer``: into the trie of longer words)."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            for back in (False, True):
                turned = _turned(own, back)
                p = Prefixes(turned)
                every = np.arange(len(own))
                for longer in (False, True):
                    length = p.lengths + longer
                    depth = _entries(length, back)[0 if longer else 1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(turned, pa.string()), pa.array(np.full(len(own), back)), pa.array(np.full(len(own), longer)),
                         pa.array(p.nodes(every, depth, length, back)), pa.array([w[:d] for w, d in zip(turned, depth.tolist(), strict=True)], pa.string()),
                         pa.array(np.zeros(len(own), np.int32))],
                        ["word", "back", "longer", "node", "path", "edits"])

    return words.select("word").mapInArrow(listed, "word string, back boolean, longer boolean, node long, path string, edits int")


def build_tries(words: DataFrame) -> DataFrame:
    """The edge table of the tries of all words (``words``: word, key)."""
    inner = _inner_nodes(words)
    # A node branches if its words go on differently.
    branching = inner.groupBy("node").agg(F.min("next").alias("a"), F.max("next").alias("b")).where("a <> b").select("node")
    depths = inner.join(never_sent(branching), "node", "left_semi").groupBy("key").agg(
        *[F.collect_set(F.when(F.col("back") == back, F.col("depth"))).alias(name) for name, back in (("ahead", False), ("behind", True))])
    return _edges(words.join(never_sent(depths), "key", "left").select("word", "ahead", "behind"))


def _step(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """The states after one more edge."""
    joined = frontier.join(never_sent(edges), F.col("node") == F.col("parent"))
    longer = F.col("longer").cast("int")
    size, depth = F.length("label"), F.length("path")

    def ahead(less: Column, of: Column) -> Column:
        return F.substring("word", depth + 1 - less, of)

    straight = ahead(longer * F.col("edits"), size) == F.col("label")
    replaced = ~F.col("longer") & (F.levenshtein(ahead(F.lit(0), size), F.col("label"), 1) == 1) & (F.col("label") > ahead(F.lit(0), size))
    inserted = F.col("longer") & (F.levenshtein(ahead(F.lit(0), size - 1), F.col("label"), 1) == 1)
    edits = F.when(straight, F.col("edits")).when((F.col("edits") == 0) & (replaced | inserted), 1)
    return joined.select("word", "back", "longer", F.col("child").alias("node"), F.concat("path", "label").alias("path"),
                         edits.alias("edits")).where("edits is not null")


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, other``: every pair of words at exactly one edit, once (``words``: word, key)."""
    edges = write_table(build_tries(words))
    frontier, found, level = _starts(words), [], 0
    at_leaf = F.length("path") == F.length("word") + F.col("longer").cast("int")
    while True:
        # A trie's second entry is at most one edge below its first.
        here = edges.where(F.col("level").isin(level, level + 1)).select("parent", "label", "child")
        states = write_table(_step(frontier, here))
        found.append(states.where(at_leaf & (F.col("edits") == 1)))
        frontier = states.where(~at_leaf)
        if frontier.isEmpty():
            break
        level += 1
    pairs = reduce(DataFrame.unionByName, found)
    word, other = (F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c)) for c in ("word", "path"))
    pairs = pairs.select(word.alias("word"), other.alias("other"), "back")
    half = F.floor(F.length("word") / 2).cast("int")
    twice = F.col("back") & (F.substring(F.col("word"), F.lit(1), half) == F.substring(F.col("other"), F.lit(1), half))
    return pairs.where(~twice).select("word", "other")


def variants(counts: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of all words (``counts``: word, n)."""
    words = write_table(counts.select("word", "n", F.when(F.length("word") > LONG_WORD, F.sha2("word", 256)).otherwise(F.col("word")).alias("key")))
    pairs = near_pairs(words)
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))
    ns = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    # The most frequent near word; of equals the smallest.
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    near = both.join(never_sent(ns), "other").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = words.select("word", "n").join(never_sent(near), "word", "left")
    is_form = -F.col("best.n") >= FORM_RATIO * F.col("n")
    known = write_table(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.word")).alias("form"),
                                     F.when(is_form, -F.col("best.n")).alias("form_n")))
    roots = follow(known.where("form is not null").select("word", "form"))
    return known.join(never_sent(roots), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def follow(forms: DataFrame) -> DataFrame:
    """``word, root``: the last form from each word on, by doubling the steps (``forms``: word, form).

    Counts grow along forms, so no chain comes back, and each round halves what is left of it.
    """
    links = write_table(forms.select("word", F.col("form").alias("root")))
    while True:
        on = never_sent(links.select(F.col("word").alias("root"), F.col("root").alias("next")))
        if links.join(on, "root", "left_semi").isEmpty():
            return links
        links = write_table(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
