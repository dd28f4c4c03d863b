"""Packing documents into fixed token windows by Karmarkar-Karp differencing.

A document is its token ids and one end id.  It is cut into full windows and
one remainder; a full window is a sequence of its own.  Remainders are dealt
by a hash into groups of about ``GROUP_PIECES``; some of them (one in three, or
more where that pads too much) are halved again and again, down to pieces of a
few tokens, which even out what the others leave.  Each group is packed by multiway differencing: every piece starts
as a partial partition over k windows, and the two partial partitions with the
largest spread are merged, the fullest windows of one with the emptiest of the
other, until one is left.  Its windows are nearly equal.  Whenever one of them
exceeds the window size, k rises.

A source or a group of copies that holds many rows is spread over all groups: a
piece's hash is that of its document's id, its place, and the document's number
among those of its task, so repeated rows part as well.

Defined results: a null text counts as empty and gives one piece with the end
id alone; repeated rows are packed one by one; an empty table gives no rows.
Only the key and text columns are read.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import pairwise
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
#: Pieces that are packed together (bound of a task's work, not of the result).
GROUP_PIECES = 2000
#: Remainders are halved down to pieces of less than twice so many tokens.
LEAST_PIECE = 4
#: One remainder in so many is halved; the next share is tried while windows exceed the least number by more than ``SPARE``.
CUT_EVERY, SPARE = (3, 2, 1), 0.01
END_ID = 0
#: Words whose ids a Python worker remembers.
CACHE_WORDS = 400_000


class Memo(dict):
    """Ids of words after a blank, at most ``CACHE_WORDS`` of them."""

    def __init__(self, plain: Callable[[str], bytes]):
        super().__init__()
        self._plain = plain

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        ids = self[word] = self._plain(" " + word)
        return ids


class WordTokenizer:
    """Ids of texts by a byte-level BPE vocabulary file of the ``tokenizers`` library.

    Such a tokenizer never joins a blank's successor with what precedes the
    blank, so a text's ids are those of its blank-separated words, each with
    its leading blank; words are looked up in a bounded memo.  A text with
    blanks beside other white space is encoded whole, as there the rule for
    runs of white space looks across a blank.

    ``encode`` takes all of a text as ordinary; ``ids`` does what the library
    does by default: added tokens of the file have their own ids, and the text
    between them is encoded part by part.
    """

    # A blank with white space on both sides (or at the end behind white space): the next letter, the rarer case, is looked at first.
    _apart = re.compile(r" (?=\s|$)(?<=\s\s)")

    def __init__(self, path: str):
        import tiktoken

        spec = json.load(open(path, encoding="utf-8"))
        to_byte = {c: b for b, c in enumerate(_byte_letters())}
        special = {t["content"] for t in spec.get("added_tokens", ()) if t.get("special")}
        ranks = {bytes(to_byte[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
        # Fixed value: the pre-tokenizing pattern of this kind of file ("ByteLevel" with use_regex).
        pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self._encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes_of = np.zeros(1 + max(ranks.values()), np.int64)
        self._bytes_of[list(ranks.values())] = [*map(len, ranks)]
        self._memo = Memo(self._plain)
        added = spec.get("added_tokens", ())
        if spec.get("normalizer") or any(t.get(x) for t in added for x in ("lstrip", "rstrip", "single_word")):
            raise ValueError(f"{path}: added tokens that take in blanks or need whole words, and normalizers, are not supported")
        self._added = {t["content"]: np.uint32(t["id"]).astype("<u4").tobytes() for t in added}
        # The longest of those that begin at a place, as in the library.
        self._split = re.compile("|".join(map(re.escape, sorted(self._added, key=len, reverse=True)))) if self._added else None

    def ids(self, text: str) -> bytes:
        """Ids as the library gives them by default, as little-endian unsigned 32-bit integers."""
        if self._split is None or not self._split.search(text):
            return self.encode(text)
        out, at = [], 0
        for m in self._split.finditer(text):
            out += (self.encode(text[at:m.start()]) if m.start() > at else b"", self._added[m[0]])
            at = m.end()
        return b"".join([*out, self.encode(text[at:]) if at < len(text) else b""])

    def ids_of(self, texts: pa.Array) -> list[bytes]:
        """``ids`` of all texts (null: empty); each distinct word of them is encoded once."""
        values = [t or "" for t in texts.to_pylist()]
        whole = [self._whole(t) or bool(self._split and self._split.search(t)) for t in values]
        plain = [t for t, w in zip(values, whole, strict=True) if not w]
        if not plain:
            return [self.ids(t) for t in values]
        words = pc.split_pattern(pa.array(plain, pa.string()), " ")
        first = words.offsets.to_numpy()
        known = words.values.dictionary_encode()
        # A text's first word has no blank before it, so it has its own entry behind those of the distinct words.
        which = known.indices.to_numpy().astype(np.int64)
        which[first[:-1]] = len(known.dictionary) + np.arange(len(plain))
        pool, long = self._words(known.dictionary.to_pylist())
        firsts = [self._plain(t[:t.find(" ")] if " " in t else t) for t in plain]
        pool = np.concatenate([pool, np.frombuffer(b"".join(firsts), "<u4")])
        long = np.concatenate([long, np.fromiter(map(len, firsts), np.int64, len(firsts)) // 4])
        own, at = long[which], np.concatenate([[0], np.cumsum(long)])[which]
        ends = np.concatenate([[0], np.cumsum(own)])
        at = np.repeat(at - ends[:-1], own) + np.arange(ends[-1])
        ids, bounds = pool[at], ends[first]
        split = (ids[a:b].tobytes() for a, b in pairwise(bounds.tolist()))
        return [self.ids(t) if w else next(split) for t, w in zip(values, whole, strict=True)]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words after a blank, one word after another, and how many each has."""
        joined = " " + " ".join(words)
        if not words or self._apart.search(joined):
            found = [*map(self._memo.__getitem__, words)]
            return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
        # As one text: no id reaches over a blank, so a word's ids end where its bytes do.
        ids = self._encoding.encode_to_numpy(joined, disallowed_special=()).astype("<u4")
        ends = np.cumsum(1 + pc.binary_length(pa.array(words, pa.string())).to_numpy())
        return ids, np.diff(np.searchsorted(np.cumsum(self._bytes_of[ids]), ends, side="right"), prepend=0)

    def _whole(self, text: str) -> bool:
        """Whether a text is encoded whole."""
        return text[:1].isspace() or self._apart.search(text) is not None

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self._whole(text):
            return self._plain(text)
        first, *rest = text.split(" ")
        return b"".join([self._plain(first), *map(self._memo.__getitem__, rest)])

    def forget(self) -> None:
        """Give the memo's memory back (workers live on, and serve other operators too)."""
        self._memo.clear()

    def _plain(self, text: str) -> bytes:
        ids = self._encoding.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabulary files: printable bytes
    stand for themselves, the others are numbered from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def vocabulary_size(path: str) -> int:
    """One more than the largest id of a vocabulary file."""
    spec = json.load(open(path, encoding="utf-8"))
    return 1 + max(max(spec["model"]["vocab"].values()), *(t["id"] for t in spec.get("added_tokens", ())), 0)


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer_for(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def _merged(a: list[int], at: list[int], b: list[int], bt: list[int], k: int, n: int, left: list[int],
            right: list[int]) -> tuple[list[int], list[int]]:
    """Two partial partitions as one: the fullest windows of one with the emptiest of the other."""
    shared = max(len(a) + len(b) - k, 0)
    apart = len(a) - shared
    sums, nodes = a[:apart], at[:apart]
    if shared:
        b, bt = b[::-1], bt[::-1]
        left += at[apart:]
        right += bt[:shared]
        sums += map(add, a[apart:], b)
        nodes += range(n + 1 + len(left) - shared, n + 1 + len(left))
    sums += b[shared:]
    nodes += bt[shared:]
    order = sorted(range(len(sums)), key=sums.__getitem__)
    return [sums[i] for i in order], [nodes[i] for i in order]


def difference(lengths: np.ndarray, k: int) -> np.ndarray:
    """The window (0 to k - 1) of each piece, by largest differencing over k windows."""
    if k == 1 or not len(lengths):
        return np.zeros(len(lengths), np.int64)
    n = len(lengths)
    left, right = [], []                  # inner nodes: two merged windows; leaves are 1..n, 0 is empty
    # Partial partitions keep their non-empty windows only, fullest first (sums are negative); the rest are empty.
    heap = [(-length, i, [-length], [i + 1]) for i, length in enumerate(lengths.tolist())]
    heapq.heapify(heap)
    count = n
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, b, bt = heapq.heappop(heap)
        if len(b) == 1:
            # One piece: a window of its own, or on top of the emptiest one.
            (own,), (node,) = b, bt
            if len(sums) == k:
                own += sums.pop()
                left.append(nodes.pop())
                right.append(node)
                node = n + len(left)
            at = bisect_right(sums, own)
            sums.insert(at, own)
            nodes.insert(at, node)
        else:
            sums, nodes = _merged(sums, nodes, b, bt, k, n, left, right)
        low = sums[-1] if len(sums) == k else 0
        count += 1
        heapq.heappush(heap, (sums[0] - low, count, sums, nodes))
    _, _, _, nodes = heap[0]
    window = np.zeros(n, np.int64)
    for w, node in enumerate(nodes):
        stack = [node]
        while stack:
            x = stack.pop()
            if x > n:
                stack += (left[x - n - 1], right[x - n - 1])
            elif x:
                window[x - 1] = w
    return window


def pack(lengths: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """The window of each piece (none longer than ``size``); windows are nearly equal, and none exceeds ``size``.

    Starts from as few windows as hold all tokens; their number rises whenever one exceeds ``size``.
    """
    if not len(lengths):
        return np.zeros(0, np.int64)
    k, step = -(-int(lengths.sum()) // size), 1
    while True:
        window = difference(lengths, k)
        if k >= len(lengths) or np.bincount(window, lengths, k).max() <= size:
            return window
        k, step = min(k + step, len(lengths)), 2 * step


def halved(lengths: np.ndarray, every: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(remainder, its first token, tokens) of all pieces, with one remainder in ``every`` halved."""
    row, first, size = [], [], []
    for i, n in enumerate(lengths.tolist()):
        at = 0
        while i % every == 0 and n >= 2 * LEAST_PIECE:
            half = n - n // 2
            row.append(i)
            first.append(at)
            size.append(half)
            at, n = at + half, n - half
        row.append(i)
        first.append(at)
        size.append(n)
    return np.array(row, np.int64), np.array(first, np.int64), np.array(size, np.int64)


def spread(lengths: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(remainder, its first token, tokens, window) of the pieces of a group's remainders."""
    least = -(-int(lengths.sum()) // size)
    for every in CUT_EVERY:
        row, first, own = halved(lengths, every)
        window = pack(own, size)
        if not len(window) or window.max() + 1 <= least * (1 + SPARE) + 1:
            break
    return row, first, own, window


def cut(docs: DataFrame, tokenizer: str, window: int = WINDOW, text_col: str = "text", key: str = "doc_id",
        with_ids: bool = False) -> DataFrame:
    """Full windows and remainders of all documents.

    ``ids`` holds the ids as little-endian integers of ``id_bytes`` bytes; full
    windows keep theirs only if ``with_ids``.  ``number`` counts the documents of a task.
    """
    key_type = docs.schema[key].dataType.simpleString()
    narrow = vocabulary_size(tokenizer) <= 1 << 16
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "ids", "number"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer_for(tokenizer)
        end, step, before = np.uint32(END_ID).tobytes(), 4 * window, 0
        for batch in batches:
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for i, data in enumerate(words.ids_of(batch.column(1))):
                data += end
                for at in range(0, len(data), step):
                    piece = data[at:at + step]
                    row.append(i)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(len(data) // 4)
                    if with_ids or len(piece) < step:
                        ids.append(np.frombuffer(piece, "<u4").astype("<u2").tobytes() if narrow else piece)
                    else:
                        ids.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())),
                 *(pa.array(x, pa.int64()) for x in (start, length, crc, total)), pa.array(ids, pa.binary()),
                 pa.array([before + i for i in row], pa.int64())], names)
            before += batch.num_rows
        words.forget()

    out = docs.select(key, text_col).mapInArrow(
        pieces, f"`{key}` {key_type}, start long, length long, ids_crc32 long, doc_tokens long, ids binary, number long")
    return out.withColumn("id_bytes", F.lit(2 if narrow else 4))


def assign(pieces: DataFrame, documents: int, window: int = WINDOW, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Final pieces with ``sequence_id`` (unique in the result) and gapless ``offset``.

    ``documents``: how many documents were cut; it sets the number of groups.
    """
    groups = max(1, -(-documents // GROUP_PIECES))
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    types = f"`{key}` {pieces.schema[key].dataType.simpleString()}, start long, length long, ids_crc32 long, " \
        "doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids

    def packed(group_key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([key, "start", "ids_crc32"], ignore_index=True)
        size = int(rows["id_bytes"].iat[0])
        lengths = rows["length"].to_numpy()
        full = np.flatnonzero(lengths == window)
        rest = np.flatnonzero(lengths != window)
        row, first, own, at = spread(lengths[rest], window)
        placed = list(zip(rest[row].tolist(), first.tolist(), own.tolist(), at.tolist(), strict=True))
        first_full = max((w for *_, w in placed), default=-1) + 1
        placed += [(int(i), 0, window, first_full + j) for j, i in enumerate(full)]
        placed.sort(key=lambda x: (x[3], x[0], x[1]))
        keys, starts, crcs, totals, ids = (rows[c].tolist() for c in (key, "start", "ids_crc32", "doc_tokens", "ids"))
        whole, base = lengths.tolist(), int(group_key[0]) << 32
        out, at, before = [], 0, -1
        for i, first, n, w in placed:
            at = at if w == before else 0
            data = ids[i]
            if n < whole[i]:
                data = data[first * size:(first + n) * size]
                crc = zlib.crc32(np.frombuffer(data, f"<u{size}").astype("<u4").tobytes())
            else:
                crc = crcs[i]
            out.append((keys[i], starts[i] + first, n, crc, totals[i], base + w, at, *([data] if with_ids else [])))
            at, before = at + n, w
        return pd.DataFrame(out, columns=names)

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(key, "start", "length", "ids_crc32", "number"), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(packed, types)


def sequences(assigned: DataFrame) -> DataFrame:
    """The ids of every sequence (little-endian, at most ``window``), from pieces assigned ``with_ids``."""
    inner = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(inner, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return assigned.groupBy("sequence_id").agg(joined.alias("ids"))
