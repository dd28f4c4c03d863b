import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from text_fixtures import EDGE_TEXTS

from shiftmetrics.llm import packing
from shiftmetrics.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t　\xa0'aAéß1٣<|.,"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_ids_equal_the_library(text):
    from tokenizers import Tokenizer

    global _library
    if "_library" not in globals():
        _library = Tokenizer.from_file(tokenizer_path())
        _library.encode_special_tokens = True
    ids = np.frombuffer(packing.tokenizer_for(tokenizer_path()).encode(text), "<u4").tolist()
    assert ids == _library.encode(text, add_special_tokens=False).ids


def test_special_strings_are_ordinary_text(reference):
    text = "a <|endoftext|> b"
    assert np.frombuffer(packing.tokenizer_for(tokenizer_path()).encode(text), "<u4").tolist() == reference(text)[:-1]


@pytest.mark.parametrize("k", [1, 2, 3, 7, 40])
def test_differencing_places_every_piece_nearly_evenly(k):
    r = random.Random(k)
    lengths = np.array([r.randrange(1, 1024) for _ in range(200)])
    window = packing.difference(lengths, k)
    sums = np.bincount(window, lengths, k)
    assert len(window) == 200 and window.min() >= 0 and window.max() < k
    # Near equal: within the largest piece, and far closer where windows hold many pieces.
    assert sums.max() - sums.min() <= (1024 if k == 40 else 64)


def test_differencing_known_cases():
    assert sorted(np.bincount(packing.difference(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])) == [14, 16]
    assert sorted(np.bincount(packing.difference(np.array([5, 5, 5, 5]), 2), [5, 5, 5, 5])) == [10, 10]


def test_window_count_rises_beyond_capacity():
    lengths = np.array([600] * 10)                      # two never fit together
    window = packing.pack(lengths, 1024)
    assert len(set(window.tolist())) == 10


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60))
def test_halving_and_packing_keep_every_token_once(lengths):
    row, first, size, window = packing.spread(np.array(lengths, np.int64), 16)
    seen = {i: [] for i in range(len(lengths))}
    for i, at, n in zip(row.tolist(), first.tolist(), size.tolist()):
        assert n > 0
        seen[i].extend(range(at, at + n))
    assert all(seen[i] == list(range(n)) for i, n in enumerate(lengths))
    assert len(window) == len(size) and (not lengths or np.bincount(window, size).max() <= 16)


@pytest.mark.parametrize("lengths", [
    np.random.default_rng(1).integers(1, 1024, 2000),
    np.minimum(1023, np.random.default_rng(2).lognormal(5.3, 1.0, 2000).astype(int) + 1),
    np.array([600, 40] * 1000),
    np.full(2000, 1023),
])
def test_a_group_pads_little(lengths):
    _, _, size, window = packing.spread(np.asarray(lengths, np.int64))
    assert size.sum() == np.sum(lengths) and np.bincount(window, size).max() <= 1024
    assert 1 - size.sum() / (1024 * (window.max() + 1)) < 0.012


def check(rows, texts, reference):
    """Every id of every row in one piece, sequences gapless and not over 1024; the share of padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in texts.items():
        ids, at = np.array(reference(text), "<u4"), 0
        for r in sorted(by_doc.pop(i), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    used = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 1024
        used += at
    return 1 - used / (1024 * len(by_sequence)) if by_sequence else 0


def test_pieces_of_all_documents(documents, reference):
    r = random.Random(5)
    texts = dict(enumerate(EDGE_TEXTS))
    texts |= {100 + i: " ".join("".join(r.choices("abcdeé", k=r.randrange(1, 9))) for _ in range(r.randrange(900))) for i in range(120)}
    df = documents(list(texts.items()))
    rows = packing.assign(packing.cut(df, tokenizer_path()), df.count()).collect()
    assert check(rows, texts, reference) < 0.02


def test_several_groups(documents, reference, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 5)
    texts = {i: "word " * (37 * i % 400) for i in range(40)}
    df = documents(list(texts.items()))
    check(packing.assign(packing.cut(df, tokenizer_path()), df.count()).collect(), texts, reference)


def test_sequences_hold_the_ids(clashing, reference):
    texts = {i: f"text {i} " * (i * 60) for i in range(12)}
    df = clashing(list(texts.items()))
    placed = packing.assign(packing.cut(df, tokenizer_path(), with_ids=True), df.count(), with_ids=True)
    ids = {r["sequence_id"]: np.frombuffer(r["ids"], "<u2").tolist() for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        want = reference(texts[r["doc_id"]])[r["start"]:r["start"] + r["length"]]
        assert ids[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == want
    assert sum(map(len, ids.values())) == sum(len(reference(t)) for t in texts.values())


def test_repeated_rows_and_empty_table(documents):
    df = documents([(1, "same text"), (1, "same text"), (None, "same text"), (None, None)])
    rows = packing.assign(packing.cut(df, tokenizer_path()), 4).collect()
    assert sum(r["length"] for r in rows) == 3 * rows[0]["doc_tokens"] + 1 or len(rows) == 4
    empty = documents([])
    assert packing.assign(packing.cut(empty, tokenizer_path()), 0).count() == 0


@pytest.fixture(scope="module")
def unmodified():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", " <|endoftext|>  x", "x\n <|endoftext|>\n", "<|endoftext|", "<<|endoftext|>>"]


def test_added_tokens_have_their_ids(unmodified):
    r = random.Random(3)
    parts = ["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "a", "word", "é", "'s", "1"]
    for text in SPECIAL + ["".join(r.choices(parts, k=r.randrange(1, 12))) for _ in range(500)]:
        ids = np.frombuffer(packing.tokenizer_for(tokenizer_path()).ids(text), "<u4").tolist()
        assert ids == unmodified.encode(text, add_special_tokens=False).ids, text


def test_pieces_hold_the_ids_of_added_tokens(documents, unmodified):
    texts = dict(enumerate([*SPECIAL, "many <|endoftext|> words " * 700]))
    rows = packing.assign(packing.cut(documents(list(texts.items())), tokenizer_path()), len(texts)).collect()
    check(rows, texts, lambda text: [*unmodified.encode(text or "", add_special_tokens=False).ids, 0])


def test_a_third_of_all_rows_repeated(documents, reference, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 20)
    df = documents([(7, "the same words " * 20)] * 100 + [(100 + i, f"text {i} " * (i % 90)) for i in range(200)]).repartition(4)
    pieces = packing.cut(df, tokenizer_path())
    rows = packing.assign(pieces, df.count()).collect()
    tokens = len(reference("the same words " * 20))
    same = [r for r in rows if r["doc_id"] == 7]
    assert sum(r["length"] for r in same) == 100 * tokens
    assert len({r["sequence_id"] >> 32 for r in same}) >= 12          # spread over the 15 groups
    filled = {}
    for r in rows:
        filled[r["sequence_id"]] = filled.get(r["sequence_id"], 0) + r["length"]
    assert max(filled.values()) <= 1024


def test_ids_of_many_texts_equal_those_of_each(unmodified):
    import pyarrow as pa

    r = random.Random(4)
    parts = ["<|endoftext|>", "<|endof", " ", "  ", "\n", "a", "word", "é", "'s", "1", " b", "\t", "x y z", "\xa0", "日本"]
    texts = [None, "", " ", "a", *SPECIAL, *EDGE_TEXTS[:7], *("".join(r.choices(parts, k=r.randrange(12))) for _ in range(2000))]
    words = packing.tokenizer_for(tokenizer_path())
    for some in (texts, texts[:1], [], [t for t in texts if t and "\n" not in t and "\t" not in t and "\xa0" not in t]):
        got = [np.frombuffer(x, "<u4").tolist() for x in words.ids_of(pa.array(some, pa.string()))]
        assert got == [unmodified.encode(t or "", add_special_tokens=False).ids for t in some]


def test_each_distinct_word_of_a_batch_is_encoded_once(monkeypatch):
    import pyarrow as pa

    words = packing.tokenizer_for(tokenizer_path())
    seen, encode = [], words._words
    monkeypatch.setattr(words, "_words", lambda some: seen.extend(some) or encode(some))
    texts = [f"once {i % 7} again and again" for i in range(100)]
    assert words.ids_of(pa.array(texts)) == [words.ids(t) for t in texts]
    assert sorted(seen) == sorted({w for t in texts for w in t.split(" ")})


def plain_difference(lengths, k):
    """Sums of the windows after largest differencing, by loops over whole windows; the two partial partitions that were merged
    are the two with the largest spread, the older one first."""
    parts = [(n, i, [n] + [0] * (k - 1)) for i, n in enumerate(lengths)]
    made = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda x: (-x[0], x[1]))
        (_, _, a), (_, _, b), *parts = parts
        sums = sorted((x + y for x, y in zip(a, reversed(b), strict=True)), reverse=True)
        made += 1
        parts.append((sums[0] - sums[-1], made, sums))
    return sorted(parts[0][2])


def test_differencing_equals_plain_loops():
    r = random.Random(6)
    for _ in range(150):
        lengths = [r.randrange(1, r.choice([4, 20, 1024])) for _ in range(r.randrange(1, 40))]
        k = r.randrange(2, len(lengths) + 3)
        window = packing.difference(np.array(lengths), k)
        assert sorted(np.bincount(window, lengths, k).astype(int).tolist()) == plain_difference(lengths, k)
