import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftmetrics.llm import chat_format as C

NASTY = ["\\### Assistant: </turn> ok", "\\", "\\\\", "#", "####", "</turn>\n", "### user\nhi</turn>\n", "<image>", "\\<", "a\\\nb", "é😀\x00\u2028"]


def digests(rows):
    """By plain grouping and joining."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        said = [t[5] for t in turns if t[3] == "assistant"]
        out[conv] = (len(turns), hashlib.sha256("".join(f"{t[3]}\n{t[5]}\n" for t in turns).encode()).hexdigest(),
                     len("".join(said)), hashlib.sha256("".join(said).encode()).hexdigest())
    return out


def frame(spark, rows, partitions=3):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(partitions)


def found(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def table(seed=1):
    r = random.Random(seed)
    texts = NASTY + [None, "", "word " * 5000, "see ![a cat](x/cat.png) and ![](s.mp3)![d](d.pdf) end", "![no](x.exe) ![broken](a b.png)"]
    rows = [(i // 4, i % 4, r.choice(["user", "assistant", "system"]), r.choice(texts)) for i in range(300)]
    rows += [(None, 0, "user", "no id"), (3, None, None, "no turn"), (3, None, "assistant", "no turn #"), (5, 1, "assistant", "tie"),
             (5, 1, "assistant", "tie"), (6, 2, "line\nend#</turn>\\", "odd role")]
    return rows


def test_digests_read_back_from_the_output(spark):
    rows = table()
    df = C.read_back(C.format_turns(C.in_order(C.with_probe(frame(spark, rows)))))
    assert found(df) == digests(rows + [(-7, 0, "user", C.PROBE), (-7, 1, "assistant", C.PROBE)])
    chars = {r["conv_id"]: r["formatted_chars"] for r in df.collect()}
    whole = {r["conv_id"]: r for r in C.assemble(C.format_turns(frame(spark, rows))).collect()}
    assert all(chars[k] == len(r["formatted"]) for k, r in whole.items())


def test_whole_conversations(spark):
    rows = table(2)
    want = digests(rows)
    for r in C.assemble(C.format_turns(frame(spark, rows))).collect():
        text, records = r["formatted"], []
        for a in r["attachments"]:
            assert text[a["at"]:].startswith(f"<{a['kind']}>") and a["tokens"] > 0
        for t in C.format_turns(frame(spark, [x for x in rows if x[0] == r["conv_id"]])).orderBy("turn", "role", "text").collect():
            records += [a.asDict() for a in t["attachments"]]
        turns = C.read_conversation(text, records)
        assert len(turns) == want[r["conv_id"]][0]
        assert hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest() == want[r["conv_id"]][1]
        masked = [text[s["start"]:s["end"]] for s in r["loss_spans"]]
        plain = [t for role, t in turns if role == "assistant" and t]
        assert len(masked) == len(plain) and all("</turn>" not in m.replace("\\<", "") for m in masked)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="\\#<>/turn\n a!ég", max_size=12), st.text(alphabet="\\#<>/turnimage\n !()[].pé", max_size=40)), max_size=4))
def test_round_trip_of_any_text(turns):
    made = [C.format_turn(role, C.parts_of(text)) for role, text in turns]
    assert C.read_conversation("".join(m[0] for m in made), [a for m in made for a in m[3]]) == turns
    for (role, text), (piece, first, end, attachments) in zip(turns, made, strict=True):
        assert C.read_turn(piece, attachments) == (role, text)
        assert (first < end) == (role == "assistant" and text != "")


def test_typed_parts(spark):
    parts = [{"kind": "text", "text": "look #1 "}, {"kind": "image", "text": "cat", "ref": "c.png", "width": 29, "height": 28},
             {"kind": "audio", "ref": "s.wav", "seconds": 1.01}, {"kind": "document", "ref": "d.pdf", "pages": 3}, {"kind": "text", "text": "end"}]
    fields = ("kind", "text", "ref", "width", "height", "seconds", "pages")
    rows = [(1, 0, "assistant", [tuple(p.get(f) for f in fields) for p in parts])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {C.PARTS_SCHEMA}")
    t = C.format_turns(df, parts_col="parts").first()
    assert t["piece"] == "### assistant\nlook \\#1 <image><audio><document>end</turn>\n"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in t["attachments"]] == [("image", "c.png", 2), ("audio", "s.wav", 26), ("document", "d.pdf", 1536)]
    assert t["expanded_tokens"] == 2 + 26 + 1536
    assert C.read_turn(t["piece"], [a.asDict() for a in t["attachments"]])[1] == "look #1 ![cat](c.png)![](s.wav)![](d.pdf)end"
    with pytest.raises(ValueError):
        C.Flattener().visit(C.Part("video"))


def test_empty_table_and_long_conversation(spark):
    assert C.read_back(C.format_turns(C.in_order(frame(spark, [])))).collect() == []
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} <#") for i in range(25_000)] + [(i, 0, "user", "x") for i in range(2, 50)]
    assert found(C.read_back(C.format_turns(C.in_order(frame(spark, rows, 6))))) == digests(rows)


def test_clashing_columns(spark):
    rows = table(3)
    df = frame(spark, rows)
    for name in ("piece", "loss_start", "attachments", "parts", "n_turns"):
        df = df.selectExpr("*", f"'x' as {name}")
    assert found(C.read_back(C.format_turns(C.in_order(C.with_probe(df))))) == digests(
        rows + [(-7, 0, "user", C.PROBE), (-7, 1, "assistant", C.PROBE)])
