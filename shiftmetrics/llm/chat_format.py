r"""Chat formatting of typed content parts.

A turn's content is a list of parts: text, or an image, a sound or a document
by reference.  A visitor walks the parts of a turn and flattens them into one
string: text is escaped, every other part leaves a placeholder in its place and
a record of what stood there (reference, alternative text, how many tokens the
placeholder expands to).  A turn becomes

    ### <role>
    <content></turn>

Control strings are built from ``#`` and ``<``; in texts and roles these, and
the escape character itself, are preceded by ``\``, in roles line ends too.  So
an unescaped ``#`` or ``<`` is always the template's, and a text that spells a
control string is read back as it was.  The loss mask covers the contents of
the turns of ``LEARNED_ROLES``, each without its end mark.

A turn is formatted where its row lies.  Reading back goes through the turns of
a conversation in order, with a running digest: no conversation is ever held
whole, however many turns it has.

Defined results: a null text is empty, a null role is an empty one, a null
conversation id is one conversation; turns that share a number follow each
other by role and text, null numbers come first; an empty table gives no rows.
Columns are read by name, others change nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEARNED_ROLES = ("assistant",)
#: Kinds of attachments by the end of their reference.
KINDS = {
    "image": ("png", "jpg", "jpeg", "gif", "webp"),
    "audio": ("mp3", "wav", "flac", "ogg"),
    "document": ("pdf", "docx", "pptx", "xlsx"),
}
#: Parameters of the expansion: side of an image patch, sound tokens a second, tokens a page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 512
#: Sizes that are taken where a part tells none.
USUAL = {"width": 448, "height": 448, "seconds": 10.0, "pages": 1}

#: Content parts of a turn, as a column of the general interface.
PARTS_SCHEMA = ("array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>")
ATTACHMENTS_SCHEMA = "array<struct<kind:string,ref:string,alt:string,source:string,at:long,tokens:long>>"
TURN_SCHEMA = (f"conv_id long, turn long, role string, text string, piece string, loss_start long, loss_end long, "
               f"attachments {ATTACHMENTS_SCHEMA}, expanded_tokens long")

_ENDS = {end: kind for kind, ends in KINDS.items() for end in ends}
#: An attachment inside a plain text: ``![alternative text](reference)`` with a known end.
MARKUP = re.compile(r"!\[([^\]\n]*)\]\(([^()\s]+\.(" + "|".join(_ENDS) + r"))\)")
_ESCAPED = re.compile(r"\\(.)", re.S)
_PIECE = re.compile(r"### ((?:[^\\\n]++|\\.)*+)\n((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)
_PLACEHOLDER = re.compile(r"(?:[^\\<]++|\\.)++|<(\w+)>", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("<", "\\<")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class Part:
    kind: str
    text: str = ""             # the text, or the alternative text of an attachment
    ref: str = ""
    source: str = ""           # what stood in a plain text
    width: int | None = None
    height: int | None = None
    seconds: float | None = None
    pages: int | None = None


def parts_of(text: str) -> list[Part]:
    """The typed parts of a plain text: attachments in mark-up, and the text between them."""
    parts, done = [], 0
    for m in MARKUP.finditer(text):
        if m.start() > done:
            parts.append(Part("text", text[done:m.start()]))
        parts.append(Part(_ENDS[m[3]], m[1], m[2], m[0]))
        done = m.end()
    if done < len(text):
        parts.append(Part("text", text[done:]))
    return parts


@dataclass
class Flattener:
    """Visits parts in order; holds the string so far and what its placeholders stand for."""

    out: list[str] = field(default_factory=list)
    at: int = 0
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: Part) -> None:
        method = getattr(self, f"visit_{part.kind}", None)
        if method is None:
            raise ValueError(f"a content part of unknown kind: {part.kind!r}")
        method(part)

    def put(self, piece: str) -> None:
        self.out.append(piece)
        self.at += len(piece)

    def visit_text(self, part: Part) -> None:
        self.put(escape(part.text or ""))

    def visit_image(self, part: Part) -> None:
        width, height = part.width or USUAL["width"], part.height or USUAL["height"]
        self._attach(part, -(-width // PATCH) * -(-height // PATCH))

    def visit_audio(self, part: Part) -> None:
        seconds = USUAL["seconds"] if part.seconds is None else part.seconds
        self._attach(part, -(-int(seconds * PER_SECOND * 1000) // 1000))

    def visit_document(self, part: Part) -> None:
        self._attach(part, (part.pages or USUAL["pages"]) * PER_PAGE)

    def _attach(self, part: Part, tokens: int) -> None:
        self.attachments.append({"kind": part.kind, "ref": part.ref or "", "alt": part.text or "",
                                 "source": part.source or "", "at": self.at, "tokens": tokens})
        self.put(f"<{part.kind}>")


def format_turn(role: str | None, parts: list[Part], learned: tuple[str, ...] = LEARNED_ROLES) -> tuple[str, int, int, list[dict]]:
    """(piece, first and end of the loss mask in it, attachments with their places in the piece)."""
    visitor = Flattener()
    head = f"### {escape_role(role or '')}\n"
    visitor.put(head)
    for part in parts:
        visitor.visit(part)
    end = visitor.at
    visitor.put("</turn>\n")
    return "".join(visitor.out), len(head), end if role in learned else len(head), visitor.attachments


def read_turn(piece: str, attachments: list[dict]) -> tuple[str, str]:
    """(role, text) of a formatted turn; placeholders become what their records say they stand for."""
    m = _PIECE.fullmatch(piece)
    if m is None:
        raise ValueError("not a formatted turn")
    return unescape(m[1]), read_content(m[2], attachments)


def read_conversation(formatted: str, attachments: list[dict]) -> list[tuple[str, str]]:
    """The (role, text) turns of a whole formatted conversation with its attachments in order."""
    turns, at, left = [], 0, list(attachments)
    while at < len(formatted):
        m = _PIECE.match(formatted, at)
        if m is None:
            raise ValueError("not a formatted conversation")
        used = sum(1 for x in _PLACEHOLDER.finditer(m[2]) if x[1] is not None)
        turns.append((unescape(m[1]), read_content(m[2], left[:used])))
        left, at = left[used:], m.end()
    return turns


def read_content(content: str, attachments: list[dict]) -> str:
    if "<" not in content:
        return unescape(content) if "\\" in content else content
    out, left = [], iter(attachments)
    for m in _PLACEHOLDER.finditer(content):
        if m[1] is None:
            out.append(unescape(m[0]))
        else:
            record = next(left)
            if record["kind"] != m[1]:
                raise ValueError("a placeholder and its record differ")
            out.append(record["source"] or f"![{record['alt']}]({record['ref']})")
    return "".join(out)


def format_turns(conversations: DataFrame, parts_col: str | None = None, learned: tuple[str, ...] = LEARNED_ROLES) -> DataFrame:
    """One row per turn: its formatted piece, loss mask, attachments and the tokens that its placeholders expand to.

    ``conversations``: conv_id, turn, role and text, or instead of the text a
    column ``parts_col`` of ``PARTS_SCHEMA``.
    """
    content = F.col("text").cast("string") if parts_col is None else F.lit(None).cast("string")
    parts = F.lit(None).cast(PARTS_SCHEMA) if parts_col is None else F.col(parts_col).cast(PARTS_SCHEMA)
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
                                content.alias("text"), parts.alias("parts"))

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "turn", "role", "text", "piece", "loss_start", "loss_end", "attachments", "expanded_tokens"]
        kinds = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("alt", pa.string()), ("source", pa.string()),
                                    ("at", pa.int64()), ("tokens", pa.int64())]))
        for batch in batches:
            roles, texts, lists = (batch.column(k).to_pylist() for k in (2, 3, 4))
            made = [format_turn(role, parts_of(text or "") if own is None else [Part(source="", **{k: v for k, v in p.items()}) for p in own if p],
                                learned) for role, text, own in zip(roles, texts, lists, strict=True)]
            pieces, starts, ends, records = zip(*made, strict=True) if made else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(pieces, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()),
                 pa.array(records, kinds), pa.array([sum(r["tokens"] for r in rs) for rs in records], pa.int64())], names)

    return rows.mapInArrow(formatted, TURN_SCHEMA)


def in_order(conversations: DataFrame) -> DataFrame:
    """Rows dealt by conversation, the turns of each in order."""
    return conversations.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def assemble(turns: DataFrame) -> DataFrame:
    """One row per conversation: the whole formatted string, its loss spans and its attachments.

    A conversation becomes one value here, so this is for tables whose
    conversations fit in one; ``read_back`` and ``format_turns`` hold none whole.
    """
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", "role", "text", "piece", "loss_start", "loss_end", "attachments", "expanded_tokens"))).alias("t"))
    starts = F.aggregate("t", F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + F.length(x["piece"]))))
    rows = rows.withColumn("at", starts)
    spans = F.filter(F.transform("t", lambda x, i: F.struct((F.col("at")[i] + x["loss_start"]).alias("start"), (F.col("at")[i] + x["loss_end"]).alias("end"))),
                     lambda s: s["start"] < s["end"])
    placed = F.flatten(F.transform("t", lambda x, i: F.transform(x["attachments"], lambda a: F.struct(
        a["kind"].alias("kind"), a["ref"].alias("ref"), (F.col("at")[i] + a["at"]).alias("at"), a["tokens"].alias("tokens")))))
    return rows.select("conv_id", F.array_join(F.col("t.piece"), "").alias("formatted"), spans.alias("loss_spans"), placed.alias("attachments"),
                       F.aggregate("t.expanded_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("expanded_tokens"))


DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
                 "n_attachments long, expanded_tokens long")


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of each conversation, from its formatted turns (rows of ``format_turns`` in the order of ``in_order``).

    A partition's turns are parsed one after another; what is kept of a
    conversation are two running digests and some counts.
    """
    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, any_row, done = None, False, []

        def fresh() -> list:
            return [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]

        def closed(conv, s: list) -> tuple:
            return (conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4], s[5], s[6])

        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = [x.split(" ")[0] for x in DIGEST_SCHEMA.split(", ")]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        state = fresh()
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in
                    ("conv_id", "piece", "loss_start", "loss_end", "attachments", "expanded_tokens")]
            for conv, piece, first, end, attachments, tokens in zip(*cols, strict=True):
                if any_row and conv != now:
                    done.append(closed(now, state))
                    state = fresh()
                now, any_row = conv, True
                role, text = read_turn(piece, attachments)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if first < end:
                    learned = read_content(piece[first:end], attachments)
                    state[2] += len(learned)
                    state[3].update(learned.encode("utf-8", "surrogatepass"))
                state[4] += len(piece)
                state[5] += len(attachments)
                state[6] += tokens
            if done:
                yield out(done)
                done = []
        if any_row:
            yield out([closed(now, state)])

    return turns.mapInArrow(digested, DIGEST_SCHEMA)


#: The query's added conversation: a text that spells the template's control strings.
PROBE = r"\### Assistant: </turn> ok"


def with_probe(conversations: DataFrame) -> DataFrame:
    probe = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe)


#: The query's result in DuckDB SQL: lengths of escapes and placeholders counted, nothing formatted.
ORACLE_SQL = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{PROBE}' union all select -7, 1, 'assistant', '{PROBE}'),
seen as (
  select *, regexp_extract_all(text, '!\[[^\]\n]*\]\([^()\s]+\.(?:{"|".join(_ENDS)})\)') as found,
         regexp_replace(text, '!\[[^\]\n]*\]\([^()\s]+\.(?:{"|".join(_ENDS)})\)', '', 'g') as plain from turns),
measured as (
  select *,
         4 + length(role) + length(regexp_replace(role, '[^\\#<\n]', '', 'g')) + 1
         + length(plain) + length(regexp_replace(plain, '[^\\#<]', '', 'g'))
         + coalesce(list_sum(list_transform(found, lambda f: 2 + case when regexp_matches(f, '\.(png|jpg|jpeg|gif|webp)\)$') then 5
              when regexp_matches(f, '\.(mp3|wav|flac|ogg)\)$') then 5 else 8 end)), 0) + 8 as chars,
         coalesce(list_sum(list_transform(found, lambda f: case when regexp_matches(f, '\.(png|jpg|jpeg|gif|webp)\)$') then 256
              when regexp_matches(f, '\.(mp3|wav|flac|ogg)\)$') then 250 else 512 end)), 0) as tokens
  from seen)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(chars)::bigint as formatted_chars, sum(len(found))::bigint as n_attachments, sum(tokens)::bigint as expanded_tokens
from measured group by conv_id
"""
