"""Personal data: patterns propose, checksums confirm, nearby words score.

DataFrame functions only.  For each kind a regular expression proposes spans;
a validator drops those that fail (part range, Luhn, mod-97, digit count) and
words near a span move its score.  The kinds ``email ip card phone`` are
reported whatever their score; the added kinds ``iban`` (mod-97) and ``ssn``
(no checksum, so a context word is needed) from ``ADDED_SCORE`` on.

Positions are code points, end exclusive.  Java's regular expressions give no
positions, so a text is split at the matches and the lengths are summed.

Defined results: a null or empty text has no spans; repeated rows are judged
one by one; only the named text column is read, other columns pass through
(``mask``) or are left out (``scan``).  Patterns are written so that matching
neither recurses nor restarts inside a run: long texts cost linear time, plus
the square of the number of spans of one text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftmetrics.llm.common import fresh

# Base kinds, in the order in which spans are listed, and their patterns.
# `(?:(?<![run])|\G)` only lets a match begin where a run of these characters, or what a
# match has left of it, begins; possessive `++` repeats a group without recursion.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """An IBAN ends where its country's length says, so that a word after it is not taken in; codes that
    are not listed take groups until one begins like an IBAN of a listed country."""
    def body(n: int) -> str:
        return rf"(?:\x20?[A-Z0-9]{{4}}){{{n // 4}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    listed = "|".join("|".join(codes.split()) for codes in IBAN_LENGTHS.values())
    known = "|".join(rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}{body(n - 4)}" for n, codes in IBAN_LENGTHS.items())
    blank = rf"(?:\x20(?!(?:{listed})[0-9]{{2}}))?"
    other = rf"(?!{listed})[A-Z]{{2}}[0-9]{{2}}(?:{blank}[A-Z0-9]{{4}}){{2,7}}+(?:{blank}[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?:{known}|{other})(?![A-Za-z0-9])"


PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban(),
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_SCORE = 0.5

#: What a text must hold for a kind's pattern to be tried at all (plain scans).
_TRY = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]+\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
    "ssn": lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"),
}
#: Score of a confirmed span, and words that raise or lower it when they are near.
_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
_RAISE = {
    "email": "mail|contact|write|reach", "ip": "address|host|server|login|client",
    "card": "card|credit|visa|payment|pay", "phone": "phone|call|tel|mobile|fax|contact",
    "iban": "iban|account|bank|transfer", "ssn": "ssn|social|security|taxpayer",
}
_LOWER = {
    "email": "example|sample|noreply", "ip": "version|release|section", "card": "serial|order|tracking",
    "phone": "version|serial|order", "iban": "serial|part|model", "ssn": "serial|part|order",
}
_STEP, BEFORE, AFTER = 0.2, 48, 24

SPAN = "array<struct<kind:string,rank:int,from:int,to:int,score:double>>"


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""
    def digit(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((F.length(digits) - i) % 2 == 1, doubled).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + digit(i)) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without blanks leaves 1 modulo 97."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def step(a: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (a * 100 + code - 55) % 97).otherwise((a * 10 + code - 48) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


def _confirmed(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return _with(_digits(m), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    if kind == "iban":
        return _with(F.replace(m, F.lit(" "), F.lit("")),
                     lambda s: F.when(F.length(s).between(15, 34), mod97(s)).otherwise(F.lit(False)))
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9..)|-00-|0000$")
    return F.lit(True)


def _proposed(text: Column, kind: str) -> Column:
    """Matches of a kind with their positions: array of (m, from, to)."""
    pattern = F.lit(PATTERNS[kind])
    gaps, found = F.split(text, PATTERNS[kind], -1), F.regexp_extract_all(text, pattern, F.lit(0))
    empty = F.lit(None).cast("struct<at:int,out:array<struct<m:string,from:int,to:int>>>")
    start = F.coalesce(empty, F.struct(F.lit(0).alias("at"),
                                       F.array().cast("array<struct<m:string,from:int,to:int>>").alias("out")))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + F.length(x["gap"])
        end = begin + F.length(x["m"])
        span = F.struct(x["m"].alias("m"), begin.alias("from"), end.alias("to"))
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(span)).alias("out"))

    def walked(m: Column) -> Column:
        pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(m)), m, lambda g, x: F.struct(g.alias("gap"), x.alias("m")))
        return F.aggregate(pairs, start, step, lambda a: a["out"])
    return _with(found, walked)


def _scored(text: Column, kind: str, span: Column) -> Column:
    begin = F.greatest(span["from"] - BEFORE, F.lit(0))
    near = F.lower(F.concat_ws(" ", F.substring(text, begin + 1, span["from"] - begin),
                               F.substring(text, span["to"] + 1, F.lit(AFTER))))
    moved = _with(near, lambda w: F.when(w.rlike(_RAISE[kind]), F.lit(_STEP)).otherwise(F.lit(0.0))
                  - F.when(w.rlike(_LOWER[kind]), F.lit(_STEP)).otherwise(F.lit(0.0)))
    return F.round(F.least(F.lit(1.0), F.lit(_SCORE[kind]) + moved), 2)


def spans(text: Column) -> Column:
    """All reported spans of a text, by kind as listed in PATTERNS, then start."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(*(_spans_of(text, rank, kind) for rank, kind in enumerate(PATTERNS)))


def _spans_of(text: Column, rank: int, kind: str) -> Column:
    kept = F.filter(_proposed(text, kind), lambda s: _confirmed(kind, s["m"]))
    rows = F.transform(kept, lambda s: F.struct(
        F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), s["from"].alias("from"), s["to"].alias("to"),
        _scored(text, kind, s).alias("score")))
    if kind not in BASE_KINDS:
        rows = F.filter(rows, lambda s: s["score"] >= ADDED_SCORE)
    tried = _TRY[kind](text)
    if kind != "email":
        tried = text.rlike("[0-9]") & tried
    return F.when(tried, rows.cast(SPAN)).otherwise(F.array().cast(SPAN))


def scan(df: DataFrame, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: the key columns and its ``spans``."""
    return df.select(*keys, spans(F.col(text_col)).alias("spans"))


def _joined(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["from"], x["to"])), ",")


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda x: x["kind"] == kind


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, hash and listing of the spans of ``scan``."""
    found = F.col("spans")
    counts = [F.size(F.filter(found, _of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    base = F.filter(found, lambda x: x["rank"] < len(BASE_KINDS))
    scores = F.array_join(F.transform(found, lambda x: x["score"].cast("string")), ",")
    return scanned.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
                          _joined(found).alias("spans"), scores.alias("scores"))


def mask(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns, each span replaced by its kind in brackets.

    Of spans that overlap the first is named and the others are covered with
    it.  ``length_col``, if the table has it, is set to the new length of
    texts that changed.  Texts without spans, and null texts, stay as they are.
    """
    names = df.columns
    found, new = fresh(df, "_spans", "_masked")
    text = F.col(text_col)
    ordered = F.array_sort(F.transform(F.col(found), lambda x: F.struct(x["from"], x["to"], x["kind"])))

    def step(a: Column, x: Column) -> Column:
        fresh = x["from"] >= a["at"]
        added = F.array(F.substring(text, a["at"] + 1, x["from"] - a["at"]), F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        return F.struct(F.greatest(a["at"], x["to"]).alias("at"),
                        F.when(fresh, F.concat(a["parts"], added)).otherwise(a["parts"]).alias("parts"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    masked = F.aggregate(ordered, start, step, lambda a: F.concat(
        F.array_join(a["parts"], ""), F.substring(text, a["at"] + 1, F.length(text))))
    hit = F.size(found) > 0
    out = df.withColumn(found, spans(text)).withColumn(new, F.when(hit, masked).otherwise(text))
    columns = []
    for c in names:
        if c == text_col:
            columns.append(F.col(new).alias(c))
        elif c == length_col:
            columns.append(F.when(hit, F.length(new).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return out.select(*columns)
