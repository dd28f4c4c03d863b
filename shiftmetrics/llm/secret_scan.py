"""Secrets: patterns propose, structure confirms.

Base kinds (``assign access hex``) are reported by their patterns alone.  The
added kinds are reported only if their structure holds when decoded:

* ``pem``    an armoured block whose body is base64 of a DER key or of an
  OpenSSH private key, or an encrypted body under its ``DEK-Info`` header
* ``token``  three base64url parts joined by dots, the first a JSON header
  with ``alg``
* ``der``    a run of base64 or hex that decodes to a DER key: a sequence whose
  nested lengths fill it exactly and whose fields are those of a key
* ``wrapped``  a run of base64 or hex whose decoded text holds a
  base secret, an armoured key, a signed token or, again, such a run

A run may be broken into lines of equal length (the last one shorter), hex may
be separated by colons, and other letters of the alphabet may adjoin a run (a
path before it, a digit too many): it is then read from each of its four (hex:
two) phases, and keys from each place that can be their header on, as long as
that header says.

Each text is read whole, in the tasks that hold it; nothing is shuffled.
Positions are code points, end exclusive.

Defined results: a null or empty text has no spans; repeated rows are judged
one by one; only the key and text columns are read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

# Base kinds in the order in which they are listed, and their patterns.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")      # AKIA[A-Z0-9]+ of 18 characters or more
HEX = re.compile(r"[0-9a-f]{16,}")             # [0-9a-f]+ of 16 characters or more
BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("pem", "token", "der", "wrapped")
RANK = {k: i for i, k in enumerate(BASE_KINDS + ADDED_KINDS)}

#: An armoured block: header lines (Proc-Type, DEK-Info) may come first, line ends may be escaped.
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:(?:\r?\n|\\[rn])+[A-Za-z][A-Za-z0-9-]*:[^\r\n\\]*)*)"
                    r"((?:[A-Za-z0-9+/=\s]|\\[rn])+)-----END \1-----")
SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
#: Runs that may hold a base secret: the shortest is an access key of 18 bytes, 24 letters of base64 or 36 of hex.
LEAST_BYTES = 18
RUN64 = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % (LEAST_BYTES * 4 // 3))
RUN16 = re.compile(r"[0-9A-Fa-f]{%d,}" % (LEAST_BYTES * 2))
COLONS = re.compile(r"[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){%d,}" % (LEAST_BYTES - 1))
#: A run that goes on in further lines, and its lines.
LINES64 = re.compile(r"[A-Za-z0-9+/_-]{%d,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}" % (LEAST_BYTES * 4 // 3))
LINE64 = re.compile(r"[A-Za-z0-9+/_=-]+")
#: What a sequence (tag 0x30) begins with in base64.
HEADER64 = re.compile("M[A-P]")
#: How often a run may be encoded over, and the share of decoded characters that must be printable.
DEPTH, PRINTABLE = 3, 0.9
#: Runs of one alphabet, for a run that holds both.
ALPHABETS = (re.compile(r"[A-Za-z0-9+/]{%d,}={0,2}" % (LEAST_BYTES * 4 // 3)), re.compile(r"[A-Za-z0-9_-]{%d,}={0,2}" % (LEAST_BYTES * 4 // 3)))
#: Cheap tests: a text without these can hold no base secret of the kind.
ASSIGN_HINT = re.compile(r"(?i:passw|secret|token|api_?key)", re.ASCII)


class Span(NamedTuple):
    start: int
    end: int
    kind: str


def base_spans(text: str) -> list[Span]:
    found = []
    if ASSIGN_HINT.search(text):
        found += [Span(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [Span(*m.span(), "access") for m in ACCESS.finditer(text)]
    found += [Span(*m.span(), "hex") for m in HEX.finditer(text)]
    return found


def _decode64(s: str) -> bytes | None:
    s = "".join(s.split()).rstrip("=").replace("-", "+").replace("_", "/")
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the values that lie one after another; None if their lengths do not fill ``data`` exactly."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length & 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or at + size > len(data) or not data[at]:
                return None
            length, at = int.from_bytes(data[at:at + size], "big"), at + size
            if length < 0x80:
                return None
        if at + length > len(data):
            return None
        items.append((tag, data[at:at + length]))
        at += length
    return items


def is_der_key(data: bytes) -> bool:
    """A private or public key: RSA integers, EC key, or an algorithm with wrapped key bits."""
    outer = der_items(data) if len(data) >= 32 and data[0] == 0x30 else None
    if not outer or len(outer) != 1:
        return False
    inner = der_items(outer[0][1])
    if not inner:
        return False
    tags = [t for t, _ in inner]
    if tags[0] == 0x02 and len(inner[0][1]) == 1:
        if len(tags) >= 9 and set(tags[1:9]) == {0x02}:
            return True                                                     # RSA private key
        if len(tags) >= 3 and tags[1] == 0x30 and tags[2] == 0x04:
            return bool(_algorithm(inner[1][1]))                            # PKCS 8
        return len(tags) >= 2 and tags[1] == 0x04 and all(t & 0xE0 == 0xA0 for t in tags[2:])  # EC private key
    if tags == [0x30, 0x03]:
        return bool(_algorithm(inner[0][1]))                                # public key
    return tags == [0x30, 0x04] and bool(_algorithm(inner[0][1]))           # encrypted private key


def _algorithm(data: bytes) -> bool:
    items = der_items(data)
    return bool(items) and items[0][0] == 0x06 and len(items[0][1]) >= 3


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private key: its magic, then strings whose lengths stay inside."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)
    for _ in range(3):
        size = int.from_bytes(data[at:at + 4], "big")
        at += 4 + size
        if at > len(data):
            return False
    return int.from_bytes(data[at:at + 4], "big") >= 1


def is_signed_token(header: str, body: str) -> bool:
    raw = _decode64(header)
    try:
        parsed = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return False
    return isinstance(parsed, dict) and isinstance(parsed.get("alg"), str) and _decode64(body) is not None


def _decoded_kind(data: bytes | None, depth: int = DEPTH) -> str | None:
    if not data:
        return None
    if is_der_key(data) or is_ssh_key(data):
        return "der"
    try:
        inner = data.decode("utf-8")
    except UnicodeDecodeError:
        inner = data.decode("latin-1")
    if sum(c.isprintable() or c in "\t\n\v\f\r" for c in inner) < PRINTABLE * len(inner):
        return None
    held = any(s.kind != "hex" for s in base_spans(inner)) or armoured(inner) or signed(inner)
    return "wrapped" if held or depth > 1 and added_spans(inner, depth - 1) else None


def _phases64(run: str) -> Iterator[bytes]:
    """A run's bytes from its second, third and fourth letter on, and without a last letter that is too many."""
    run = run.rstrip("=")
    for k in range(4):
        part = run[k:len(run) - (len(run) - k) % 4] if (len(run) - k) % 4 == 1 else run[k:]
        if (k or part != run) and (data := _decode64(part)):
            yield data


def _key_inside(run: str) -> tuple[int, int] | None:
    """Where a run of base64 holds a key that other letters adjoin: a header whose lengths say where it ends."""
    for m in HEADER64.finditer(run):
        head = _decode64(run[m.start():m.start() + 16])
        if not head or len(head) < 12 or head[0] != 0x30:
            continue
        size = 0 if head[1] < 0x80 else head[1] & 0x7F
        at = 2 + size
        if size > 4 or head[at] not in (0x02, 0x30):
            continue
        length = at + (int.from_bytes(head[2:at], "big") if size else head[1])
        end = m.start() + -(-length * 4 // 3)
        if end <= len(run) and (data := _decode64(run[m.start():end])) and is_der_key(data[:length]):
            return m.start(), end
    return None


def _broken_runs(text: str, depth: int) -> Iterator[Span]:
    """Runs of base64 that are broken into lines of equal length, the last one shorter."""
    for m in LINES64.finditer(text) if "\n" in text else ():
        lines = [(m.start() + x.start(), m.start() + x.end(), x[0]) for x in LINE64.finditer(m[0])]
        i = 0
        while i < len(lines):
            j = i + 1
            while j < len(lines) and len(lines[j][2]) == len(lines[i][2]):
                j += 1
            shorter = j < len(lines) and len(lines[j][2]) < len(lines[i][2])
            for end in (j + 1, j) if shorter else (j,):
                if end - i > 1 and (kind := _decoded_kind(_decode64("".join(x for *_, x in lines[i:end])), depth)):
                    yield Span(lines[i][0], lines[end - 1][1], kind)
                    j = end
                    break
            i = j


def armoured(text: str) -> list[Span]:
    """Armoured blocks whose body is a key; an encrypted body (with a DEK-Info header) has no structure, so its
    length must be whole blocks of the cipher."""
    found = []
    for m in ARMOUR.finditer(text) if "-----BEGIN " in text else ():
        data = _decode64(re.sub(r"\\[rn]", "", m[3]))
        sealed = "DEK-Info:" in m[2] and "ENCRYPTED" in m[2] and data and len(data) >= 32 and len(data) % 8 == 0
        if data and (sealed or is_der_key(data) or is_ssh_key(data)):
            found.append(Span(*m.span(), "pem"))
    return found


def signed(text: str) -> list[Span]:
    return [Span(*m.span(), "token") for m in SIGNED.finditer(text) if is_signed_token(m[1], m[2])] if "eyJ" in text else []


def _run64(run: str, at: int, depth: int) -> Iterator[Span]:
    """What a run of base64 holds: whole, else by its parts of one alphabet, else with other letters adjoining it."""
    mixed = ("-" in run or "_" in run) and ("+" in run or "/" in run)
    parts = [(x.start(), x[0]) for alphabet in ALPHABETS for x in alphabet.finditer(run)] if mixed else [(0, run)]
    found = {Span(at + a, at + a + len(part), kind) for a, part in parts if (kind := _decoded_kind(_decode64(part), depth))}
    if not found and (inside := _key_inside(run)):
        found = {Span(at + inside[0], at + inside[1], "der")}
    if not found and any(_decoded_kind(data, depth) for data in _phases64(run)):
        found = {Span(at, at + len(run), "wrapped")}
    yield from found


def _run16(run: str, depth: int) -> str | None:
    if len(run) % 2 == 0:
        return _decoded_kind(bytes.fromhex(run), depth)
    return _decoded_kind(bytes.fromhex(run[1:]), depth) or _decoded_kind(bytes.fromhex(run[:-1]), depth)


def added_spans(text: str, depth: int = DEPTH) -> list[Span]:
    found = armoured(text) + signed(text)

    def covered(start: int, end: int) -> bool:
        return any(s.start <= start and end <= s.end for s in found)

    found += [s for s in _broken_runs(text, depth) if not covered(s.start, s.end)]
    runs = set()
    for m in RUN64.finditer(text):
        if not covered(*m.span()):
            runs.update(_run64(m[0], m.start(), depth))
    for m in RUN16.finditer(text):
        if not covered(*m.span()) and (kind := _run16(m[0], depth)):
            runs.add(Span(*m.span(), kind))
    for m in COLONS.finditer(text) if ":" in text else ():
        if not covered(*m.span()) and (kind := _decoded_kind(bytes.fromhex(m[0].replace(":", "")), depth)):
            runs.add(Span(*m.span(), kind))
    return found + sorted(runs)


def spans(text: str) -> list[Span]:
    """All spans of a text by start, then kind as listed."""
    return sorted({*base_spans(text), *added_spans(text)}, key=lambda s: (s.start, RANK[s.kind], s.end))


def _joined(found: Iterable[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in found)


def scan(df: DataFrame, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: its key, counts of base kinds, hash of base spans, all spans."""
    key_type = df.schema[key].dataType.simpleString()

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans(t or "") for t in batch.column(1).to_pylist()]
            base = [[s for s in row if s.kind in BASE_KINDS] for row in found]
            counts = [pa.array([sum(s.kind == k for s in row) for row in base], pa.int64()) for k in BASE_KINDS]
            hashes = pa.array([hashlib.sha256(_joined(row).encode()).hexdigest() for row in base], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, hashes, pa.array([_joined(row) for row in found], pa.string())],
                [key, *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])

    return df.select(key, text_col).mapInArrow(
        scanned, f"`{key}` {key_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
