import hashlib
import random
import re

import pytest
from text_fixtures import EDGE_TEXTS, by_id

from shiftmetrics.llm import pii

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def expected(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def noise(seed):
    r = random.Random(seed)
    parts = ["a@b.co", "x.y+z@mail.example.com", "@", "a@b", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "256.1.1.1", "010.0.0.255", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "4111111111111111111", "+1 (017) 555-7713", "+1", "++49 30 1234567", "+12345678901234567", "é", "\U0001F600",
             " ", "\n", ".", "-", "9" * 20, "0" * 30]
    return "".join(r.choice(parts) + r.choice(["", " ", "x"]) for _ in range(r.randrange(40)))


def test_base_spans_equal_plain_search(documents):
    rows = list(enumerate(EDGE_TEXTS + [noise(s) for s in range(150)]))
    texts = dict(rows)
    for i, r in by_id(pii.digest(pii.scan(documents(rows)))).items():
        want = expected(texts[i])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[i]
        assert [s for s in r["spans"].split(",") if s.split(":")[0] in KINDS] == want
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s.startswith(k) for s in want) for k in KINDS]


def test_long_runs_take_linear_time(documents):
    rows = [(1, "a" * 200_000 + " b@c.de"), (2, "b@" + "c." * 50_000 + "d"), (3, "7" * 200_000 + " 1.1.1.1")]
    got = by_id(pii.digest(pii.scan(documents(rows))))
    assert got[1]["spans"] == "email:200001:200007" and got[2]["n_email"] == 1 and got[3]["n_ip"] == 1


def test_added_kinds_need_checksum_or_context(documents):
    rows = [(1, "my iban DE89 3704 0044 0532 0130 00 ok"), (2, "my iban DE88 3704 0044 0532 0130 00 ok"),
            (3, "ssn 123-45-6789"), (4, "number 123-45-6789"), (5, "ssn 000-45-6789"), (6, "GB82WEST12345698765432")]
    got = {i: r["spans"] for i, r in by_id(pii.digest(pii.scan(documents(rows)))).items()}
    assert got == {1: "iban:8:35", 2: "", 3: "ssn:4:15", 4: "", 5: "", 6: "iban:0:22"}


def test_context_moves_the_score(documents):
    rows = [(1, "call +1 (017) 555-7713"), (2, "see +1 (017) 555-7713"), (3, "version +1 (017) 555-7713")]
    assert {i: r["scores"] for i, r in by_id(pii.digest(pii.scan(documents(rows)))).items()} == {1: "0.8", 2: "0.6", 3: "0.4"}


def test_mask_keeps_columns_and_clean_rows(clashing):
    rows = [(1, "write a@b.co or call +1 (017) 555-7713."), (2, "nothing here"), (3, None), (4, ""), (4, "1.2.3.4"), (None, "x 1.2.3.4 y")]
    df = clashing(rows)
    out = pii.mask(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()), key=str)
    want = [(1, "write [EMAIL] or call [PHONE].", 30), (2, "nothing here", 12), (3, None, None), (4, "", 0), (4, "[IP]", 4), (None, "x [IP] y", 8)]
    assert got == sorted(want, key=str)


def test_overlapping_spans_are_masked_once(documents):
    # The digits of the phone number are a card number as well.
    text = "pay +4111 1111 1111 111 or 4111 1111 1111 1111@x.yz"
    masked = pii.mask(documents([(1, text)])).first()["text"]
    assert not re.search("[0-9]{3}", masked)


def test_empty_table(documents):
    assert pii.digest(pii.scan(documents([]))).count() == 0
    assert pii.mask(documents([])).count() == 0


@pytest.mark.parametrize("plan", [lambda d: pii.digest(pii.scan(d)), pii.mask])
def test_no_python_in_the_plan(documents, plan):
    df = plan(documents([(1, "a@b.co")]))
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("iban", ["ES91 2100 0418 4502 0005 1332", "AT611904300234573201", "BE68 5390 0754 7034", "SE45 5000 0000 0583 9825 7466",
                                  "PL61 1090 1014 0000 0712 1981 2874", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"])
def test_an_iban_ends_before_the_next_word(documents, iban):
    n = len(iban)
    rows = [(1, f"{iban} BIC CAIXESBB"), (2, f"{iban} 2024"), (3, f"{iban} {iban}"), (4, f"AB12 CDEF GHIJ {iban}"), (5, f"{iban}X")]
    got = {i: r["spans"] for i, r in by_id(pii.digest(pii.scan(documents(rows)))).items()}
    assert {i: ",".join(s for s in spans.split(",") if s.startswith("iban")) for i, spans in got.items()} == {
        1: f"iban:0:{n}", 2: f"iban:0:{n}", 3: f"iban:0:{n},iban:{n + 1}:{2 * n + 1}", 4: f"iban:15:{n + 15}", 5: ""}
    assert pii.mask(documents(rows[:1])).first()["text"] == "[IBAN] BIC CAIXESBB"
