"""Spans against Python's re over awkward texts and the given documents."""

from __future__ import annotations

import hashlib
import re

from conftest import SMALL
from farelake.llm import pii
from farelake.llm.common import table
from samples import awkward, empty

TEXTS = [
    "a@b.c@d.e x@y.com_z@w.de @@a@b.co..x é\U0001d11e j@k.l",
    "1.2.3.4.5.6.7.8 256.1.1.1 0.0.0.0 00001.2.3.255",
    "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111 card 4012888888881881",
    "+1 (815) 555-2757 +49.30.123456- +1 2 +123456789012345678",
    "9" * 30_000,
    "a" * 30_000 + "@x.y",
    "12 " * 10_000,
    None,
    "",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def digits(match):
    return re.sub("[^0-9]", "", match)


RULES = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
)


def brute(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern, valid in RULES
        for m in re.finditer(pattern, text or "")
        if valid(m[0])
    ]


def test_base_spans(spark):
    own = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs = own.union(table(spark, SMALL, "documents").selectExpr("doc_id + 100", "text"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.digest(pii.find_pii(docs)).collect()
    assert len(rows) == len(texts) and sum(r.n_email + r.n_card + r.n_phone for r in rows) > 10
    for row in rows:
        want = brute(texts[row.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), row
        assert row.spans.startswith(listed)
        counts = [sum(k == kind for k, _, _ in want) for kind, _, _ in RULES]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts


def test_checksums_and_context(spark):
    texts = [
        "GB82 WEST 1234 5698 7654 32 and DE89370400440532013000",
        "GB82 WEST 1234 5698 7654 33",
        "my card is 378282246310005",
        "number 378282246310005",
        "ssn 123-45-6789",
        "part 123-45-6789",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = {r.doc_id: [s.kind for s in r.pii] for r in pii.find_pii(frame).collect()}
    assert kinds == {0: ["iban", "iban"], 1: [], 2: ["short_card"], 3: [], 4: ["ssn"], 5: []}


def test_account_numbers_before_other_words(spark):
    compact, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    tails = ["", " Thanks", " Please", " BIC COBADEFF", " 2024", " A", ", DE", " GB82 WEST 1234 5698 7654 32", " x"]
    heads = ["my iban ", "IBAN ", "AT12 3456 ", "NO93 8601 ", "XX12 "]
    texts = [f"{head}{value}{tail}" for head in heads for value in (compact, spaced) for tail in tails]
    # Too short, too long, a wrong check digit, an unknown country.
    wrong = ["DE8937040044053201300", "DE893704004405320130000", "DE88370400440532013000 Thanks", "ZZ89370400440532013000"]
    frame = spark.createDataFrame(list(enumerate(texts + wrong)), "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.value) for s in r.pii if s.kind == "iban"] for r in pii.find_pii(frame).collect()}
    for i, text in enumerate(texts):
        value = compact if compact in text else spaced
        want = [(text.index(value), value)]
        if "GB82" in text:
            want.append((text.index("GB82"), "GB82 WEST 1234 5698 7654 32"))
        assert got[i] == want, text
    assert not any(got[len(texts) + i] for i in range(len(wrong)))
    cleaned = {r.doc_id: r.text for r in pii.redact(frame).collect()}
    assert cleaned[1] == "my iban [IBAN] Thanks"


def test_redact(spark):
    docs = awkward(spark, "pii doc cleaned kind").union(
        spark.createDataFrame(
            [(20, "x a@b.co y +1 (815) 555-2757", "en", "s", 28, "", "", "", "")],
            awkward(spark, "pii doc cleaned kind").schema,
        )
    )
    out = pii.redact(docs)
    assert out.columns == docs.columns
    before = sorted(map(repr, docs.where("doc_id IS NULL OR doc_id <> 20").collect()))
    assert sorted(map(repr, out.where("doc_id IS NULL OR doc_id <> 20").collect())) == before
    row = out.where("doc_id = 20").first()
    assert row.text == "x [EMAIL] y [PHONE]" and row.n_chars == len(row.text)


def test_empty(spark):
    assert pii.digest(pii.find_pii(empty(spark))).count() == 0
    assert pii.redact(empty(spark)).count() == 0


def test_long_texts_with_many_matches(spark):
    """Blocks of a text and chunks of a list have ends in every place."""
    mails = " ".join(f"user{i}@mail{i % 7}.example" + ("\U0001f600 é" if i % 11 == 0 else "") for i in range(6_000))
    far = "x" * 1_990 + " my card 4111 1111 1111 1111 " + "\U0001f600" * 3_000 + " +1 (815) 555-2757 " + "y" * 1_985 + " ssn 123-45-6789"
    texts = [mails, far, far + mails + far]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.pii for r in pii.find_pii(frame).collect()}
    for i, text in enumerate(texts):
        base = [(s.kind, s.start, s.end) for s in found[i] if s.kind in dict((k, 0) for k, _, _ in RULES)]
        assert base == brute(text)
        assert all(text[s.start : s.end] == s.value for s in found[i])
        scores = {s.score for s in found[i] if s.kind == "card"}
        assert scores <= {1.0}
    assert [s.kind for s in found[1]] == ["card", "phone", "ssn"]
    for row in pii.redact(frame).collect():
        text, out, at = texts[row.doc_id], [], 0
        for span in sorted(found[row.doc_id], key=lambda s: (s.start, -s.end)):
            if span.start >= at:
                out += [text[at : span.start], f"[{span.kind.upper()}]"]
            at = max(at, span.end)
        assert row.text == "".join(out) + text[at:]
