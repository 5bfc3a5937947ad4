"""Spans against the plain patterns; checksums; context; linear time on long runs."""

import re
import time

import pytest

from pledgeflow.llm import pii
from tests.llm.cases import docs_of, empty, frame, prose


def slow_luhn(digits):
    total = 0
    for n, c in enumerate(reversed(digits)):
        value = int(c) * (2 if n % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


# the patterns and checks as they are stated
PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[ -]", "", m)) <= 19 and slow_luhn(re.sub("[ -]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= sum(c in "0123456789" for c in m) <= 15),
}


def brute(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in PLAIN.items() for m in re.finditer(p, text or "") if ok(m[0])]


TEXTS = [
    "a@b.c@d.e x@y@z.co, .@-.- joe.o'neil+x%y@sub.mail-host.example.org. @a.b a@b a@b. é@b.c",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.001.1.1 1.2.3 00000000001.2.3.4 1.2.3.99999999999999999999999",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 0000000000000 12345678901234567890 79927398713",
    "+1 (555) 555-0123--- +49.30.1234567( +1 2 +123456789012345678 +1((((((((( ++12 3456 789",
    "\U0001f600 é joe@x.yz +1 (555) 555-0123 10.0.0.1 \n4111111111111111", "", None, prose(4, 50),
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_are_those_of_the_patterns(text):
    assert [s[:3] for s in pii.find_spans(text) if s[4]] == brute(text)


def test_checksums():
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB82 WEST 1234 5698 7654 33")
    for n in range(200):
        assert pii.luhn(str(n * 7919)) == slow_luhn(str(n * 7919))


def test_the_method_adds_spans_with_context():
    kinds = lambda t: [s[0] for s in pii.find_spans(t)]
    assert kinds("bank account: GB82 WEST 1234 5698 7654 32 now") == ["iban"]
    assert kinds("GB82 WEST 1234 5698 7654 33 bank") == []
    assert kinds("please call 555-123-4567 today") == ["phone"] and kinds("lot 555-123-4567 today") == []
    card = "4111 1111 1111 1111"
    scores = [pii.find_spans(f"{word} {card}")[0][3] for word in ("tracking", "lorem", "credit")]
    assert scores == sorted(scores) and scores[0] < scores[2]


@pytest.mark.parametrize("number", ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"])
@pytest.mark.parametrize("after", [" Please pay", " Thanks", " BIC COBADEFF", " 2 items", " A", " GB82WEST12345698765432", ", B", ""])
def test_account_numbers_before_capitals_and_digits(number, after):
    found = [s[1:3] for s in pii.find_spans(f"IBAN {number}{after}") if s[0] == "iban"]
    assert found[0] == (5, 5 + len(number)) and len(found) == 1 + ("GB82" in after)


def test_account_numbers_end_at_word_borders():
    assert [s[0] for s in pii.find_spans("bank DE89370400440532013000x")] == []
    assert [s[0] for s in pii.find_spans("bank DE893704004405320130001")] == []
    started = time.process_time()
    pii.find_spans("AA11 " * 100_000 + "bank")
    assert time.process_time() - started < 20


@pytest.mark.parametrize("run", ["1", "1.", "a", "a.", "+1(", "a@", "A1", "1 ", "-", "@a-"])
def test_long_runs_take_linear_time(run):
    started = time.process_time()
    pii.find_spans(run * 200_000 + " bank @ +")
    assert time.process_time() - started < 20


def test_awkward_rows_and_empty_tables(spark):
    docs = frame(spark)
    found = pii.find_pii(docs)
    assert found.count() == docs.count() and found.filter("score <> 'own'").count() == 0
    assert pii.find_pii(empty(spark)).count() == 0 and pii.masked(empty(spark)).count() == 0
    rows = docs_of(spark, [(1, "mail joe@x.yz or 10.0.0.1"), (2, None), (3, "")])
    assert [r["text"] for r in pii.masked(rows).orderBy("doc_id").collect()] == ["mail <email> or <ip>", None, ""]
    one = pii.find_pii(rows).select(pii.joined(pii.F.col("spans")).alias("s")).orderBy("s").collect()
    assert [r["s"] for r in one] == ["", "", "email:5:13,ip:17:25"]


def test_secrets_by_form_entropy_and_context():
    import random

    r = random.Random(7)
    hexa = lambda: "".join(r.choices("0123456789abcdef", k=r.choice([32, 40, 64])))
    mixed = lambda: "x7" + "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=r.randint(22, 60)))
    forms = ['token = "{}"', "api_key: {}", "SECRET={}", "Authorization: Bearer {}", "password '{}' "]
    found = made = wrong = 0
    for i in range(200):
        value = (hexa if i % 2 else mixed)()
        before = "één text. " * (i % 5)
        text = before + forms[i % len(forms)].format(value) + " and more words"
        spans = [s for s in pii.find_spans(text) if s[0] == "secret"]
        at = text.index(value)
        made += 1
        found += [(s, e) for _, s, e, *_ in spans] == [(at, at + len(value))]
    clean = [f"commit {hexa()}", f"sha256 checksum: {hexa()}", hexa(), "the key is under-the-mat-near-the-door-2", "token " + "a1" * 20,
             "token " + "z" * 5000, "secret " + "1" * 40, "key " + "ab1/" * 60, f"key {'x1y2z3w4' * 40}"]
    wrong = sum(any(s[0] == "secret" for s in pii.find_spans(t)) for t in clean)
    assert found >= 0.95 * made and wrong == 0
