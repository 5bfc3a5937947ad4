"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Kinds: email, ip, card, phone, iban and secret. Every confirmed email, address, card
and international phone number counts (``base``). Three more proposals need a
score: an IBAN passes with a valid mod-97 checksum, a phone number without country
code only with a word such as "call" or "tel" close to it, and a secret (a long run of letters and
digits whose characters are mixed as those of a random text are) only with a word such as "token" or "key". Context moves every score.

Each pattern is written so that a scan is linear in the text, also for long runs
of digits or of word characters: possessive repeats, and for emails a search for the
``@`` part that is then extended to the left.

Offsets are code points, end exclusive. Defined cases: null and empty texts have no
spans; spans of different kinds may overlap; repeated rows are judged one by one;
an empty table gives an empty result; columns named like the added ones are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from pledgeflow.llm.common import Rows, with_columns

KINDS = ("email", "ip", "card", "phone", "iban", "secret")
#: Score from which a proposal that is not a base span counts.
LEAST_SCORE = 0.5
#: Characters before and after a span in which context words are sought.
NEAR = 40
#: Start score by kind; words that raise it, words that lower it.
CONTEXT = {
    "email": (0.9, r"e-?mail|contact|write", r"example|noreply"),
    "ip": (0.6, r"ip|server|host|address", r"version|chapter|section"),
    "card": (0.8, r"card|visa|credit|payment|expir", r"order|tracking|serial"),
    "phone": (0.8, r"call|tel|phone|mobile|fax|whatsapp", r"isbn|order"),
    "iban": (0.7, r"iban|bank|account|konto|compte|cuenta", r"serial|checksum"),
    "secret": (0.3, r"token|(?:api|access|private|secret)?[_-]?key|secret|passw|credential|auth|bearer", r"sha|checksum|commit|digest|hash|uuid"),
    "local": (0.3, r"call|tel|phone|mobile|fax|whatsapp", r"isbn|order"),
}

_CONTEXT = {k: (s, re.compile(rf"\b(?:{up})", re.I), re.compile(rf"\b(?:{down})", re.I)) for k, (s, up, down) in CONTEXT.items()}
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_IBAN_REST = re.compile(r"(?: ?[A-Z0-9]){11,30}+")
#: Characters of an account number by country.
_IBAN_LENGTHS = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT",
        26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
        31: "MT", 32: "LC",
    }.items()
    for country in countries.split()
}
#: Lengths of a secret, and the least entropy of its characters in bits: of hexadecimal digits, of others.
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+")
SECRET_MOST, SECRET_BITS = 200, (3.0, 3.5)
_HEXADECIMAL = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])")

_SPAN = StructType(
    [
        StructField("kind", StringType()),
        StructField("start", LongType()),
        StructField("end", LongType()),
        StructField("score", DoubleType()),
        StructField("base", BooleanType()),
    ]
)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of local part, @ and a domain with a dot; leftmost, not overlapping."""
    least = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > least and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < m.start():
            yield start, m.end()
            least = m.end()


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            yield m.span()


def mod97(iban: str) -> bool:
    """Whether the check digits of an account number fit."""
    compact = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, not overlapping; of several ends that fit the one of the country's length, or else the longest.

    An end is a word border, so a capital or digit that follows after a space is not taken for a part.
    Each start looks at 30 more characters and the spaces before them.
    """
    least = 0
    for m in _IBAN_START.finditer(text):
        if m.start() < least or not (run := _IBAN_REST.match(text, m.end())):
            continue
        head = int("".join(str(int(c, 36)) for c in m[0]))
        rest, size, ends = 0, 4, {}
        for at in range(m.end(), run.end()):
            if (c := text[at]) == " ":
                continue
            rest = (rest * (10 if c <= "9" else 100) + int(c, 36)) % 97
            size += 1
            if size >= 15 and (rest * 1_000_000 + head) % 97 == 1 and not _WORD_CHAR.match(text, at + 1):
                ends[size] = at + 1
        if ends:
            least = ends.get(_IBAN_LENGTHS.get(m[0][:2]), max(ends.values()))
            yield m.start(), least


_WORD_CHAR = re.compile(r"[A-Za-z0-9]")


def secrets(text: str) -> Iterator[tuple[int, int]]:
    """Runs with letters and digits whose characters have the entropy of random ones."""
    for m in _SECRET.finditer(text):
        value = m[0]
        if len(value) > SECRET_MOST or not any(map(str.isdigit, value)) or not any(map(str.isalpha, value)):
            continue
        shares = [n / len(value) for n in Counter(value).values()]
        if -sum(p * math.log2(p) for p in shares) >= SECRET_BITS[_HEXADECIMAL.fullmatch(value) is None]:
            yield m.span()


def _scored(text: str, kind: str, span: tuple[int, int]) -> float:
    score, up, down = _CONTEXT[kind]
    near = text[max(0, span[0] - NEAR) : span[0]] + " " + text[span[1] : span[1] + NEAR]
    score += 0.3 * bool(up.search(near)) - 0.3 * bool(down.search(near))
    return round(min(1.0, max(0.0, score)), 3)


def find_spans(text: str | None) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) by kind as in ``KINDS``, then by start."""
    if not text:
        return []
    out = []
    digits = _DIGIT.search(text) is not None
    base = {
        "email": emails(text) if "@" in text else (),
        "ip": addresses(text) if digits else (),
        "card": cards(text) if digits else (),
        "phone": phones(text) if digits and "+" in text else (),
    }
    for kind, spans in base.items():
        out += [(kind, s, e, _scored(text, kind, (s, e)), True) for s, e in spans]
    if digits:
        taken = [(s, e) for kind, s, e, *_ in out if kind in ("phone", "card")]
        local = [m.span() for m in _LOCAL_PHONE.finditer(text)]
        found = [(s, e, _scored(text, "local", (s, e))) for s, e in local if not any(s < b and a < e for a, b in taken)]
        if more := [("phone", s, e, score, False) for s, e, score in found if score >= LEAST_SCORE]:
            out += more
            out.sort(key=lambda x: (KINDS.index(x[0]), x[1]))
        scored = ((s, e, _scored(text, "iban", (s, e))) for s, e in ibans(text))
        out += [("iban", s, e, score, False) for s, e, score in scored if score >= LEAST_SCORE]
        scored = ((s, e, _scored(text, "secret", (s, e))) for s, e in secrets(text))
        out += [("secret", s, e, score, False) for s, e, score in scored if score >= LEAST_SCORE]
    return out


_DIGIT = re.compile(r"[0-9]")


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: kind, start, end, score and base of each finding."""

    def start() -> Callable[[pa.RecordBatch], Rows]:
        names = [f.name for f in _SPAN.fields]

        def convert(batch: pa.RecordBatch) -> Rows:
            return {"spans": [[dict(zip(names, s)) for s in find_spans(t)] for t in batch.column(text).to_pylist()]}

        return convert

    return with_columns(docs, StructType([StructField("spans", ArrayType(_SPAN))]), start)


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each finding replaced by its kind in angle brackets; of overlapping ones the first in the text."""

    def start() -> Callable[[pa.RecordBatch], Rows]:
        def mask(value: str | None) -> str | None:
            if value is None:
                return None
            out, at = [], 0
            for kind, s, e, *_ in sorted(find_spans(value), key=lambda x: (x[1], -x[2])):
                if s >= at:
                    out += [value[at:s], f"<{kind}>"]
                    at = e
            return "".join([*out, value[at:]])

        return lambda batch: {text: [mask(t) for t in batch.column(text).to_pylist()]}

    return with_columns(docs, StructType([StructField(text, StringType())]), start).select(*docs.columns)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
