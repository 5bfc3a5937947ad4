"""Documents with every awkward property, for all operators."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, n_lines string, "
    "fingerprint string, spans string, n_words string, verdict string"
)
SYLLABLES = "ba ke lo mi nu ra se ti vo zu één ñol ße".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    out = ["".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(n)]
    for i in range(0, n, 11):
        out[i] = out[i].capitalize() + r.choice([".", ",", "\n", ""])
    return " ".join(out)


def texts() -> list[str | None]:
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    return [
        None, "", " \t\n ", "one", "Two words", base, base, " ".join(near), prose(2, 40), prose(3, 400),
        "x" * 150_000, prose(4, 30_000), "\n".join(["Same line", "SAME LINE ", "other"] * 3), "á İ ẞ \U0001f600 \x00 é",
    ]


def rows() -> list[tuple]:
    """Null and repeated ids, a repeated row, columns named like those of operators."""
    made = [(i, t) for i, t in enumerate(texts())] + [(None, prose(5, 20)), (None, None), (5, texts()[5]), (9, "other text of nine")]
    return [(i, t, None if n % 2 else "en", "s", n, "own", "own", "own", "own", "own", "own") for n, (i, t) in enumerate(made)]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def docs_of(spark, pairs):
    return spark.createDataFrame(list(pairs), "doc_id long, text string")
