"""Small tables with the awkward rows every operator has to bear."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    syllables = ["an", "ti", "re", "lo", "mé", "ku", "sta", "or", "ühl", "ñe"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", ",", ".\n"])
                    for _ in range(n))


def awkward() -> list[tuple]:
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    base = prose(1, 300)
    words = base.split(" ")
    near = " ".join([*words[:150], "changed", *words[151:]])
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, near, None, "b", 2), (3, near, None, "b", 2),
        (4, None, None, None, None), (5, "", "en", "a", 0), (6, " \n\t ", "en", "b", 4), (None, "no id here", "en", "a", 1),
        (None, base, "en", "c", 1), (7, "one two", "en", "a", 7), (8, "ONE two", "en", "c", 7), (9, prose(2, 60_000), "de", "c", 1),
        (10, "x" * 3000, "en", "a", 1), (11, "Same line here\n" * 40, "en", "b", 1), (12, prose(3, 40) + " " + base, "en", "a", 1),
        (13, "é" * 30, "fr", "a", 30), (14, "é" * 31, "fr", "b", 31), (15, "# * $ % & | < > !!", "en", None, 9),
    ]
    return rows + [(100 + i, prose(100 + i, 50 + i), "en", "abc"[i % 3], i) for i in range(30)]


def frame(spark, rows=None, extra: bool = False):
    """The rows as a table; with ``extra`` it has more columns, named like results of operators."""
    out = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
    if extra:
        for name in ("score", "size", "target", "rank", "part", "n", "spans", "copies", "state", "token", "node"):
            out = out.selectExpr("*", f"'clash' AS {name}")
    return out
