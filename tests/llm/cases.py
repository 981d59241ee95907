"""Documents with what data can hold: nulls, empty and long texts, ties, repeats, odd columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(draw: random.Random, n: int, size: int = 400) -> str:
    return " ".join(f"w{draw.randrange(size)}" for _ in range(n))


def corpus(seed: int = 1) -> list[tuple]:
    draw = random.Random(seed)
    base = [words(draw, n) for n in (40, 60, 80, 25, 9, 3, 2, 1)]
    near = [b.replace("w1", "w1x", 1) + " tail" for b in base[:3]]
    passage = words(draw, 60)
    texts = [
        *base, *near, base[0], base[0], f"{words(draw, 20)} {passage} {words(draw, 15)}", f"{words(draw, 30)}\n{passage}",
        None, None, "", " \t\n", "É" + base[1].upper(), "ñ ü ß ☃ 🎈 " * 30, "a" * 700, "ab " * 300, words(draw, 4000, 50),
    ]
    rows = [(3 * k + 1, t, None, "src", len(t or "")) for k, t in enumerate(texts)]
    return [*rows, rows[0], rows[3], (None, base[2], None, None, None), (None, None, None, None, None), (rows[1][0], "another text of this id", "en", None, 1)]


def documents(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, SCHEMA)
