"""Small tables with every awkward case, shared by the operators' tests."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: A documents table with columns whose names the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, part int, fp long, doc long, hash long, tokens string, length long"
LONG = " ".join(f"palabra{i % 977} tramo{i % 31}" for i in range(20_000))
LINE = "this very line is found in several of the documents"


def rows() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    out: list[tuple[int | None, str | None]] = [
        (0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "One two"), (5, "one two three"), (6, LONG), (7, LONG), (8, LONG + "\n" + LINE),
        (9, f"{LINE}\nfirst line here\n  {LINE.upper()} \n"), (10, f"second text\n{LINE}"), (11, f"{LINE}\r\nthird\n\n{LINE}"), (None, LINE),
        (12, "a\x0bb\x0cc\x1cd\xa0e"), (13, "ñandú ÑANDÚ ß İ Σ"), (14, "ñandú ÑANDÚ ß İ Σ"), (14, "ñandú ÑANDÚ ß İ Σ"), (15, "日本語 テキスト\nですね"),
        (16, "one two  three"), (17, "onetwothree"), (None, None), (None, "without an id"), (18, "12345 !!! ???"), (-5, "negative id"),
        (19, "\n\n\n"), (20, "x" * 5000), (21, "<|endoftext|> in the text"),
    ]
    for i in range(40):
        out.append((100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 200)))))
    base = [rng.choice(words) + str(k % 7) for k in range(400)]
    for i in range(12):  # near copies: a word or two differ
        copy = list(base)
        copy[rng.randrange(400)] = "other"
        out.append((200 + i, " ".join(copy)))
    out += [(300 + i, "the same text for a hot group of copies") for i in range(60)]
    return out


def documents(spark: SparkSession, own: list[tuple[int | None, str | None]] | None = None) -> DataFrame:
    table = [(i, t, "en" if (i or 0) % 2 else None, "s", None, 7, 7, 7, 7, 7, "clash", 7) for i, t in (rows() if own is None else own)]
    return spark.createDataFrame(table, SCHEMA).repartition(5)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
