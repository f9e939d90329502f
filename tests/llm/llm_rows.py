"""Rows that every operator on documents must handle: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, node long, h string, ids string, "
          "spans string, g string, salt int, _out string, rank int")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 99)) for _ in range(n))


def edge_texts() -> list:
    base = prose(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    return [(1, base, "en", "a"), (2, base, "en", "b"), (3, near, None, None), (4, None, "en", "a"), (5, "", "en", "a"),
            (6, " \n\t ", "de", "a"), (7, prose(7, 4), "de", "b"), (8, prose(8, 30_000), "en", "c"), (9, "x" * 50_000, "en", "c"),
            (1, base, "en", "a"), (None, prose(9, 80), "en", "a"), (None, None, None, None), (10, "\n\n\n", "fr", "d"),
            (11, "日本語 текст ñandú 😀 " * 20, "fr", "d")]


def edge_docs(spark):
    rows = [(i, t, l, s, len(t or ""), 5, "h", "ids", "spans", "g", 3, "o", 1) for i, t, l, s in edge_texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
