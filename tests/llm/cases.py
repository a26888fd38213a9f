"""Small tables with the cases that every operator must take: nulls, empties, long texts, ties, repeats, clashing names."""

import random

from pyspark.sql import types as T

SYLLABLES = "ka to mi ren sol ver da pu lin os ter an be ci fro".split()


def words(r: random.Random, n: int) -> list[str]:
    return ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n)]


def documents(seed: int = 3) -> list[tuple]:
    """(doc_id, text) rows."""
    r = random.Random(seed)
    base = words(r, 150)
    passage = " ".join(words(r, 60))
    rows = [(0, None), (1, ""), (2, "a"), (3, "Ein Wort"), (4, " \n\t "), (5, "a" * 500), (6, "ab" * 400), (7, "é" * 150), (8, "nul\x00 byte \x01")]
    rows += [(10, " ".join(base)), (11, " ".join(base)), (12, " ".join(base).upper())]
    for i in range(20, 32):  # near copies with more and more changes
        w = list(base)
        for _ in range(i - 19):
            w[r.randrange(len(w))] = r.choice(SYLLABLES)
        rows.append((i, " ".join(w)))
    for i in range(40, 55):  # a shared passage
        rows.append((i, " ".join(words(r, r.randint(5, 60))) + " " + passage + "\n" + " ".join(words(r, r.randint(5, 60)))))
    rows.append((60, " ".join(words(r, 30_000))))
    rows.append((61, rows[-1][1][:100_000]))
    rows += [(70, "one two three"), (71, "one two three"), (72, "one two four")]
    rows += [(80, rows[9][1]), (80, rows[9][1]), (None, "no id here at all"), (None, passage)]
    return rows


CLASHING = ["digest", "t", "n", "h", "score", "_row", "word", "features", "rate", "lang", "source", "n_chars"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.LongType() if c == "n_chars" else T.StringType()) for c in CLASHING]
)


def frame(spark, rows: list[tuple], parts: int = 3):
    wide = [(i, t, *["x"] * (len(CLASHING) - 1), len(t or "")) for i, t in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(parts)


def tuples(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
