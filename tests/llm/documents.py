"""Documents that hold every awkward case, for the tests of text operators."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SHAPE = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
     T.StructField("n_chars", T.LongType())]
)
#: Columns whose names the operators use inside.
CLASHING = ["doc", "key", "size", "score", "copies", "bucket", "rest", "id", "h", "uid", "kind", "label"]


def words(seed: int, count: int, vocabulary: int = 40) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(count))


def odd_documents(seed: int = 0) -> list[tuple]:
    """Null, empty, blank, short and very long texts, copies, shared passages and repeated rows."""
    passage = words(99, 60, 500)
    rows = [(k, words(seed * 1000 + k, 5 + 7 * k % 180, 300)) for k in range(1, 60)]
    rows += [(k + 100, rows[k][1]) for k in range(0, 60, 9) if k < len(rows)]
    rows += [(k + 200, f"{words(k, 20, 300)} {passage}\n{words(k + 1, 9, 300)}") for k in range(12)]
    near = words(7, 150, 900).split()
    for k in range(6):
        changed = list(near)
        changed[20 * k] = f"changed{k}"
        rows.append((300 + k, " ".join(changed)))
    rows += [
        (400, None), (401, ""), (402, " \n\t "), (403, "one"), (404, "one"), (405, "a " * 40),
        (406, "a " * 55), (407, words(5, 30_000, 4000)), (408, "Ünï çødé ‘x’ 漢字 \x1c tab\tx  y\r\nz"),
        (409, "<|endoftext|> it's 3.14, U.S.A."), (None, rows[3][1]), (None, None), rows[4], rows[4],
        (-5, words(11, 50, 300)),
    ]
    out = []
    for n, (key, text) in enumerate(rows):
        source = None if n % 11 == 0 else "hot" if n % 3 == 0 else f"s{n % 5}"
        out.append((key, text, "en" if n % 4 else None, source, None if text is None else len(text)))
    return out


def frame(spark, rows, extra=True):
    base = spark.createDataFrame(rows, SHAPE)
    if not extra:
        return base
    from pyspark.sql import functions as F

    return base.select("*", *[F.lit(name).alias(name) for name in CLASHING])
