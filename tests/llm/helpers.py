"""Small tables with awkward rows, for all operators."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASHING = ["block", "payload", "bucket", "fp", "key", "rank", "label", "score", "length", "piece", "digest", "component_id",
            "kept", "starts", "features", "term", "sequence_id", "carried0", "text_2", "__id", "__digest", "__rn", "__text", "kept_id",
            "kept_digest", "row", "id", "own", "stays", "low", "root"]

LONG = " ".join(f"word{i % 977} and{i % 13}." for i in range(60_000))
SHARED = "this passage of well over fifty bytes stands in several of the documents here"
TEXTS = [
    (5, "Der schöne Tag. " + SHARED + " Ende é."),
    (1, "first one, " + SHARED + " and more of the first one"),
    (2, "first one, " + SHARED + " and more of the first one"),
    (3, ""),
    (4, None),
    (None, "no id but " + SHARED),
    (9, "a"),
    (9, "a"),
    (9, "another text with the same id, " + SHARED),
    (7, "Ż́  　 tabs\tand\r\nlines\n\n\x0b\x0c🙂 中文 <|endoftext|> <|startoftext|> !!"),
    (-3, "negative ids are ids, " + SHARED.upper()),
    (8, "x" * 3000),
    (10, "ab " * 700),
]


def documents(spark, rows=None, long=True, clashing=True):
    """Rows of (doc_id, text) as documents, with columns of clashing names."""
    rows = list(TEXTS if rows is None else rows) + ([(100, LONG), (101, LONG[7:])] if long else [])
    df = spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], SCHEMA)
    df = df.repartition(3)
    if clashing:
        for n, c in enumerate(CLASHING):
            df = df.selectExpr("*", f"{n} AS {c}")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
