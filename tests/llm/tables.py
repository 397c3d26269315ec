"""Small tables with the cases that every operator must handle."""

from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, n_words string, label string, uid string, c long"

PROSE = (
    "The river ran past the old mill and under the stone bridge before it reached the lake. "
    "Children came there in summer to swim, and in winter the ice was thick enough to cross. "
    "Nobody in the village remembered who had built the mill or when the wheel had last turned."
)


def documents(spark, rows):
    """Documents of (id, text), with columns whose names the operators use themselves."""
    full = [(i, t, "en", "src0", None if t is None else len(t), 0.5, "x", "y", "z", "u", 7) for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def odd(extra=()):
    """Null and empty texts, a null id, white space, repeated rows, ties, one very long text."""
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, PROSE),
        (4, PROSE),
        (5, PROSE),
        (6, "word"),
        (7, "Two words"),
        (None, PROSE.replace("river", "stream")),
        (None, None),
        (8, " ".join(f"w{k}" for k in range(30_000))),
        (9, "é́ 日本語 \U0001f469‍\U0001f467 x" * 5),
        *extra,
    ]


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def empty(spark, ddl):
    return spark.createDataFrame([], T.StructType.fromDDL(ddl))
