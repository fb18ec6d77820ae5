"""Tables of awkward documents that every operator has to take."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use for columns of their own.
    T.StructField("score", T.StringType()), T.StructField("node", T.ArrayType(T.IntegerType())), T.StructField("spans", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("n", T.DoubleType()), T.StructField("kept_key", T.StringType()),
    T.StructField("cut_id", T.StringType()), T.StructField("a.b", T.StringType()),
])

LONG = "\n".join(f"Line {i} of a very long text has its own number {i * 7919}." for i in range(30_000))


def row(doc_id, text, lang=None):
    return (doc_id, text, lang, None, None if text is None else len(text), "s", [1], "x", "i", 1.5, "k", "c", "tick")


ROWS = [
    row(1, "The quick brown fox jumps over the lazy dog and runs far away from here.", "en"),
    row(1, "The quick brown fox jumps over the lazy dog and runs far away from here.", "en"),
    row(2, "The quick brown fox jumps over the lazy dog and runs far away from here.", "en"),
    row(3, None, "en"), row(4, "", None), row(5, " \n\t ", "de"), row(6, "word", "en"), row(7, "12345 !!", "fr"),
    row(8, "Der schnelle braune Fuchs springt über den faulen Hund und läuft weit weg.", "de"),
    row(9, LONG, "en"), row(10, "x" * 200_000, None), row(None, "no id here", "en"), row(None, None, None),
    row(11, "naïve 漢字 😀 \x00 tail", None), row(3, "same id, another text", "en"),
]


def docs(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, DOCS)


def simple(spark, texts, langs=None):
    """Documents numbered from 0 with the given texts."""
    langs = langs or [None] * len(texts)
    return docs(spark, [row(i, t, lang) for i, (t, lang) in enumerate(zip(texts, langs))])


def empty(spark):
    return docs(spark, [])
