"""Shared rows for the operators' edge cases."""

LONG = " ".join(f"wort{i % 997}" for i in range(20_000))
WEIRD = "é\u00a0ß \x0b\x0c#\t\n\n!!  🎈 <a> |x|\r\n" * 3
#: Null, empty, blank, long and odd texts, repeated rows, ties and a null id; extra columns have clashing names.
EDGE = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4), (4, LONG, "de", "b", len(LONG)),
    (5, WEIRD, "fr", None, 9), (6, "the same text twice here", "en", "a", 24), (6, "the same text twice here", "en", "a", 24),
    (7, "the same text twice here", "de", "c", 24), (None, "no id but a text of some words", None, "c", 30), (8, "word", "en", "b", 4),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["score", "kept", "fp", "host", "n_words", "rule", "predicted", "component_id", "root", "n", "gram", "key", "_text", "_row", "value"]


def edge_docs(spark, extra=True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE, COLUMNS)
    return df.withColumns({c: F.lit("clash") for c in CLASHES}) if extra else df


def empty_docs(spark):
    return spark.createDataFrame([], COLUMNS)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)
