"""Documents with nulls in every column, empty and very long texts, ties,
repeated rows and extra columns whose names an operator might use itself."""

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}" for i in range(60_000))
TEXT = " ".join(f"alpha{i}" for i in range(80))

ROWS = [
    (1, TEXT, "en", "a", len(TEXT)),
    (1, TEXT, "en", "a", len(TEXT)),            # repeated row
    (2, TEXT, "en", "a", len(TEXT)),            # exact copy
    (3, TEXT + " beta", "en", "a", None),       # near copy
    (4, None, "en", "a", 0),
    (5, "", None, None, 0),
    (6, " \t\n\x0b ", "en", "a", 5),
    (None, TEXT + " gamma", "en", "a", 7),      # near copy without id
    (None, None, None, None, None),
    (7, LONG, "en", "b", len(LONG)),
    (8, "x" * 200_000, "en", "b", 200_000),     # one very long word
    (9, "9" * 100_000 + "@", "en", "b", 1),
    (10, "one two three", "en", "b", 13),
    (11, "One  TWO\nthree", "en", "b", 14),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["row", "node", "host", "text_hash", "kept", "blob", "gone", "cut", "label", "found", "n", "path", "rate"]


def documents(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def with_extra(df):
    for i, c in enumerate(EXTRA):
        df = df.withColumn(c, F.lit(i if i % 2 else f"extra{i}"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
