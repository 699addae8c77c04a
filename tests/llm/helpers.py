"""Rows that every document operator has to take."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "word%d another%d thing%d. "


def long_text(n=20_000):
    return "\n".join(" ".join(f"w{i}x{k}" for k in range(10)) for i in range(n // 10))


def odd_rows():
    """NULLs, empty and long texts, ties and repeated rows."""
    text = " ".join(f"token{i}" for i in range(80))
    return [
        (1, None, "en", "s", None), (2, "", "en", "s", 0), (None, text, "en", None, 5), (3, text, None, "s", 5),
        (3, text, None, "s", 5), (4, "   \n\t ", None, None, None), (5, long_text(), "de", "s", 9),
        (None, None, None, None, None), (6, text + " more", "en", "s", 5), (7, "漢字 😀 é́", "zh", "s", 5),
    ]


def odd_docs(spark, *names):
    """The odd rows, with further columns under the given names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows(), DOCS)
    return df.withColumns({n: F.lit("clash") for n in names}) if names else df


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)
