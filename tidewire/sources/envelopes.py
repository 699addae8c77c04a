"""Stage envelopes `{ingestion_time, articles: [...]}` and flat article lists."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewire.functions.basics import bind
from tidewire.functions.dates import parse_date
from tidewire.functions.text import strip
from tidewire.schemas import ENVELOPE, RAW_ARTICLE


def read_bodies(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """(path, body): a document per file, or per line where many were written to one file."""
    return spark.read.text(path, wholetext=one_per_file).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("body")
    )


def parse_envelopes(bodies: DataFrame, column: str = "body") -> DataFrame:
    """One row per article element: the other columns, `ingestion_time`, `entry_ord`, `element`.

    An envelope or a bare list is told apart by the first character. Elements stay text, because an
    element may be an object or a string with an encoded object. Unreadable bodies give no rows.
    """
    kept = [c for c in bodies.columns if c != column]
    text = strip(F.col(column))
    as_list = F.from_json(F.concat(F.lit('{"articles":'), text, F.lit("}")), ENVELOPE)
    envelope = F.when(text.startswith("["), as_list).otherwise(F.from_json(text, ENVELOPE))
    return bodies.select(*kept, envelope.alias("_e")).select(
        *kept,
        parse_date(F.col("_e.ingestion_time")).alias("ingestion_time"),
        F.posexplode("_e.articles").alias("entry_ord", "element"),
    )


def as_article(element: Column) -> Column:
    """The element as an article struct; NULL when it holds no JSON object."""
    parsed = F.from_json(element, RAW_ARTICLE)
    is_object = F.schema_of_variant(F.try_parse_json(element)).startswith("OBJECT")
    return F.when(is_object, parsed)


def repair_rows(elements: DataFrame, column: str = "element") -> DataFrame:
    """Elements to article columns; strings that are no encoded object and other types are dropped."""
    kept = [c for c in elements.columns if c != column]
    return (
        elements.select(*kept, bind(F.col(column), as_article).alias("_a"))
        .where(F.col("_a").isNotNull())
        .select(*kept, "_a.*")
    )


_UNREADABLE = "_unreadable"


def article_rows(bodies: DataFrame, column: str = "body") -> DataFrame:
    """Every element of every body with its article columns; what cannot be read is kept with a reason.

    Adds `ingestion_time`, `entry_ord`, the article columns, `error` and `origin`. A body that is no
    envelope or list, one without elements and an element that is no article give one row each, with their text in
    `origin`; readable rows have a NULL `error`. So no body goes missing, and the rows with and without an error come
    from one pass.
    """
    kept = [c for c in bodies.columns if c != column]
    text = strip(F.col(column))
    shape = StructType([*ENVELOPE, StructField(_UNREADABLE, StringType())])
    options = {"columnNameOfCorruptRecord": _UNREADABLE}
    as_list = F.from_json(F.concat(F.lit('{"articles":'), text, F.lit("}")), shape, options)
    envelope = F.when(text.startswith("["), as_list).otherwise(F.from_json(text, shape, options))
    read = bodies.select(*kept, F.col(column).alias("_body"), envelope.alias("_e"))
    elements = F.when(F.size("_e.articles") > 0, F.col("_e.articles"))
    opened = read.select(
        *kept, "_body", F.col("_e").alias("_e"), parse_date(F.col("_e.ingestion_time")).alias("ingestion_time"),
        F.posexplode_outer(elements).alias("entry_ord", "_element"),
    )
    opened = opened.select("*", bind(F.col("_element"), as_article).alias("_a"))
    error = (
        F.when(F.col("_e").isNull() | F.col(f"_e.{_UNREADABLE}").isNotNull(), "unreadable envelope")
        .when(F.col("entry_ord").isNull(), "no articles")
        .when(F.col("_a").isNull(), "unreadable article")
    )
    origin = F.when(F.col("entry_ord").isNull(), F.col("_body")).when(F.col("_a").isNull(), F.col("_element"))
    return opened.select(
        *kept, "ingestion_time", "entry_ord", "_a.*", error.alias("error"), origin.alias("origin")
    )


def read_envelopes(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Article rows of all envelopes under a path; a path that does not exist gives no rows."""
    try:
        bodies = read_bodies(spark, path, one_per_file)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        bodies = spark.createDataFrame([], "path string, body string")
    return repair_rows(parse_envelopes(bodies))


def with_feed_order(articles: DataFrame, feeds: DataFrame) -> DataFrame:
    """Add `feed_ord` of each article's source from a registry (source, feed_ord); others come last.

    With `ingestion_time` and `entry_ord` this is the order in which copies of an article win.
    """
    known = feeds.select(F.col("source").alias("_source"), F.col("feed_ord").cast("int").alias("feed_ord"))
    joined = articles.join(known, F.col("source") == F.col("_source"), "left").drop("_source")
    return joined.withColumn("feed_ord", F.coalesce("feed_ord", F.lit(2**31 - 1)))


def write_envelopes(df: DataFrame, path: str) -> None:
    """JSON lines of envelopes; `df` has `ingestion_time` and `articles`."""
    df.select("ingestion_time", "articles").write.mode("overwrite").json(path)
