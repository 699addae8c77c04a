"""Landed feed documents (RSS and Atom) to article rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tidewire import fixed_values as fv
from tidewire.operators.ordered import row_index


def _record(*names: str, extra: tuple[StructField, ...] = ()) -> StructType:
    return StructType([*[StructField(n, StringType()) for n in names], *extra])


_ITEM = _record("title", "description", "content:encoded", "link", "pubDate", "updated", "dc:date")
_LINK = ArrayType(_record("_href", "_rel"))
_TEXT = ArrayType(_record("_VALUE", "_type"))
_ENTRY = _record("published", "updated", extra=(
    StructField("title", _TEXT), StructField("summary", _TEXT), StructField("content", _TEXT),
    StructField("link", _LINK),
))
_DOCUMENT = StructType([
    StructField("channel", StructType([StructField("item", ArrayType(_ITEM))])),
    StructField("entry", ArrayType(_ENTRY)),
])


def registry(spark: SparkSession) -> DataFrame:
    """The known feeds: (feed_ord, source, url)."""
    rows = [(i, name, url) for i, (name, url) in enumerate(fv.FEEDS)]
    return spark.createDataFrame(rows, "feed_ord int, source string, url string")


def _filled(*choices: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices])


def _or_empty(*choices: Column) -> Column:
    return F.coalesce(_filled(*choices), F.lit(""))


def _rss(item: Column) -> Column:
    return F.struct(
        _or_empty(item["title"]).alias("title"),
        _or_empty(item["description"], item["content:encoded"]).alias("content"),
        _or_empty(item["link"]).alias("url"),
        _filled(item["pubDate"], item["updated"], item["dc:date"]).alias("raw_published_at"),
    )


def _atom(entry: Column) -> Column:
    def text(name: str) -> Column:
        return F.get(entry[name], F.lit(0))["_VALUE"]

    page = F.filter(
        entry["link"], lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate"
    )
    return F.struct(
        _or_empty(text("title")).alias("title"),
        _or_empty(text("summary"), text("content")).alias("content"),
        _or_empty(F.get(page, F.lit(0))["_href"]).alias("url"),
        _filled(entry["published"], entry["updated"]).alias("raw_published_at"),
    )


_EMPTY = "array<struct<title:string,content:string,url:string,raw_published_at:string>>"


def _items(document: Column, limit: int | None) -> Column:
    """The entries of a parsed document, RSS items first."""
    empty = F.array().cast(_EMPTY)
    items = F.concat(
        F.coalesce(F.transform(document["channel"]["item"], _rss), empty),
        F.coalesce(F.transform(document["entry"], _atom), empty),
    )
    return items if limit is None else F.slice(items, 1, limit)


def feed_rows(documents: DataFrame, limit: int | None = None) -> DataFrame:
    """Like `parse_feed_items`, but every document gives rows: what has no entries says why in `error`.

    A document that was not fetched, one that is no XML and one without entries give one row each without
    article, with the body in `origin`; rows of entries have a NULL `error`. One pass makes both.
    """
    kept = [c for c in documents.columns if c not in ("status", "body")]
    shape = StructType([*_DOCUMENT, StructField("_unreadable", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unreadable"}
    fetched = F.coalesce(F.col("status") == 200, F.lit(False))
    parsed = documents.select("*", F.when(fetched, F.from_xml("body", shape, options)).alias("_doc"))
    error = (
        F.when(~fetched, F.concat_ws(" ", F.lit("status"), F.col("status").cast("string")))
        .when(F.col("_doc").isNull() | F.col("_doc._unreadable").isNotNull(), "unreadable document")
    )
    items = _items(F.col("_doc"), limit)
    opened = parsed.select(
        *kept, "body", error.alias("_error"), F.posexplode_outer(F.when(error.isNull() & (F.size(items) > 0), items)).alias("entry_ord", "_item")
    )
    missing = F.col("entry_ord").isNull()
    return opened.select(
        *kept, "entry_ord", "_item.*", F.coalesce("_error", F.when(missing, "no entries")).alias("error"),
        F.when(missing, F.col("body")).alias("origin"),
    )


def parse_feed_items(documents: DataFrame, limit: int | None = None) -> DataFrame:
    """(source, feed_ord, status, body, ...) to raw article rows with `entry_ord`.

    Documents whose fetch did not return 200, and unreadable ones, give no rows; the others go on.
    All entries are used, or the first `limit` of each document.
    """
    kept = [c for c in documents.columns if c not in ("status", "body")]
    parsed = documents.where(F.col("status") == 200).select(
        *kept, F.from_xml("body", _DOCUMENT, {"mode": "PERMISSIVE"}).alias("_doc")
    )
    return parsed.select(
        *kept, F.posexplode(_items(F.col("_doc"), limit)).alias("entry_ord", "_item")
    ).select(*kept, "entry_ord", "_item.*")


def failed_documents(documents: DataFrame) -> DataFrame:
    """Documents that give no rows because the fetch failed."""
    return documents.where(F.coalesce(F.col("status") != 200, F.lit(True)))


# The element that holds an entry, its schema, and how it becomes an article, by kind of feed.
KINDS = {"rss": ("item", _ITEM, _rss), "atom": ("entry", _ENTRY, _atom)}


def read_feed_files(
    spark: SparkSession, path: str, kind: str = "rss", files: DataFrame | None = None, limit: int | None = None
) -> DataFrame:
    """Entries of RSS or Atom files with `path` and `entry_ord`; one large file is many tasks' work.

    Files are split as text at the end of each entry, so no task reads a whole document. The order of entries comes from
    counting them: each split numbers its own, and the splits before it in the file say where it begins. What
    stands between the root and the first entry is not looked at, and a file need not be well-formed outside its entries. An
    entry that cannot be read is a row without url.

    `files` (file name, source, feed_ord, status) says what a file is; its columns are added, and files that were not
    fetched with status 200 give no rows.
    """
    tag, schema, article = KINDS[kind]
    rows = spark.read.option("lineSep", f"</{tag}>").text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    opening = F.regexp_instr("value", F.lit(rf"<{tag}[\s>]"))
    entries = rows.where(opening > 0).withColumn("value", F.concat(F.substr("value", opening), F.lit(f"</{tag}>")))
    ordered = row_index(entries, ["path"], ["_row"], F.col("_block"), "entry_ord")
    if limit is not None:
        ordered = ordered.where(F.col("entry_ord") < limit)
    read = ordered.select("path", F.col("entry_ord").cast("int").alias("entry_ord"), F.from_xml("value", schema).alias("_e"))
    found = read.select("path", "entry_ord", article(F.col("_e")).alias("_a")).select("path", "entry_ord", "_a.*")
    if files is None:
        return found
    known = files.where(F.col("status") == 200).select(F.col("file").alias("_file"), "source", "feed_ord")
    return found.join(known, F.element_at(F.split("path", "/"), -1) == F.col("_file")).drop("_file")


def read_rss_files(spark: SparkSession, path: str) -> DataFrame:
    """Items straight from RSS files, split at `<item>` so that one large file is many tasks' work."""
    items = spark.read.format("xml").option("rowTag", "item").schema(_ITEM).load(path)
    return items.select(_rss(F.struct(*[F.col(f"`{c}`") for c in _ITEM.fieldNames()])).alias("i")).select("i.*")
