"""Sources, stage tables, the feature table and streams."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewire.operators.articles import normalize_articles
from tidewire.operators.windows import with_momentum
from tidewire.schemas import FEATURE_COLUMNS, FEATURES
from tidewire.sources import envelopes, feeds, store, tables
from tidewire.streaming import news

ARTICLE = {"title": "Bitcoin", "content": "c", "url": "u1", "source": "s", "raw_published_at": "2024-01-01"}


def hour(h, day=1):
    return datetime(2024, 1, day, h)


def test_envelope_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"ingestion_time": "2024-01-01T05:00:00Z", "articles": [
        ARTICLE, json.dumps({**ARTICLE, "url": "u2"}), "broken {", 5, None, [1], "[1]",
    ]}, indent=2))
    (tmp_path / "b.json").write_text("\n [" + json.dumps({**ARTICLE, "url": "u3"}) + "]")
    (tmp_path / "c.json").write_text("not json")
    (tmp_path / "d.json").write_text('{"ingestion_time": "2024-01-01T05:00:00Z"}')
    got = envelopes.read_envelopes(spark, str(tmp_path)).collect()
    assert {(r.url, r.ingestion_time, r.entry_ord) for r in got} == {
        ("u1", hour(5), 0), ("u2", hour(5), 1), ("u3", None, 0)
    }
    assert envelopes.read_envelopes(spark, str(tmp_path / "nowhere")).count() == 0


RSS = """<rss><channel><title>Feed</title>
<item><title><![CDATA[A <b>bold</b> &amp; x]]></title><description>&lt;p&gt;text&lt;/p&gt;</description>
<link> u1 </link><pubDate>Tue, 02 Jan 2024 03:04:05 +0200</pubDate></item>
<item><title>B</title><link>u2</link><pubDate></pubDate><updated>2024-01-02</updated></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title type="html">C</title><summary>s</summary>
<link rel="self" href="no"/><link rel="alternate" href="u3"/><updated>2024-01-03</updated></entry></feed>"""


def test_feeds(spark, tmp_path):
    rows = [(0, "rss", 200, RSS), (1, "atom", 200, ATOM), (2, "gone", 404, RSS), (3, "junk", 200, "<rss><ch"),
            (4, "empty", 200, "<rss><channel></channel></rss>"), (5, "none", None, None)]
    docs = spark.createDataFrame(rows, "feed_ord int, source string, status int, body string")
    got = {r.url: r for r in feeds.parse_feed_items(docs).collect()}
    assert set(got) == {"u1", "u2", "u3"}
    assert got["u1"].title == "A <b>bold</b> &amp; x" and got["u1"].content == "<p>text</p>"
    assert (got["u2"].content, got["u2"].raw_published_at, got["u2"].entry_ord) == ("", "2024-01-02", 1)
    assert (got["u3"].title, got["u3"].content, got["u3"].source) == ("C", "s", "atom")
    assert {r.source for r in feeds.failed_documents(docs).collect()} == {"gone", "none"}
    (tmp_path / "feed.xml").write_text(RSS)
    assert {r.url for r in feeds.read_rss_files(spark, str(tmp_path)).collect()} == {"u1", "u2"}
    assert feeds.registry(spark).count() == 71


def test_candles(spark):
    landed = spark.createDataFrame(
        [("S", str(1704067200000), "1.5", "2", "x", "1.75", "10")],
        "symbol string, ms string, open string, high string, low string, close string, volume string",
    )
    row = tables.cast_candles(landed, epoch_millis="ms").first()
    assert (row.open_time, row.open, row.low, row.close) == (hour(0), 1.5, None, 1.75)


def test_stage_overwrites_only_its_hours(spark, tmp_path):
    path = str(tmp_path / "stage")
    schema = "window_start timestamp_ntz, id string"
    store.write_stage(spark.createDataFrame([(hour(1), "a"), (hour(2), "b"), (hour(2, 2), "c")], schema), path)
    store.write_stage(spark.createDataFrame([(hour(2), "new")], schema), path)
    store.write_stage(spark.createDataFrame([(hour(2), "new")], schema), path)
    assert sorted(r.id for r in store.read_stage(spark, path).collect()) == ["a", "c", "new"]
    assert [r.id for r in store.read_stage(spark, path, "2024-01-02", "2024-01-03").collect()] == ["c"]


def feature_rows(spark, rows):
    return spark.createDataFrame(rows, "window_start timestamp_ntz, article_count int, avg_sentiment double")


def test_upsert(spark, tmp_path):
    table = store.FeatureStore(spark, str(tmp_path / "features"))
    assert table.read().count() == 0
    table.upsert(feature_rows(spark, [(hour(1), 1, 0.1), (hour(2), 2, 0.2), (hour(1, 2), 3, 0.3)]), 1)
    first = {r.window_start: r.created_at for r in table.stored().collect()}
    second = feature_rows(spark, [(hour(2), 9, None), (hour(3), 4, 0.4)])
    for _ in range(2):
        table.upsert(second, 2)
        got = {r.window_start: (r.article_count, r.avg_sentiment) for r in table.read().collect()}
        assert got == {hour(1): (1, 0.1), hour(2): (9, None), hour(3): (4, 0.4), hour(1, 2): (3, 0.3)}
    table.upsert(feature_rows(spark, [(hour(2), 5, 0.5)]), 2)
    assert table.read().where("article_count = 5").count() == 1
    table.upsert(feature_rows(spark, [(hour(2), 6, 0.0)]), 1)
    assert [r.article_count for r in table.read().where(F.col("window_start") == hour(2)).collect()] == [6]
    later = {r.window_start: r.created_at for r in table.stored().collect()}
    assert later[hour(1)] == first[hour(1)] and later[hour(2)] > first[hour(2)]
    assert [r.window_start for r in table.latest(2).collect()] == [hour(1, 2), hour(3)]
    assert table.read().columns == list(FEATURE_COLUMNS) and len(FEATURE_COLUMNS) == 60
    table.upsert(feature_rows(spark, []), 3)
    assert table.read().count() == 4


def test_create_keeps_rows(spark, tmp_path):
    table = store.FeatureStore(spark, str(tmp_path / "features"))
    table.create()
    assert table.read().count() == 0
    table.upsert(feature_rows(spark, [(hour(1), 1, 0.1)]), 1)
    table.create()
    assert table.read().count() == 1


def test_momentum_refresh(spark, tmp_path):
    table = store.FeatureStore(spark, str(tmp_path / "features"))
    table.upsert(feature_rows(spark, [(hour(23), 1, 0.1), (hour(1, 2), 1, 0.4)]), 1)
    table.refresh_momentum()
    table.upsert(feature_rows(spark, [(hour(0, 2), 1, 0.2)]), 2)
    table.refresh_momentum()
    got = {r.window_start: r.sentiment_momentum for r in table.read().collect()}
    assert got == {hour(23): 0.0, hour(0, 2): 0.1, hour(1, 2): 0.2}


def test_json_keeps_nulls(spark):
    features = feature_rows(spark, [(hour(1), 1, None)]).to(FEATURES)
    text = store.features_as_json(features).first().document
    document = json.loads(text)
    assert list(document) == list(FEATURE_COLUMNS)
    assert document["window_start"] == "2024-01-01T01:00:00+00:00" and document["avg_sentiment"] is None
    back = store.features_from_json(spark.createDataFrame([(text,)], "document string")).first()
    assert back.window_start == hour(1) and back.article_count == 1


def _land(folder, name, articles):
    (folder / name).write_text(json.dumps({"ingestion_time": "2024-01-01T09:00:00Z", "articles": articles}, indent=1))


def _article(url, time, title="Bitcoin hack and more"):
    return {"title": title, "content": "text of it", "url": url, "source": "decrypt", "raw_published_at": time}


def _run(spark, folder, table, checkpoint):
    raw = news.read_envelope_stream(spark, str(folder))
    judged = normalize_articles(raw).withColumn("is_noise", F.lit(False))
    news.write_features(news.window_feature_stream(judged), table, str(checkpoint)).awaitTermination()


def test_clean_stream(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    _land(folder, "1.json", [_article("u1", "2024-01-01 05:10")] * 3 + [_article("u2", "2024-01-01 06:10")])
    _land(folder, "2.json", [_article("u1", "2024-01-01 05:10"), _article("", "2024-01-01 05:10")])
    cleaned = news.clean_stream(news.read_envelope_stream(spark, str(folder)))
    news.write_clean(cleaned, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["u1", "u2"]


def test_stream_over_batches(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    table = store.FeatureStore(spark, str(tmp_path / "features"))

    def counts():
        return {r.window_start: (r.article_count, r.total_raw) for r in table.read().collect()}

    _land(folder, "1.json", [_article("u1", "2024-01-01 05:10"), _article("u1", "2024-01-01 05:20"),
                             _article("u2", "2024-01-01 05:30", "Nothing"), _article("u3", "2024-01-01 06:00")])
    _run(spark, folder, table, tmp_path / "cp")
    assert counts() == {hour(5): (1, 2), hour(6): (1, 1)}
    _land(folder, "2.json", [_article("u1", "2024-01-01 05:40"), _article("u4", "2024-01-01 05:50"),
                             _article("u5", "2024-01-01 12:00")])
    _run(spark, folder, table, tmp_path / "cp")
    assert counts() == {hour(5): (2, 3), hour(6): (1, 1), hour(12): (1, 1)}
    _land(folder, "3.json", [_article("too late", "2024-01-01 05:50"), _article("u6", "2024-01-01 12:30")])
    _run(spark, folder, table, tmp_path / "cp")
    assert counts() == {hour(5): (2, 3), hour(6): (1, 1), hour(12): (2, 2)}
    rows = table.read()
    expected = with_momentum(rows.select("window_start", "avg_sentiment"))
    got = rows.select("window_start", "avg_sentiment", "sentiment_momentum")
    assert got.exceptAll(expected).count() == 0


def test_stream_needs_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError):
            news.require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unfinished_write_changes_nothing(spark, tmp_path):
    table = store.FeatureStore(spark, str(tmp_path / "features"))
    table.upsert(feature_rows(spark, [(hour(1), 1, 0.1), (hour(2), 2, 0.2)]), 1)
    torn = table.stored().where("article_count = 1").withColumn("article_count", F.lit(9))
    torn.write.partitionBy("window_date").parquet(f"{table.path}/data/version=torn")
    assert sorted(r.article_count for r in table.read().collect()) == [1, 2]
    table.upsert(feature_rows(spark, [(hour(2), 3, 0.2)]), 2)
    assert sorted(r.article_count for r in table.read().collect()) == [1, 3]


def test_one_row_of_several_for_a_window(spark, tmp_path):
    rows = [(hour(1), n, 0.1) for n in range(5)]
    got = []
    for k, part in enumerate((rows, rows[::-1])):
        table = store.FeatureStore(spark, str(tmp_path / f"features{k}"))
        table.upsert(feature_rows(spark, part), 1)
        got.append([r.article_count for r in table.read().collect()])
    assert got[0] == got[1] and len(got[0]) == 1
