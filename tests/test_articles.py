"""Intake, verdict and enrichment operators on hand-written rows."""

from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidewire.operators import articles as ar
from tidewire.operators import enrich as en
from tidewire.operators import noise as nz
from tidewire.operators import windows as wn
from tidewire.schemas import ENRICHED_FIELDS

RAW = "title string, content string, url string, source string, raw_published_at string"
AT = datetime(2024, 1, 1, 5)


def test_normalize(spark):
    rows = [
        (None, "c", "u1", "s", "2024-01-01"), ("t", "c", "  ", "s", "2024-01-01"),
        ("t", "c", None, "s", "2024-01-01"), ("t", "c", "u4", "s", "some day"),
        ("ok", None, " u5\n", "s", "2024-01-01"), ("x" * 501, "y" * 5001, "u6", None, "2024-01-01"),
    ]
    raw = spark.createDataFrame(rows, RAW)
    good = {r.url: r for r in ar.normalize_articles(raw).collect()}
    assert set(good) == {"u5", "u6"}
    assert good["u5"].content == ""
    long = good["u6"]
    assert (len(long.title), long.title_length, len(long.content), long.text_length) == (501, 501, 5001, 5001)
    cut = {r.url: r for r in ar.normalize_articles(raw, title_chars=500, content_chars=5000).collect()}["u6"]
    assert (len(cut.title), cut.title_length, len(cut.content), cut.text_length) == (500, 501, 5000, 5001)
    import hashlib

    assert long.content_hash == hashlib.sha256(b"y" * 5001).hexdigest()
    kept, bad = ar.quarantine_split(ar.with_clean_fields(raw))
    assert kept.count() == 2
    assert sorted(r._error for r in bad.collect()) == ["no date", "no title", "no url", "no url"]


def test_window_is_half_open(spark):
    rows = [(datetime(2024, 1, 1, h),) for h in (4, 5, 6)]
    df = spark.createDataFrame(rows, "published_at timestamp_ntz")
    start, end = (F.lit(datetime(2024, 1, 1, h)).cast("timestamp_ntz") for h in (5, 6))
    assert [r.published_at.hour for r in ar.window_filter(df, start, end).collect()] == [5]


def test_first_feed_wins(spark):
    rows = [(AT, "a", 2, 0, "late feed"), (AT, "a", 1, 9, "early feed"), (AT, "b", 0, 0, "other")]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, id string, feed_ord int, entry_ord int, t string")
    assert sorted(r.t for r in ar.dedup_first(df).collect()) == ["early feed", "other"]


def test_hot_copies_are_cut_before_the_shuffle(spark):
    """A third of all rows share one id; the partial limit keeps one row of it per task."""
    df = spark.range(0, 9000, 1, 6).select(
        F.lit(AT).cast("timestamp_ntz").alias("window_start"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("id"),
        F.lit(0).alias("feed_ord"), F.col("id").alias("entry_ord"),
    )
    unique = ar.dedup_first(df)
    assert unique.count() == 6001
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_limit_per_source(spark):
    df = spark.range(300).select(
        F.when(F.col("id") < 200, "hot").otherwise("cold").alias("source"), F.col("id").alias("entry_ord")
    )
    got = [(r.source, r.entry_ord) for r in ar.per_source_limit(df, 50).collect()]
    assert sorted(got) == sorted([("hot", i) for i in range(50)] + [("cold", i) for i in range(200, 250)])


def test_large_limit_is_exact(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("source"), F.col("id").alias("entry_ord")
    )
    got = ar.per_source_limit(df, 2500, salts=4)
    assert {r.source: (r.n, r.m) for r in got.groupBy("source").agg(
        F.count("*").alias("n"), F.max("entry_ord").alias("m")).collect()} == {
        "hot": (2500, 3749), "cold": (2500, 7497)}


def test_union_keeps_registry_order(spark):
    parts = [spark.createDataFrame([(i,)], "x int") for i in (7, 8)]
    assert sorted((r.feed_ord, r.x) for r in ar.union_sources(parts).collect()) == [(0, 7), (1, 8)]


def test_anchor(spark):
    df = spark.createDataFrame([("2024-01-01T05:40:00Z",), ("soon",), ("2024-01-01T07:00:00+01:00",)],
                               "ingestion_time string")
    assert ar.earliest_anchor(df).first().window_start == datetime(2024, 1, 1, 4)


def test_observed_counts(spark):
    seen = Observation()
    ar.observed(spark.range(7), seen).write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 7


def _articles(spark, rows):
    return spark.createDataFrame(
        [(AT, 0, i, f"id{i}", *r) for i, r in enumerate(rows)],
        "window_start timestamp_ntz, feed_ord int, entry_ord int, id string, title string, content string, "
        "url string, source string, is_noise boolean, category string",
    )


def test_enrichment(spark):
    df = _articles(spark, [
        ("Bitcoin hack drained wallets", "", "u0", "cftc_news", False, None),
        ("Bitcoin hack", "c", "u1", "s", True, None),
        ("Bitcoin hack", "c", "u2", "s", None, None),
        ("Nothing here", "at all", "u3", "s", False, "macro"),
        ("Bitcoin note", "with text", "u4", None, False, "whale"),
    ])
    got = {r.id: r for r in en.enrich_articles(df).collect()}
    assert set(got) == {"id0", "id4"}
    assert set(ENRICHED_FIELDS) <= set(got["id0"].asDict())
    first = got["id0"]
    assert (first.event_type, first.impact_score, first.timeframe, first.source_weight) == ("hack", 3, "short", 1.0)
    assert first.final_sentiment_score == first.headline_sentiment_score == -0.6667
    assert (first.content_sentiment_score, first.content_sentiment_label) == (0.0, "neutral")
    assert (got["id4"].event_type, got["id4"].source_weight) == ("whale_move", 0.6)


def test_description_stands_in_for_content(spark):
    df = _articles(spark, [("Bitcoin", "", "u", "s", False, None)]).withColumn(
        "description", F.lit("price crash and plunge of the coin")
    )
    row = en.enrich_articles(df).first()
    assert row.event_type == "price_movement" and row.content_sentiment_score < 0


def test_scorer_plugin_sees_whole_or_cut_texts(spark):
    df = _articles(spark, [
        ("short", "z" * 900, "u", "s", False, None), ("a longer title", None, "u", "s", False, None),
        ("another title", "tiny", "u", "s", False, None),
    ])

    def factory():
        def score(texts):
            assert all(10 <= len(t) <= 900 for t in texts)
            return [{"positive": len(t) / 1000, "negative": 0.0, "neutral": 0.1} for t in texts]

        return score

    got = {r.id: r for r in en.with_sentiment(en.score_sentiment(df, factory)).collect()}
    assert (got["id0"].headline_sentiment_score, got["id0"].content_sentiment_score) == (0.0, 0.9)
    assert got["id0"].final_sentiment_score == 0.54
    cut = en.with_sentiment(en.score_sentiment(df, factory, chars=400), chars=400).where("id = 'id0'").first()
    assert cut.content_sentiment_score == 0.4
    assert got["id1"].final_sentiment_score == got["id1"].headline_sentiment_score == 0.014
    assert got["id2"].content_sentiment_score == 0.0 and got["id2"].final_sentiment_score == 0.0052


def test_classifier_plugin_retries_calls_only(spark):
    df = _articles(spark, [(t, "c", "u", "s", None, None) for t in ("flaky", "down", "odd", "fine")])
    batched = nz.assign_batches(df.drop("is_noise", "category"), 1)
    prompts = nz.build_prompts(batched, instructions="x", key="id")

    def factory():
        calls = {}

        def one(prompt):
            calls[prompt] = calls.get(prompt, 0) + 1
            if "down" in prompt or ("flaky" in prompt and calls[prompt] < 3):
                raise OSError("no connection")
            return "what?" if "odd" in prompt else '{"results":[{"is_noise":false,"reason":"r"}]}'

        return lambda prompts: [one(p) for p in prompts]

    replies = nz.ask_classifier(prompts, factory, retries=3, delay_seconds=0.0)
    got = {r.title: (r.is_noise, r.reason) for r in nz.attach_verdicts(batched, replies).collect()}
    errors = [r.reply_error for r in replies.collect() if r.reply is None]
    assert errors == ["OSError: no connection"]
    assert got == {"flaky": (False, "r"), "fine": (False, "r"), "down": (True, "fallback"), "odd": (True, "fallback")}


def test_batches_cover_every_position_once(spark):
    df = spark.range(0, 1000).select(
        F.lit(AT).cast("timestamp_ntz").alias("window_start"), (F.col("id") % 3).alias("feed_ord"),
        F.col("id").alias("entry_ord"), F.lit("t").alias("title"), F.lit("c").alias("content"),
    )
    batched = nz.assign_batches(df, 7, entries_per_chunk=64)
    got = sorted((r.batch, r.pos, r.feed_ord, r.entry_ord) for r in batched.collect())
    assert [g[:2] for g in got] == [(i // 7, i % 7) for i in range(1000)]
    assert [g[2:] for g in got] == sorted(g[2:] for g in got)


def test_single_prompt_matches_batch_of_one(spark):
    df = _articles(spark, [("t", "c" * 300, "u", "s", None, None)])
    one = nz.single_prompts(df).first().prompt
    assert one == nz.build_prompts(nz.assign_batches(df, 1)).first().prompt
    assert one.endswith("0:\ntitle: t\ncontent: " + "c" * 300 + "\n")
    cut = nz.single_prompts(df, content_chars=250).first().prompt
    assert cut.endswith("content: " + "c" * 250 + "\n")


def _enriched(spark, rows):
    return spark.createDataFrame(
        rows,
        "window_start timestamp_ntz, event_type string, asset_mentioned array<string>, impact_score int, "
        "source_weight double, headline_sentiment_score double, headline_sentiment_conf double, "
        "final_sentiment_score double",
    )


def test_weighted_mean_and_buckets(spark):
    scores = (0.1, -0.1, 0.4, -0.5)
    rows = [(AT, "unknown", None, impact, 0.6, 0.0, 0.5, s) for impact, s in enumerate(scores)]
    row = _enriched(spark, rows).groupBy("window_start").agg(*wn.feature_aggregates()).first()
    weights = (1, 2, 4, 6)
    expected = sum(s * k for s, k in zip(scores, weights, strict=True)) / sum(weights)
    assert row.weighted_avg_sentiment == pytest.approx(expected, abs=5e-5)
    assert (row.positive_count, row.negative_count, row.neutral_count) == (1, 1, 2)
    assert row.net_impact_sentiment == 2 - 3
    assert (row.btc_mentions, row.max_impact, row.low_impact_count) == (0, 3, 2)


def test_empty_and_single_row_windows(spark):
    later = datetime(2024, 1, 1, 7)
    enriched = _enriched(spark, [(AT, "hack", ["BTC"], 3, 1.0, None, None, None)])
    cleaned = spark.createDataFrame([(AT,), (AT,), (later,)], "window_start timestamp_ntz")
    features = wn.window_features(enriched, cleaned)
    got = {r.window_start.hour: r for r in wn.fill_empty_windows(features, wn.hour_calendar(features)).collect()}
    assert sorted(got) == [5, 6, 7]
    assert (got[5].article_count, got[5].total_raw, got[5].noise_ratio) == (1, 2, 0.5)
    assert (got[5].sentiment_std, got[5].avg_sentiment, got[5].avg_confidence) == (0.0, 0.0, 0.0)
    assert got[5].has_hack and got[5].hack_count == 1
    assert (got[6].total_raw, got[6].noise_ratio, got[6].has_hack, got[6].avg_impact) == (0, None, False, 0.0)
    assert (got[7].total_raw, got[7].article_count, got[7].noise_ratio) == (1, 0, None)


def test_enriched_without_cleaned_rows(spark):
    enriched = _enriched(spark, [(AT, "hack", ["BTC"], 3, 1.0, 0.2, 0.3, 0.4)])
    nothing = spark.createDataFrame([], "window_start timestamp_ntz")
    assert wn.window_features(enriched, nothing).first().noise_ratio == 0.0


def test_implausible_dates_are_set_aside(spark):
    rows = [("t", "c", f"u{y}", "s", f"{y}-01-02") for y in ("0001", "9999", "2024")]
    raw = spark.createDataFrame(rows, RAW)
    good = ar.with_window_start(ar.normalize_articles(raw))
    assert [r.url for r in good.collect()] == ["u2024"]
    assert wn.hour_calendar(good).count() == 1
    _, bad = ar.quarantine_split(ar.with_clean_fields(raw))
    assert {r._error for r in bad.collect()} == {"implausible date"}


def test_calendar_is_dealt_out(spark):
    ends = spark.createDataFrame([(datetime(2020, 1, 1),), (datetime(2024, 1, 1),)], "window_start timestamp_ntz")
    calendar = wn.hour_calendar(ends)
    assert calendar.count() == 24 * 1461 + 1
    assert len({r[0] for r in calendar.select(F.spark_partition_id()).distinct().collect()}) > 1
