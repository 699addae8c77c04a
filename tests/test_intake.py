"""Intake that does not depend on how its input is cut: streams, feeds, replies, counts."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewire.operators import articles as ar
from tidewire.operators import noise as nz
from tidewire.operators.enrich import measure_articles, with_event
from tidewire.operators.windows import flagged_window_features
from tidewire.plans import hourly
from tidewire.sources import envelopes, feeds
from tidewire.sources.store import FeatureStore
from tidewire.streaming import news
from tidewire.streaming.intake import LATE, REJECTED, Intake, run_intake


def article(url, time, title="Bitcoin hack and more", source="a"):
    return {"title": title, "content": f"text of {url}", "url": url, "source": source, "raw_published_at": time}


def land(folder, name, articles, at="2024-01-01T09:00:00Z"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"ingestion_time": at, "articles": articles}))


def feed_order(spark):
    return spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "source string, feed_ord int")


def run(spark, folder, base, delay=timedelta(days=9), **options):
    taken = Intake(spark, str(base / "tables"), delay, feed_order(spark))
    run_intake(taken, str(folder), str(base / "checkpoint"), **options).awaitTermination()
    return taken


def made_up(n=90):
    rng = random.Random(3)
    return [
        article(f"u{rng.randrange(25)}", f"2024-01-0{rng.randrange(1, 4)} 0{rng.randrange(10)}:{rng.randrange(10, 60)}",
                title=rng.choice(["Bitcoin hack", "SEC sues exchange", "Quiet day"]), source=rng.choice("abc"))
        for _ in range(n)
    ]


@pytest.mark.parametrize(("files", "per_batch", "runs"), [(1, None, 1), (9, 2, 1), (9, 1, 3), (5, None, 5)])
def test_survivors_and_features_do_not_depend_on_batches(spark, tmp_path, files, per_batch, runs):
    """However the same articles are cut into files, batches and runs: what the batch job makes of them."""
    everything = made_up()
    parts = [everything[k::files] for k in range(files)]
    table = FeatureStore(spark, str(tmp_path / "features"))
    for number in range(runs):
        for k in range(number, files, runs):
            land(tmp_path / "landing", f"{k}.json", parts[k], f"2024-01-05T{10 + k}:00:00Z")
        taken = run(spark, tmp_path / "landing", tmp_path, store=table, max_files=per_batch)
    raw = envelopes.with_feed_order(envelopes.read_envelopes(spark, str(tmp_path / "landing")), feed_order(spark))
    first = ar.dedup_first(ar.with_window_start(ar.normalize_articles(raw.drop("path"))))
    columns = ["window_start", "id", "title", "ingestion_time", "feed_ord", "entry_ord"]
    expected = {tuple(r) for r in first.select(*columns).collect()}
    assert {tuple(r) for r in taken.survivors().select(*columns).collect()} == expected and len(expected) > 25
    measured = with_event(measure_articles(first, ("window_start", "id"))).withColumn("kept", F.col("relevant"))
    features = {r.window_start: (r.article_count, r.total_raw, r.avg_sentiment) for r in flagged_window_features(measured).collect()}
    got = {r.window_start: (r.article_count, r.total_raw, r.avg_sentiment) for r in table.read().collect()}
    assert got == features
    accounts = taken.accounts().collect()
    assert sum(r.read for r in accounts) == 90 and sum(r["first"] for r in accounts) == len(expected)
    assert all(r.read == r.late + r.rejected + r["first"] + r.copies for r in accounts)


def test_late_and_rejected_rows_are_kept_and_counted(spark, tmp_path):
    folder, delay = tmp_path / "landing", timedelta(hours=2)
    land(folder, "1.json", [article("u1", "2024-01-01 10:00"), article("u2", "2024-01-01 03:00"), article("", "2024-01-01 10:00")])
    run(spark, folder, tmp_path, delay)
    land(folder, "2.json", [article("u3", "2024-01-01 08:00"), article("u4", "2024-01-01 07:59"), article("u1", "2024-01-01 10:00"),
                            article("u5", "soon"), "no article"])
    (folder / "3.json").write_text('{"articles": [')
    taken = run(spark, folder, tmp_path, delay)
    rows = {r.batch: r.asDict() for r in taken.accounts().collect()}
    assert rows[0] == {"batch": 0, "read": 3, "late": 0, "rejected": 1, "first": 2, "copies": 0}
    assert rows[1] == {"batch": 1, "read": 6, "late": 1, "rejected": 3, "first": 1, "copies": 1}
    assert [r.url for r in taken.rows(LATE).collect()] == ["u4"]
    rejected = {(r.error, r.origin) for r in taken.rows(REJECTED).where("batch = 1").collect()}
    assert rejected == {("no date", None), ("unreadable article", "no article"), ("unreadable envelope", '{"articles": [')}
    # A third run without new files changes nothing.
    assert run(spark, folder, tmp_path, delay).accounts().count() == 2


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    land(tmp_path / "landing", "1.json", [article("u1", "2024-01-01 10:00"), article("u2", "2024-01-01 11:00")])
    bodies = envelopes.read_bodies(spark, str(tmp_path / "landing"))
    taken = Intake(spark, str(tmp_path / "tables"))
    table = FeatureStore(spark, str(tmp_path / "features"))
    for _ in range(2):
        taken.take(bodies, 0)
        table.upsert(taken.features(taken.touched(0)), 0)
    assert taken.survivors().count() == 2 and table.read().count() == 2 and taken.progress().count() == 1
    assert taken.watermark(0) is None and taken.watermark(1) == datetime(2024, 1, 1, 9)
    # Rows of a batch without progress are not there for readers.
    torn = Intake(spark, str(tmp_path / "torn"))
    torn.classify(bodies, None).write.partitionBy("outcome", "window_date").parquet(f"{torn.path}/rows/batch=0")
    assert torn.survivors().count() == 0


@pytest.mark.parametrize("files", [0, 1, 3, 16])
def test_table_streams_take_any_layout(spark, tmp_path, files):
    source = spark.range(40).select("id", F.concat(F.lit("text "), "id").alias("text"))
    path = tmp_path / "table.parquet"
    if files:
        source.repartition(files).write.parquet(str(path))
    else:
        source.coalesce(1).toPandas().to_parquet(path)
    stream = news.read_table_stream(spark, str(path), source.schema, max_files=2)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).select("id").distinct().count() == 40 == spark.read.parquet(out).count()


def test_article_rows_lose_no_body(spark):
    bodies = ['{"ingestion_time": "2024-01-01", "articles": [{"url": "u", "title": "t"}, "{\\"url\\": \\"v\\"}", 7]}', "[]", "[3]",
              '{"articles": 4}', "{", None, "", '{"articles": null}', '[{"url": "w"}]']
    df = spark.createDataFrame(list(enumerate(bodies)), "n int, body string")
    rows = [(r.n, r.entry_ord, r.url, r.error, r.origin) for r in envelopes.article_rows(df).orderBy("n", "entry_ord").collect()]
    assert rows == [
        (0, 0, "u", None, None), (0, 1, "v", None, None), (0, 2, None, "unreadable article", "7"),
        (1, None, None, "no articles", "[]"), (2, 0, None, "unreadable article", "3"),
        (3, None, None, "unreadable envelope", '{"articles": 4}'), (4, None, None, "unreadable envelope", "{"),
        (5, None, None, "unreadable envelope", None), (6, None, None, "unreadable envelope", ""),
        (7, None, None, "no articles", '{"articles": null}'), (8, 0, "w", None, None),
    ]
    good = envelopes.article_rows(df).where("error IS NULL").select("n", "entry_ord", "url")
    assert good.exceptAll(envelopes.repair_rows(envelopes.parse_envelopes(df)).select("n", "entry_ord", "url")).count() == 0


def test_feed_rows_and_split(spark, tmp_path):
    bodies = [("<rss><channel><item><link>a</link></item><item><link>b</link></item></channel></rss>", 200), ("<rss><chan", 200),
              ("<feed></feed>", 200), (None, 200), ("<rss/>", 500), ("x", None)]
    df = spark.createDataFrame([(n, b, s) for n, (b, s) in enumerate(bodies)], "feed_ord int, body string, status int")
    good, bad, counts = ar.write_split(feeds.feed_rows(df), str(tmp_path / "split"))
    assert counts == {"good": 2, "quarantined": 5} and "error" not in good.columns
    assert [(r.feed_ord, r.entry_ord, r.url) for r in good.orderBy("entry_ord").collect()] == [(0, 0, "a"), (0, 1, "b")]
    assert {r.feed_ord: (r.error, r.origin) for r in bad.collect()} == {
        1: ("unreadable document", "<rss><chan"), 2: ("no entries", "<feed></feed>"), 3: ("unreadable document", None),
        4: ("status 500", "<rss/>"), 5: ("status", "x"),
    }


@pytest.mark.parametrize("kind", ["rss", "atom"])
def test_feed_files_keep_their_order_over_splits(spark, tmp_path, kind):
    """Two files of some thousand entries, read in splits of 20 kB, against the parser of whole documents."""
    folder = tmp_path / "feeds"
    folder.mkdir()
    for name, n in (("one.xml", 3000), ("two.xml", 700)):
        if kind == "rss":
            items = "\n".join(f"<item><title>t {k} &amp; more</title><link>{name}/{k}</link>\n<pubDate>{k}</pubDate></item >".replace("item >", "item>") for k in range(n))
            text = f'<?xml version="1.0"?><rss><channel><title>itemised</title><link>x</link>{items}</channel></rss>'
        else:
            items = "\n".join(f'<entry><title>t {k} &amp; more</title><link href="{name}/{k}"/><updated>{k}</updated></entry>' for k in range(n))
            text = f"<feed><title>entry list</title>{items}</feed>"
        (folder / name).write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        known = spark.createDataFrame([("one.xml", "first", 0, 200), ("two.xml", "second", 1, 200), ("gone.xml", "x", 2, 404)],
                                      "file string, source string, feed_ord int, status int")
        found = feeds.read_feed_files(spark, str(folder), kind, known)
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 10
        got = found.select("source", "feed_ord", "entry_ord", "title", "content", "url", "raw_published_at").collect()
        cut = feeds.read_feed_files(spark, str(folder), kind, known, limit=5).groupBy("source").count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    documents = [(name, i, 200, (folder / f"{file}.xml").read_text()) for i, (name, file) in enumerate((("first", "one"), ("second", "two")))]
    whole = feeds.parse_feed_items(spark.createDataFrame(documents, "source string, feed_ord int, status int, body string"))
    expected = whole.select("source", "feed_ord", "entry_ord", "title", "content", "url", "raw_published_at").collect()
    assert sorted(got) == sorted(expected) and len(got) == 3700 and [r["count"] for r in cut] == [5, 5]


class Counting:
    """A model that notes each prompt it is asked in a file, and fails on some."""

    def __init__(self, path, bad=()):
        self.path, self.bad = str(path), bad

    def __call__(self):
        def classify(prompts):
            with open(self.path, "a") as f:
                f.writelines(f"{p}\n" for p in prompts)
            if any(p in self.bad for p in prompts):
                raise RuntimeError("no")
            return [f"re {p}" for p in prompts]

        return classify

    def asked(self):
        with open(self.path) as f:
            return f.read().split("\n")[:-1]


def test_reply_store_asks_once(spark, tmp_path):
    store = nz.ReplyStore(spark, str(tmp_path / "replies"), "m1")
    prompts = spark.createDataFrame([(i, f"p{i % 30}") for i in range(60)] + [(99, None)], "n int, prompt string")
    quick = {"retries": 1, "delay_seconds": 0.0}
    first = Counting(tmp_path / "first", bad=("p3", "p4"))
    rows = {r.n: (r.reply, r.reply_error) for r in store.ask(prompts, first, parts=3, **quick).collect()}
    assert rows[0] == rows[30] == ("re p0", None) and rows[99] == (None, None) and len(rows) == 61
    assert rows[3] == (None, "RuntimeError: no") and store.replies().count() == 28
    second = Counting(tmp_path / "second")
    more = prompts.unionByName(spark.createDataFrame([(100, "new")], prompts.schema))
    rows = {r.n: r.reply for r in store.ask(more, second, parts=2, **quick).collect()}
    assert sorted(second.asked()) == ["new", "p3", "p4"] and rows[3] == rows[33] == "re p3" and rows[100] == "re new"
    # Another model has replies of its own.
    other = nz.ReplyStore(spark, str(tmp_path / "replies"), "m2")
    assert other.replies().count() == 0
    (tmp_path / "none").write_text("")
    assert store.ask(prompts.limit(0), Counting(tmp_path / "none"), **quick).count() == 0


def test_a_failed_run_keeps_the_parts_before(spark, tmp_path, monkeypatch):
    store, calls = nz.ReplyStore(spark, str(tmp_path / "replies"), "m"), []
    prompts = spark.createDataFrame([(f"p{i}",) for i in range(40)], "prompt string")
    ask = nz.ask_classifier

    def breaking(part, factory, **options):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("the cluster is gone")
        return ask(part, factory, **options)

    monkeypatch.setattr(nz, "ask_classifier", breaking)
    first, second = Counting(tmp_path / "a"), Counting(tmp_path / "b")
    with pytest.raises(RuntimeError):
        store.ask(prompts, first, parts=4)
    store.ask(prompts, second, parts=4)
    assert not set(first.asked()) & set(second.asked()) and len(first.asked()) + len(second.asked()) == 40


def test_rounds(spark):
    def model():
        def answer(prompts):
            return [None if p == "bad" else str(int(p) - 1) for p in prompts]

        return answer

    first = spark.createDataFrame([(1, "1"), (2, "2"), (5, "5"), (9, "bad"), (7, "0")], "n int, prompt string")
    go_on = lambda asked: F.when(F.col("reply").cast("int") > 0, F.col("reply"))
    ask = lambda df: nz.ask_classifier(df, model, retries=1)
    rows = {r.n: (r.n_asked, r.prompt, r.reply) for r in nz.ask_in_rounds(first, ask, go_on, 3).collect()}
    assert rows == {1: (1, "1", "0"), 2: (2, "1", "0"), 5: (3, "3", "2"), 9: (1, "bad", None), 7: (1, "0", "-1")}
    with pytest.raises(ValueError):
        nz.ask_in_rounds(first, ask, go_on, 0)


def test_counts_in_flight_need_no_scan(spark):
    rows = [(article(f"u{i % 4}", "2024-01-01 05:00", "Bitcoin hack" if i % 2 else "Nothing"), i) for i in range(10)]
    raw = spark.createDataFrame([(a["title"], a["content"], a["url"], "a", a["raw_published_at"] if i else "x", i) for a, i in rows],
                                "title string, content string, url string, source string, raw_published_at string, entry_ord int")
    counts = hourly.StageCounts()
    verdicts = raw.select(ar.hash_text(F.col("url")).alias("id")).distinct().withColumn("is_noise", F.lit(False))
    features = hourly.news_features(raw, verdicts, counts=counts)
    plan = features._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CollectMetrics") == 3
    features.collect()
    assert counts.counts == {"raw": 10, "normalised": 9, "unique": 4, "candidates": 4, "kept": 2}
