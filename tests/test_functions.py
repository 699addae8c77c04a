"""Scalar functions on hand-written edge rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewire.config import DEFAULT_CONFIG as CONFIG
from tidewire.config import EngineConfig, EventRule
from tidewire.functions import keywords as kw
from tidewire.functions import scoring as sc
from tidewire.functions.basics import hour_floor, round_dp
from tidewire.functions.dates import parse_date
from tidewire.functions.html import strip_html
from tidewire.functions.text import article_text, normalize_whitespace
from tidewire.functions.verdicts import parse_verdict, parse_verdicts, reply_as_json


def values(spark, rows, column, schema="t string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.select(column).collect()]


MARKUP = [
    ("<p>a&amp;lt;b &#8364; &#150; &#x1F600;&nbsp;x</p>", "a&lt;b € – 😀 x"),
    ("<script>var t='</p>';</script>z<!-- c > -->q", "z q"),
    ("<a title='x>y'>k</a> 1 < 2 & 3", "k 1 < 2 & 3"),
    ("<style>p{}</style><template>t</template>ok", "ok"),
    ("&copy &notin; &AMP;", "© ∉ &"),
    ("<b>cut &amp</b> &am &copy<i>", "cut & &am ©"),
    ("no markup", "no markup"),
    ("<script>never closed", ""),
    (None, ""),
]


def test_strip_html(spark):
    got = values(spark, [m for m, _ in MARKUP], normalize_whitespace(strip_html(F.col("t"))))
    assert got == [expected for _, expected in MARKUP]


def test_long_tags_do_not_overflow_the_stack(spark):
    tag = "<a " + " ".join(f"x{i}=\"{'>' * 5}\"" for i in range(3000)) + ">t"
    broken = "<a title=\"" + "x" * 200_000
    got = values(spark, [tag, broken], normalize_whitespace(strip_html(F.col("t"))))
    assert got[0] == "t" and got[1] == broken


def test_whitespace(spark):
    got = values(spark, [" a\u0085\u0085b\x1cc\t\n d "], normalize_whitespace(F.col("t")))
    assert got == ["a b c d"]


def test_article_text_skips_empty_parts(spark):
    rows = [("t", "", "c"), (None, None, None), (" a ", "b", "")]
    text = article_text(F.col("x"), F.col("y"), F.col("z"))
    assert values(spark, rows, text, "x string, y string, z string") == ["t c", "", "a  b"]


DATES = [
    ("Tue, 02 Jan 2024 03:04:05 +0200", datetime(2024, 1, 2, 1, 4, 5)),
    ("02 Jan 2024 03:04:05 GMT", datetime(2024, 1, 2, 3, 4, 5)),
    ("02 Jan 24 03:04 EST", datetime(2024, 1, 2, 8, 4)),
    ("2024-01-02T03:04:05Z", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02T03:04:05.123456+05:30", datetime(2024, 1, 1, 21, 34, 5, 123456)),
    ("2024-03-10 02:30:00", datetime(2024, 3, 10, 2, 30)),
    ("2024-01-02", datetime(2024, 1, 2)),
    ("January 2, 2024 12:04 AM", datetime(2024, 1, 2, 0, 4)),
    ("Jan 2nd, 2024", datetime(2024, 1, 2)),
    ("01/02/2024 3:04 pm", datetime(2024, 1, 2, 15, 4)),
    ("Tuesday, 2 January 2024 03:04:05 -05", datetime(2024, 1, 2, 8, 4, 5)),
    ("Tue Jan  2 03:04:05 2024", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024/01/02 03:04", datetime(2024, 1, 2, 3, 4)),
    ("20240102T030405Z", datetime(2024, 1, 2, 3, 4, 5)),
    ("20240102", datetime(2024, 1, 2)),
    ("02.01.2024", datetime(2024, 2, 1)),
    ("2024-01-02 3 PM", datetime(2024, 1, 2, 15)),
    ("13/01/2024 10:00", datetime(2024, 1, 13, 10)),
    ("January 2, 2024 at 3:04 PM", datetime(2024, 1, 2, 15, 4)),
    ("2024-02-30", None),
    ("bad", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dates_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert values(spark, [d for d, _ in DATES], parse_date(F.col("t"))) == [d for _, d in DATES]
        assert values(spark, ["2024-03-10 02:30:00"], hour_floor(parse_date(F.col("t")))) == [
            datetime(2024, 3, 10, 2)
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_clock_first_and_months(spark):
    at = datetime(2003, 9, 28, 10, 36)
    dates = {
        "10:36 28.9.2003": at, "10:36:28 UTC, 2003-09-28": datetime(2003, 9, 28, 10, 36, 28), "3:04 PM Jan 2 2024": datetime(2024, 1, 2, 15, 4),
        "12:05am on Tue, 02 Jan 2024": datetime(2024, 1, 2, 0, 5), "10:36 +02:00 September 28, 2003": datetime(2003, 9, 28, 8, 36),
        "Jan 2024": datetime(2024, 1, 1), "September, 2003": datetime(2003, 9, 1), "2024-02": datetime(2024, 2, 1),
        "10:36": None, "10:36 soon": None, "Foo 2024": None, "25:99 Jan 2 2024": None, "2024-13": None,
    }
    assert values(spark, list(dates), parse_date(F.col("t"))) == list(dates.values())


def test_legacy_zone_names_are_utc(spark):
    got = values(spark, ["02 Jan 2024 03:04 EST"], parse_date(F.col("t"), legacy_zone_names=True))
    assert got == [datetime(2024, 1, 2, 3, 4)]


def _reply(flag):
    return f'text {{"results":[{{"is_noise": {flag}, "reason":"r","category":"macro"}}]}} more'


FALLBACK = (True, "fallback", None)
REPLIES = [
    (_reply("true"), (True, "r", "macro")),
    (_reply("false"), (False, "r", "macro")),
    (_reply("null"), (False, "r", "macro")),
    (_reply('"false"'), (True, "r", "macro")),
    (_reply('""'), (False, "r", "macro")),
    (_reply("0"), (False, "r", "macro")),
    (_reply("1"), (True, "r", "macro")),
    (_reply("[]"), (False, "r", "macro")),
    (_reply("{}"), (False, "r", "macro")),
    (_reply("0.0"), (False, "r", "macro")),
    (_reply("oops"), FALLBACK),
    ('{"results":[{"reason":null,"category":null}]}', (True, "None", None)),
    ('{"results":[{}]}', (True, "unknown", "unknown")),
    ('{"results":[{"reason":"it\'s"}]}', FALLBACK),
    ("{'results':[{'is_noise':false}]}", (False, "unknown", "unknown")),
    ('{"results":[{"is_noise":false}]} {"b":1}', FALLBACK),
    ('{"results":[]}', FALLBACK),
    ('{"results":[3]}', FALLBACK),
    ('{"results":null}', FALLBACK),
    ('{"x":1}', FALLBACK),
    ('{"results":[{"reason":"' + "x" * 40 + '"}]}', (True, "x" * 30, "unknown")),
    ("} no {", FALLBACK),
    (None, FALLBACK),
]


def test_verdicts(spark):
    got = values(spark, [r for r, _ in REPLIES], parse_verdict(F.col("t"), reason_chars=30))
    assert [tuple(v) for v in got] == [expected for _, expected in REPLIES]


def test_batch_verdicts_fill_and_fail_together(spark):
    good = '{"is_noise":false}'
    rows = [f'{{"results":[{good}]}}', f'{{"results":[{good},3]}}', f'{{"results":[{good},{good},{good}]}}']
    got = values(spark, rows, parse_verdicts(F.col("t"), 2))
    flags = [[v.is_noise for v in batch] for batch in got]
    assert flags == [[False, True], [True, True], [False, False]]


def test_reply_as_json(spark):
    got = values(spark, ['{"a":1}', "plain"], reply_as_json(F.col("t")).cast("string"))
    assert got == ['{"a":1}', '{"raw":"plain"}']


def test_category(spark):
    rows = ["illegal act", "on-chain", "onchain", "Technical", "tech", None, ""]
    got = values(spark, rows, kw.standardize_category(F.col("t"), CONFIG))
    assert got == ["regulation", "whale_move", "unknown", "price_movement", "unknown", "unknown", "unknown"]


def test_events(spark):
    rows = ["hack at the sec", "inflation", "inflation and gdp", "rally", "rally and surge"]
    found = kw.hits(F.col("t"), CONFIG.all_words)
    got = values(spark, rows, kw.event_from_words(found, CONFIG))
    assert got == ["hack", "unknown", "macro", "unknown", "price_movement"]


def test_custom_rules_go_by_priority_then_order(spark):
    config = EngineConfig(event_rules=(
        EventRule("low", 1, 1, ("a",)), EventRule("high", 3, 1, ("b",)), EventRule("tie", 3, 1, ("c",)),
    ))
    found = kw.hits(F.col("t"), config.all_words)
    assert values(spark, ["a", "a b", "c b"], kw.event_from_words(found, config)) == ["low", "high", "high"]


def test_assets_by_substring(spark):
    found = kw.hits(F.col("t"), CONFIG.all_words)
    got = values(spark, ["a second method", "nothing", None], kw.detect_assets(found, CONFIG))
    assert got == [["ETH", "REGULATION"], ["UNKNOWN"], ["UNKNOWN"]]


def test_impact(spark):
    rows = [
        ("unknown", 0.6, ["BTC"], 1), ("macro", 0.85, [], 3), ("listing", 0.50, [], 0),
        ("hack", 0.50, ["BTC"], 3), ("hack", 0.50, ["ETH"], 2), ("listing", 0.6, ["MARKET"], 2),
        ("other", 0.9, ["UNKNOWN"], 0),
    ]
    score = sc.impact_score(F.col("e"), F.col("w"), F.col("a"), CONFIG)
    got = values(spark, [r[:3] for r in rows], score, "e string, w double, a array<string>")
    assert got == [r[3] for r in rows]


def test_default_source_weight(spark):
    got = values(spark, ["cftc_news", "cryptopanic", "nobody", None], sc.source_weight(F.col("t"), CONFIG))
    assert got == [1.0, 0.5, 0.6, 0.6]


def test_sentiment(spark):
    rows = [("123456789", 0.9, 0.1, 0.0), ("long enough", 0.4, 0.4, 0.2), ("long enough", None, 0.2, 0.8),
            ("long enough", 0.12345, 0.0, 0.5)]
    probs = F.struct(F.col("p").alias("positive"), F.col("n").alias("negative"), F.col("u").alias("neutral"))
    got = values(spark, rows, sc.sentiment_from_probs(F.col("t"), probs), "t string, p double, n double, u double")
    assert [tuple(g) for g in got] == [
        (0.0, "neutral", 0.0), (0.0, "positive", 0.4), (-0.2, "neutral", 0.8), (0.1235, "neutral", 0.5)
    ]


def test_blend_and_labels(spark):
    rows = [(0.5, "", 0.9), (0.5, None, 0.9), (0.5, "short", 0.0), (0.25, "text", 0.0)]
    score = sc.blend_score(F.col("h"), F.col("t"), F.col("c"))
    got = values(spark, rows, F.struct(score, sc.polarity_label(score)), "h double, t string, c double")
    assert [tuple(g) for g in got] == [
        (0.5, "positive"), (0.5, "positive"), (0.2, "positive"), (0.1, "neutral")
    ]


def test_rounding(spark):
    got = values(spark, [0.00015, 0.1 + 0.2, -0.00005], round_dp(F.col("t"), 4), "t double")
    assert got == [0.0002, 0.3, -0.0001]
