"""The same queries as plain SQL for DuckDB, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from tidewire import fixed_values as fv
from tidewire.config import DEFAULT_CONFIG as CONFIG
from tidewire.functions import scoring as sc
from tidewire.operators import noise as nz
from tidewire.plans import inputs as inp
from tidewire.plans.inputs import duck

SQL: dict[str, str] = {}

_SPACE = (
    r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}"
    r"\x{3000}]"
)


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(items) -> str:
    return "[" + ", ".join(quote(w) for w in items) + "]"


def rd(x: str, places: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), {places}) AS DOUBLE)"


def ws(x: str) -> str:
    return f"trim(regexp_replace({x}, {quote(_SPACE + '+')}, ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {quote('^' + _SPACE + '+|' + _SPACE + '+$')}, '', 'g')"


def html(x: str) -> str:
    hidden = "|".join(rf"<{e}\b[^>]*>.*?(?:</{e}\s*>|\z)" for e in ("script", "style", "template", "rt", "rp"))
    tag = r"""<[!/?a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*>|<[!/?a-zA-Z][^>]*>"""
    x = f"regexp_replace(coalesce({x}, ''), {quote('(?is)<!--.*?-->|' + hidden)}, ' ', 'g')"
    x = f"regexp_replace({x}, {quote(tag)}, ' ', 'g')"
    # A known reference may lack its semicolon, as in a title cut short.
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")):
        x = f"regexp_replace({x}, '&{name}(?:;|([^a-zA-Z0-9;])|$)', {quote(char + chr(92) + '1')}, 'g')"
    return x


def with_(*ctes: tuple[str, str], last: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return duck(f"WITH {body}\n{last}")


ARTICLES = ("articles", inp.ARTICLES)
VERDICTS = ("verdicts", inp.VERDICTS)
WEIGHTS = ("weights", inp.WEIGHTS)
PROBS = ("probs", inp.PROBS)
CANDLES = ("candles", inp.CANDLES)
MACRO = ("macro", inp.MACRO)
TEXTS = ("texts", f"""
  SELECT *, lower({strip("concat_ws(' ', nullif(title, ''), nullif(content, ''))")}) AS txt
  FROM articles""")
FOUND = ("found", f"""
  SELECT *, list_filter({words(CONFIG.all_words)}, lambda w: contains(txt, w)) AS hits FROM texts""")


def _category(x: str) -> str:
    cases = " ".join(
        f"WHEN contains(lower({x}), {quote(k)}) THEN {quote(v)}" for k, v in fv.CATEGORY_FRAGMENTS
    )
    return f"CASE {cases} ELSE 'unknown' END"


def _word_event() -> str:
    rules = sorted(fv.EVENT_RULES, key=lambda r: -r[1])
    cases = " ".join(
        f"WHEN len(list_filter({words(ws_)}, lambda w: list_contains(hits, w))) >= {least} THEN {quote(kind)}"
        for kind, _, least, ws_ in rules
    )
    return f"CASE {cases} ELSE 'unknown' END"


def _assets() -> str:
    cases = ", ".join(
        f"CASE WHEN list_has_any(hits, {words(ws_)}) THEN {quote(label)} END"
        for label, ws_ in fv.ASSET_WORDS.items()
    )
    return f"coalesce(nullif(list_filter([{cases}], lambda x: x IS NOT NULL), []), ['UNKNOWN'])"


def _lookup(x: str, table: dict, default: str) -> str:
    cases = " ".join(f"WHEN {quote(k)} THEN {quote(v) if isinstance(v, str) else v}" for k, v in table.items())
    return f"CASE {x} {cases} ELSE {default} END"


CLASSED = ("classed", f"""
  SELECT *, CASE WHEN mapped <> 'unknown' THEN mapped ELSE word_event END AS event_type
  FROM (SELECT f.*, {_category('category')} AS mapped, {_word_event()} AS word_event,
          {_assets()} AS assets, list_has_any(hits, {words(CONFIG.relevance_words)}) AS relevant,
          coalesce(CAST(w.weight AS DOUBLE), 0.6) AS source_weight
        FROM found f LEFT JOIN weights w ON f.source = w.source) t""")


def _impact() -> str:
    base = _lookup("event_type", fv.IMPACT_BASE, "0")
    return f"""
  SELECT * EXCLUDE (base, tuned), CASE WHEN tuned < 3 AND list_has_any(assets, ['BTC', 'MARKET', 'REGULATION'])
      THEN tuned + 1 ELSE tuned END AS impact_score
  FROM (SELECT *, CASE WHEN base > 0 AND source_weight >= 0.85 THEN least(base + 1, 3)
                       WHEN base > 0 AND source_weight <= 0.55 THEN base - 1 ELSE base END AS tuned
        FROM (SELECT *, {base} AS base, {_lookup("event_type", fv.TIMEFRAMES, "'short'")} AS timeframe
              FROM classed) a) b"""


IMPACT = ("impacted", _impact())


def _label(pos: str, neg: str) -> str:
    neu = f"(1 - {pos} - {neg})"
    top = f"greatest({pos}, {neg}, {neu})"
    return f"CASE WHEN {pos} = {top} THEN 'positive' WHEN {neg} = {top} THEN 'negative' ELSE 'neutral' END"


def _sentiments(source: str) -> str:
    def side(text: str, pos: str, neg: str, prefix: str) -> str:
        ok = f"length({strip(text)}) >= 10"
        return f"""
      CASE WHEN {ok} THEN {rd(f'{pos} - {neg}', 4)} ELSE 0.0 END AS {prefix}_score,
      CASE WHEN {ok} THEN {_label(pos, neg)} ELSE 'neutral' END AS {prefix}_label,
      CASE WHEN {ok} THEN {rd(f'greatest({pos}, {neg}, 1 - {pos} - {neg})', 4)} ELSE 0.0 END AS {prefix}_conf"""

    return f"""
  SELECT *, h_score AS headline_sentiment_score, h_label AS headline_sentiment_label,
    h_conf AS headline_sentiment_conf,
    CASE WHEN content <> '' THEN c_score ELSE 0.0 END AS content_sentiment_score,
    CASE WHEN content <> '' THEN c_label ELSE 'neutral' END AS content_sentiment_label,
    CASE WHEN final > 0.1 THEN 'positive' WHEN final < -0.1 THEN 'negative' ELSE 'neutral' END
      AS final_sentiment_label, final AS final_sentiment_score
  FROM (SELECT *, CASE WHEN content <> '' THEN {rd('0.4::DOUBLE * h_score + 0.6::DOUBLE * c_score', 4)}
                       ELSE h_score END AS final
        FROM (SELECT *, {side("coalesce(title, '')", "p_pos", "p_neg", "h")},
                {side("content", "c_pos", "c_neg", "c")}
              FROM {source}) a) b"""


def _good(text: str, items) -> str:
    return f"len(list_filter({words(items)}, lambda w: contains(lower({strip(text)}), w)))"


SCORED = ("scored", """
  SELECT a.*, v.is_noise, p.p_pos, p.p_neg, p.c_pos, p.c_neg FROM impacted a
  JOIN verdicts v ON a.doc_id = v.doc_id JOIN probs p ON a.doc_id = p.doc_id""")
MOODS = ("moods", _sentiments("scored"))
CLEANED = ("cleaned", """
  SELECT * FROM moods
  QUALIFY row_number() OVER (PARTITION BY window_start, id ORDER BY feed_ord, entry_ord) = 1""")
ENRICHED = ("enriched", "SELECT * FROM cleaned WHERE is_noise = false AND relevant")
STAGES = (ARTICLES, VERDICTS, WEIGHTS, PROBS, TEXTS, FOUND, CLASSED, IMPACT, SCORED, MOODS)
NEWS = (*STAGES, CLEANED, ENRICHED)

# ---- text functions -------------------------------------------------------------------------------

SQL["strip_html"] = f"SELECT page_id, {ws(html('html'))} AS text FROM pages"
SQL["normalize_ws"] = f"SELECT page_id, {ws('html')} AS text FROM pages"
SQL["hash_ids"] = "SELECT page_id, sha256(url) AS id, sha256(html) AS content_hash FROM pages"
SQL["parse_dates"] = """
SELECT event_id, CASE event_id % 8
  WHEN 0 THEN ts
  WHEN 1 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
  WHEN 2 THEN date_trunc('second', ts) + INTERVAL 330 MINUTE
  WHEN 3 THEN date_trunc('second', ts) + INTERVAL 5 HOUR
  WHEN 4 THEN date_trunc('minute', ts)
  WHEN 5 THEN CAST(date_trunc('day', ts) AS TIMESTAMP)
  WHEN 6 THEN date_trunc('second', ts) END AS published_at
FROM events"""
SQL["article_text"] = with_(ARTICLES, last=f"""
SELECT doc_id, {strip("concat_ws(' ', nullif(title, ''), nullif(content, ''))")} AS text FROM articles""")

# ---- intake ---------------------------------------------------------------------------------------

RAW = ("raw", f"""
  SELECT *, CASE WHEN blank_url THEN 'no url' WHEN full_title = '' THEN 'no title'
                 WHEN bad_date THEN 'no date' END AS error
  FROM (SELECT doc_id, feed_ord, entry_ord, id, url, source, published_at, window_start,
          CASE WHEN doc_id % 53 = 52 THEN '' ELSE {ws(html("title"))} END AS full_title,
          CASE WHEN doc_id % 61 = 60 THEN '' ELSE {ws(html("content"))} END AS full_content,
          doc_id % 59 = 58 AS blank_url, doc_id % 97 = 96 AS bad_date FROM articles) r""")
NORMAL = ("normal", """
  SELECT doc_id, feed_ord, entry_ord, source, id, full_title AS title, full_content AS content, url,
    published_at, window_start,
    sha256(full_content) AS content_hash, length(full_content) AS text_length,
    length(full_title) AS title_length
  FROM raw WHERE error IS NULL""")
SQL["normalize_articles"] = with_(ARTICLES, RAW, NORMAL, last="""
SELECT doc_id, source, id, substr(title, 1, 500) AS title, substr(content, 1, 5000) AS content, url,
  published_at, content_hash, text_length, title_length
FROM normal""")
SQL["quarantine_split"] = with_(ARTICLES, RAW, last="SELECT doc_id, error FROM raw")
SQL["union_sources"] = """
SELECT CAST(0 AS BIGINT) AS feed_ord, doc_id AS entry_ord, sha256(text) AS hash FROM documents
UNION ALL SELECT 1, page_id, sha256(html) FROM pages
UNION ALL SELECT 2, conv_id * 1000 + turn, sha256(text) FROM conversations"""
SQL["per_source_limit"] = """
SELECT event_type AS source, event_id AS entry_ord, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 50"""
SQL["window_filter"] = with_(ARTICLES, last="""
SELECT doc_id, published_at FROM articles
WHERE published_at >= TIMESTAMP '2024-01-05 10:00:00' AND published_at < TIMESTAMP '2024-01-20 10:00:00'""")
SQL["dedup_first"] = with_(ARTICLES, last="""
SELECT window_start, id, doc_id FROM articles
QUALIFY row_number() OVER (PARTITION BY window_start, id ORDER BY feed_ord, entry_ord) = 1""")
SQL["window_anchor"] = """
SELECT event_id, date_trunc('hour', ts) - INTERVAL 1 HOUR AS window_start FROM events"""
SQL["earliest_anchor"] = """
SELECT user_id, date_trunc('hour', min(CASE WHEN event_id % 5 <> 0 THEN ts END)) - INTERVAL 1 HOUR
  AS window_start
FROM events GROUP BY user_id"""
SQL["read_envelope"] = with_(ARTICLES, last="""
SELECT doc_id, CASE WHEN (doc_id // 50) % 2 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' END AS ingestion_time,
  row_number() OVER (PARTITION BY doc_id // 50 ORDER BY doc_id) - 1 AS entry_ord, title, url, source,
  sha256(content) AS content_hash
FROM articles""")
SQL["repair_rows"] = with_(ARTICLES, last="""
SELECT doc_id, url, title, sha256(content) AS content_hash FROM articles WHERE doc_id % 5 IN (0, 4)""")
SQL["parse_feed_items"] = with_(ARTICLES, last=f"""
SELECT n AS feed_ord, concat('feed', n) AS source, entry_ord, url,
  CASE WHEN n % 2 = 0 AND doc_id % 3 = 0 THEN 'later' ELSE CAST(published_at AS VARCHAR) END
    AS raw_published_at, {ws("title")} AS title, sha256({ws("content")}) AS content_hash
FROM (SELECT * EXCLUDE (entry_ord), doc_id // 60 AS n,
        row_number() OVER (PARTITION BY doc_id // 60 ORDER BY doc_id) - 1 AS entry_ord FROM articles) t
WHERE entry_ord < 50 AND n % 7 <> 3""")
_NUMBERED = ("numbered", """
  SELECT * EXCLUDE (entry_ord), doc_id // 60 AS n, row_number() OVER (PARTITION BY doc_id // 60 ORDER BY doc_id) - 1 AS entry_ord
  FROM articles""")
SQL["feed_quarantine"] = with_(ARTICLES, _NUMBERED, ("found", """
  SELECT n AS feed_ord, entry_ord, url, CAST(NULL AS VARCHAR) AS error FROM numbered WHERE n % 7 NOT IN (3, 5, 6)
  UNION ALL
  SELECT DISTINCT n, -1, CAST(NULL AS VARCHAR),
    CASE n % 7 WHEN 3 THEN 'status 404' WHEN 5 THEN 'unreadable document' ELSE 'no entries' END
  FROM numbered WHERE n % 7 IN (3, 5, 6)"""), last="""
SELECT *, count(*) OVER (PARTITION BY error IS NULL) AS n_rows FROM found""")
SQL["envelope_quarantine"] = with_(ARTICLES, last="""
SELECT doc_id, CAST(u AS BIGINT) AS entry_ord, url, title, CAST(NULL AS VARCHAR) AS error
FROM articles, unnest([0, 1]) AS t(u) WHERE doc_id % 7 = 0 OR (doc_id % 7 = 2 AND u = 0)
UNION ALL
SELECT doc_id, CASE WHEN doc_id % 7 = 2 THEN 1 ELSE -1 END, NULL, NULL,
  CASE WHEN doc_id % 7 = 2 THEN 'unreadable article' WHEN doc_id % 7 IN (3, 5) THEN 'no articles'
    ELSE 'unreadable envelope' END
FROM articles WHERE doc_id % 7 <> 0""")
SQL["read_feed_files"] = with_(ARTICLES, _NUMBERED, last=f"""
SELECT n AS feed_ord, entry_ord, url,
  CASE WHEN n % 2 = 0 AND doc_id % 3 = 0 THEN 'later' ELSE CAST(published_at AS VARCHAR) END AS raw_published_at,
  {ws("title")} AS title, sha256({ws("content")}) AS content_hash
FROM numbered""")
SQL["stage_write_roundtrip"] = with_(
    ARTICLES, last="SELECT doc_id, id, title, content, source, window_start FROM articles"
)

# ---- noise and enrichment -------------------------------------------------------------------------

SQL["noise_gate"] = with_(VERDICTS, last="SELECT doc_id, is_noise FROM verdicts WHERE is_noise = false")
SQL["relevance_gate"] = with_(ARTICLES, TEXTS, last=f"""
SELECT doc_id FROM texts WHERE len(list_filter({words(CONFIG.relevance_words)}, lambda w: contains(txt, w))) > 0""")
SQL["detect_assets"] = with_(ARTICLES, TEXTS, FOUND, last=f"""
SELECT doc_id, array_to_string({_assets()}, ',') AS asset_mentioned FROM found""")
SQL["standardize_category"] = with_(
    ARTICLES, last=f"SELECT doc_id, category, {_category('category')} AS event_type FROM articles"
)
SQL["classify_event"] = with_(ARTICLES, WEIGHTS, TEXTS, FOUND, CLASSED, last="""
SELECT doc_id, event_type, word_event FROM classed""")
_KIND = "coalesce(category, 'missing')"
SQL["event_lookup"] = with_(ARTICLES, last=f"""
SELECT doc_id, {_lookup(_KIND, fv.TIMEFRAMES, "'short'")} AS timeframe,
  CAST({_lookup(_KIND, fv.IMPACT_BASE, '0')} AS BIGINT) AS impact_base FROM articles""")
SQL["source_weight"] = with_(ARTICLES, WEIGHTS, last="""
SELECT doc_id, a.source, coalesce(CAST(weight AS DOUBLE), 0.6) AS source_weight
FROM articles a LEFT JOIN weights w ON a.source = w.source""")
SQL["impact_score"] = with_(ARTICLES, WEIGHTS, TEXTS, FOUND, CLASSED, IMPACT, last="""
SELECT doc_id, event_type, timeframe, CAST(impact_score AS BIGINT) AS impact_score FROM impacted""")
SQL["sentiment_from_probs"] = with_(*STAGES, last="""
SELECT doc_id, headline_sentiment_score AS score, headline_sentiment_label AS label,
  headline_sentiment_conf AS conf, 'neutral' AS short_label, CAST(0.0 AS DOUBLE) AS short_conf FROM moods""")
SQL["blend_sentiment"] = with_(*STAGES, last="""
SELECT doc_id, headline_sentiment_score, headline_sentiment_label, headline_sentiment_conf,
  content_sentiment_score, content_sentiment_label, final_sentiment_score, final_sentiment_label
FROM moods""")
_G, _B = _good("title", sc.GOOD_WORDS), _good("title", sc.BAD_WORDS)
_CG, _CB = _good("content", sc.GOOD_WORDS), _good("content", sc.BAD_WORDS)
SQL["score_sentiment"] = with_(ARTICLES, ("counts", f"""
  SELECT doc_id, {_G} AS g, {_B} AS b, {_CG} AS cg, {_CB} AS cb FROM articles"""), last=f"""
SELECT doc_id, {rd('g / (g + b + 1)', 6)} AS headline_positive, {rd('b / (g + b + 1)', 6)} AS headline_negative,
  {rd('1 / (g + b + 1)', 6)} AS headline_neutral, {rd('cg / (cg + cb + 1)', 6)} AS content_positive,
  {rd('cb / (cg + cb + 1)', 6)} AS content_negative, {rd('1 / (cg + cb + 1)', 6)} AS content_neutral
FROM counts""")
_SEEN = {s: f"length({strip(t)}) >= 10" for s, t in (("headline", "title"), ("content", "content"))}
_GIVEN = ", ".join(
    f"CASE WHEN {_SEEN[side]} THEN {rd(f'{x} / ({g} + {b} + 1)', 6)} END AS {side}_{c}"
    for side, g, b in (("headline", "g", "b"), ("content", "cg", "cb"))
    for c, x in (("positive", g), ("negative", b), ("neutral", "1"))
)
SQL["score_sentiment_plugin"] = with_(ARTICLES, ("counts", f"""
  SELECT doc_id, title, content, {_G} AS g, {_B} AS b, {_CG} AS cg, {_CB} AS cb FROM articles"""), last=f"""
SELECT doc_id, {_GIVEN} FROM counts""")
SQL["classify_noise_plugin"] = with_(ARTICLES, last="""
SELECT doc_id, regexp_matches(lower(concat(title, ' | ', content)), 'top 10|could') AS is_noise,
  'asked' AS reason, 'unknown' AS category FROM articles""")
SQL["enrich_articles"] = with_(*STAGES, last="""
SELECT window_start, feed_ord::BIGINT AS feed_ord, entry_ord, doc_id, id, title, content, url, source,
  event_type, array_to_string(assets, ',') AS asset_mentioned, CAST(impact_score AS BIGINT) AS impact_score,
  timeframe, source_weight, headline_sentiment_score, headline_sentiment_label, headline_sentiment_conf,
  content_sentiment_score, content_sentiment_label, final_sentiment_score, final_sentiment_label
FROM moods WHERE is_noise = false AND relevant""")
SQL["stage_counters"] = with_(*STAGES, last="""
SELECT source, count(*) AS total, count(*) FILTER (is_noise = false) AS candidates,
  count(*) FILTER (is_noise = false AND relevant) AS enriched,
  count(*) FILTER (is_noise = false AND NOT relevant) AS skipped
FROM moods GROUP BY source""")
_SPECULATIVE = " OR ".join(f"contains(txt, {quote(w)})" for w in nz.SPECULATION)
SQL["classify_noise_rules"] = with_(ARTICLES, TEXTS, last=f"""
SELECT doc_id, reason <> 'event' AS is_noise, reason
FROM (SELECT doc_id, CASE WHEN {_SPECULATIVE} THEN 'speculation'
        WHEN regexp_matches(txt, {quote("|".join(nz.LISTICLES))}) THEN 'listicle' ELSE 'event' END AS reason
      FROM texts) t""")
SQL["parse_verdict"] = """
SELECT doc_id, CASE WHEN bad THEN true ELSE doc_id % 9 IN (0, 3, 7) END AS is_noise,
  CASE WHEN bad THEN 'fallback'
       ELSE substr(concat('reason number ', doc_id, ' is rather long indeed'), 1, 30) END AS reason,
  CASE WHEN bad THEN NULL WHEN doc_id % 4 = 0 THEN 'macro' WHEN doc_id % 4 = 1 THEN NULL ELSE 'unknown' END
    AS category
FROM (SELECT doc_id, doc_id % 9 = 8 OR doc_id % 11 = 0 AS bad FROM documents) t"""
SQL["reply_as_json"] = """
SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN turn ELSE -1 END AS n, CASE WHEN turn % 2 = 0 THEN role END AS role,
  CASE WHEN turn % 2 <> 0 THEN text END AS raw
FROM conversations"""
BATCHES = ("batches", """
  SELECT *, idx // 3 AS batch, idx % 3 AS pos
  FROM (SELECT *, CAST(window_start AS DATE) AS day, row_number() OVER (
          PARTITION BY CAST(window_start AS DATE) ORDER BY feed_ord, entry_ord) - 1 AS idx FROM articles) t""")
SQL["build_prompts"] = with_(ARTICLES, BATCHES, last="""
SELECT day, batch, count(*) AS n_articles, concat('Classify.', chr(10), 'ARTICLES:', chr(10),
  string_agg(concat(chr(10), pos, ':', chr(10), 'title: ', title, chr(10), 'content: ',
    substr(content, 1, 250), chr(10)), '' ORDER BY pos)) AS prompt
FROM batches GROUP BY day, batch""")
SQL["attach_verdicts"] = with_(ARTICLES, BATCHES, last="""
SELECT doc_id, NOT given AS is_noise, CASE WHEN given THEN 'ok' ELSE 'fallback' END AS reason,
  CASE WHEN given THEN 'macro' END AS category
FROM (SELECT doc_id, batch % 4 = 0 OR (batch % 4 = 1 AND pos = 0) AS given FROM batches) t""")

# ---- window features ------------------------------------------------------------------------------

_MOOD = "coalesce(final_sentiment_score, headline_sentiment_score, 0.0)"
_REPEAT = "CASE WHEN impact_score > 0 THEN impact_score * 2 ELSE 1 END"
_PARTS = {
    "window_sentiment": [
        ("avg_sentiment", rd(f"avg({_MOOD})", 4)),
        ("max_sentiment", rd(f"max({_MOOD})", 4)),
        ("min_sentiment", rd(f"min({_MOOD})", 4)),
        ("sentiment_std", f"coalesce({rd(f'stddev_samp({_MOOD})', 4)}, 0.0)"),
    ],
    "sentiment_buckets": [
        ("positive_count", f"count(*) FILTER ({_MOOD} > 0.1)"),
        ("negative_count", f"count(*) FILTER ({_MOOD} < -0.1)"),
        ("neutral_count", f"count(*) FILTER ({_MOOD} BETWEEN -0.1 AND 0.1)"),
    ],
    "weighted_sentiment": [
        ("weighted_avg_sentiment",
         rd(f"sum(final_sentiment_score * ({_REPEAT})) / sum({_REPEAT})", 4)),
    ],
    "window_impact": [
        ("avg_impact", rd("avg(impact_score)", 4)),
        ("max_impact", "CAST(max(impact_score) AS BIGINT)"),
        ("high_impact_count", "count(*) FILTER (impact_score >= 3)"),
        ("mid_impact_count", "count(*) FILTER (impact_score = 2)"),
        ("low_impact_count", "count(*) FILTER (impact_score <= 1)"),
    ],
    "net_impact": [
        ("net_impact_sentiment",
         "CAST(coalesce(sum(impact_score) FILTER (final_sentiment_score > 0.1), 0)"
         " - coalesce(sum(impact_score) FILTER (final_sentiment_score < -0.1), 0) AS DOUBLE)"),
    ],
    "event_flags": [(n, f"bool_or(event_type = {quote(k)})") for n, k in fv.EVENT_FLAGS.items()],
    "event_counts": [(n, f"count(*) FILTER (event_type = {quote(k)})") for n, k in fv.EVENT_COUNTS.items()],
    "asset_mentions": [
        (n, f"count(*) FILTER (list_contains(assets, {quote(a)}))") for n, a in fv.ASSET_COUNTS.items()
    ],
    "source_credibility": [
        ("avg_source_weight", rd("avg(source_weight)", 4)),
        ("max_source_weight", rd("max(source_weight)", 4)),
        ("avg_confidence", rd("avg(headline_sentiment_conf)", 4)),
    ],
}
for _name, _columns in _PARTS.items():
    _select = ", ".join(f"{sql} AS {alias}" for alias, sql in _columns)
    SQL[_name] = with_(*NEWS, last=f"SELECT window_start, {_select} FROM enriched GROUP BY window_start")

_ALL = [column for group in _PARTS.values() for column in group]
_DOUBLES = {
    "avg_sentiment", "max_sentiment", "min_sentiment", "sentiment_std", "weighted_avg_sentiment",
    "avg_impact", "net_impact_sentiment", "avg_source_weight", "max_source_weight", "avg_confidence",
}


def _zero(alias: str) -> str:
    if alias in _DOUBLES:
        return "CAST(0.0 AS DOUBLE)"
    return "false" if alias.startswith("has_") else "0"


def _window_features(enriched: str, cleaned: str) -> str:
    grouped = ", ".join(f"{sql} AS {alias}" for alias, sql in _ALL)
    filled = ", ".join(f"coalesce(e.{alias}, {_zero(alias)}) AS {alias}" for alias, _ in _ALL)
    return f"""
  SELECT c.window_start, coalesce(e.article_count, 0) AS article_count, c.total_raw,
    {rd('(c.total_raw - e.article_count) / c.total_raw', 4)} AS noise_ratio, {filled}
  FROM (SELECT window_start, count(*) AS total_raw FROM {cleaned} GROUP BY window_start) c
  LEFT JOIN (SELECT window_start, count(*) AS article_count, {grouped} FROM {enriched}
             GROUP BY window_start) e ON c.window_start = e.window_start"""


FEATURES = ("features", _window_features("enriched", "cleaned"))
SQL["window_features"] = with_(*NEWS, FEATURES, last="SELECT * FROM features")
SQL["window_volume"] = with_(
    *NEWS, FEATURES, last="SELECT window_start, article_count, total_raw FROM features"
)
SQL["noise_ratio"] = with_(
    *NEWS, FEATURES, last="SELECT window_start, article_count, total_raw, noise_ratio FROM features"
)
SQL["features_json"] = SQL["window_features"]


def _every_hour(first: str, last: str) -> str:
    filled = ", ".join(f"coalesce(f.{alias}, {_zero(alias)}) AS {alias}" for alias, _ in _ALL)
    return f"""
  SELECT h.window_start, coalesce(f.article_count, 0) AS article_count,
    coalesce(f.total_raw, 0) AS total_raw, f.noise_ratio, {filled}
  FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 HOUR)) AS window_start) h
  LEFT JOIN features f ON h.window_start = f.window_start"""


_FROM = "TIMESTAMP '2023-12-31 20:00:00'"
SQL["empty_windows"] = with_(*NEWS, FEATURES, last=_every_hour(_FROM, f"{_FROM} + INTERVAL 800 HOUR"))
SQL["sentiment_momentum"] = with_(*NEWS, FEATURES, last=f"""
SELECT window_start, avg_sentiment,
  coalesce({rd('avg_sentiment - lag(avg_sentiment) OVER (ORDER BY window_start)', 4)}, 0.0)
    AS sentiment_momentum FROM features""")

# ---- candles, macro, snapshots --------------------------------------------------------------------

_W = "OVER (PARTITION BY symbol ORDER BY open_time{})"


def _rows(n: int) -> str:
    return _W.format(f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")


_SEEN = f"count(*) {_rows(100)}"
CHANGED = ("changed", f"""
  SELECT *, {_SEEN} AS seen, coalesce(close - lag(close) {_W.format('')}, 0.0) AS change FROM candles""")


def _enough(n: int, x: str) -> str:
    return f"CASE WHEN seen >= {n} THEN {x} END"


def _return(n: int) -> str:
    return _enough(n, f"close / nullif(lag(close, {n - 1}) {_W.format('')}, 0) - 1")


_GAIN = f"avg(greatest(change, 0.0)) {_rows(14)}"
_LOSS = f"avg(greatest(-change, 0.0)) {_rows(14)}"
_RSI = _enough(15, f"CASE WHEN {_LOSS} = 0 AND {_GAIN} = 0 THEN NULL WHEN {_LOSS} = 0 THEN 100.0 "
                   f"ELSE 100 - 100 / (1 + {_GAIN} / {_LOSS}) END")
_STD = f"stddev_samp(close) {_rows(20)}"
_BB = _enough(20, f"CASE WHEN {_STD} = 0 THEN 0.5 "
                  f"ELSE (close - (avg(close) {_rows(20)} - 2 * {_STD})) / (4 * {_STD}) END")
_VR = _enough(20, f"volume / nullif(avg(volume) {_rows(20)}, 0)")


def _indicator(**columns: str) -> str:
    select = ", ".join(f"{rd(sql, 8)} AS {name}" for name, sql in columns.items())
    return with_(CANDLES, CHANGED, last=f"SELECT symbol, open_time, {select} FROM changed")


SQL["returns"] = _indicator(return_6=_return(6), return_24=_return(24))
SQL["rolling_mean"] = _indicator(
    mean_14=_enough(14, f"avg(close) {_rows(14)}"), mean_20=_enough(20, f"avg(close) {_rows(20)}")
)
SQL["rsi_14"] = _indicator(rsi_14=_RSI)
SQL["bb_position"] = _indicator(bb_position=_BB)
SQL["volume_ratio"] = _indicator(volume_ratio=_VR)

RECENT = ("recent", f"SELECT symbol, open_time, list(close) {_rows(100)} AS xs FROM candles")


def _ema(xs: str, n: str, span: int) -> str:
    """Closed form: weights (1 - alpha)^age over their sum, on the first n values."""
    keep = f"(1 - 2.0::DOUBLE / {span + 1})"
    return (
        f"list_sum(list_transform(range(1, {n} + 1), lambda j: {xs}[j] * pow({keep}, {n} - j)))"
        f" / list_sum(list_transform(range(1, {n} + 1), lambda j: pow({keep}, {n} - j)))"
    )


LINES = ("lines", f"""
  SELECT symbol, open_time, xs, list_transform(range(1, len(xs) + 1), lambda n:
    {_ema('xs', 'n', 12)} - {_ema('xs', 'n', 26)}) AS line FROM recent""")
MACD = ("macd", f"""
  SELECT symbol, open_time, CASE WHEN len(xs) > 26 THEN line[len(line)] - {_ema('line', 'len(line)', 9)} END
    AS macd FROM lines""")
SQL["ema"] = with_(CANDLES, RECENT, last=f"""
SELECT symbol, open_time, {rd(_ema('xs', 'len(xs)', 12), 8)} AS ema_12,
  {rd(_ema('xs', 'len(xs)', 26), 8)} AS ema_26 FROM recent""")
SQL["macd_hist"] = with_(
    CANDLES, RECENT, LINES, MACD, last=f"SELECT symbol, open_time, {rd('macd', 8)} AS macd FROM macd"
)
MARKET = ("market", f"""
  SELECT c.symbol, c.open_time, c.open AS btc_open, c.close AS btc_close, c.high AS btc_high,
    c.low AS btc_low, c.volume AS btc_volume, {_return(6)} AS btc_return_6h, {_return(24)} AS btc_return_24h,
    {_RSI} AS rsi_14, m.macd, {_BB} AS bb_position, {_VR} AS volume_ratio,
    CAST(NULL AS DOUBLE) AS etf_net_flow_24h
  FROM (SELECT * FROM changed) c JOIN macd m USING (symbol, open_time)""")
_MARKET_COLUMNS = ("btc_open", "btc_close", "btc_high", "btc_low", "btc_volume", "btc_return_6h",
                   "btc_return_24h", "rsi_14", "macd", "bb_position", "volume_ratio", "etf_net_flow_24h")
PRICES = (CANDLES, CHANGED, RECENT, LINES, MACD, MARKET)
_MARKET_SELECT = ", ".join(f"{rd(c, 8)} AS {c}" for c in _MARKET_COLUMNS)
SQL["market_features"] = with_(
    *PRICES, last=f"SELECT symbol, open_time, {_MARKET_SELECT} FROM market"
)

HOURS = ("hours", """
  SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS window_start
  FROM (SELECT min(date_trunc('hour', ts)) AS a, max(date_trunc('hour', ts)) AS b FROM events) t""")
SQL["candle_frame"] = with_(CANDLES, HOURS, last=f"""
SELECT h.window_start, c.open_time, c.open, c.high, c.low, c.close, c.volume
FROM hours h ASOF LEFT JOIN (SELECT * FROM candles WHERE symbol = '{inp.SYMBOL}') c
  ON h.window_start >= c.open_time""")
SQL["cast_candles"] = """
SELECT event_type AS symbol, date_trunc('milliseconds', ts) AS open_time, value AS open,
  CAST(NULL AS DOUBLE) AS high, value AS low, value AS close, CAST(event_id AS DOUBLE) AS volume,
  epoch_us(ts) // 1000 AS ms
FROM events"""
DAILY = ("daily", f"""
  SELECT ticker, day, {rd('close', 4)} AS close,
    {rd('(close - before) / nullif(before, 0)', 6)} AS daily_return, CAST(day AS TIMESTAMP) + INTERVAL 1 DAY AS at
  FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY day) AS before FROM macro) t""")
SQL["daily_return"] = with_(MACRO, DAILY, last="SELECT ticker, day, daily_return FROM daily")


def _macro_join(windows: str) -> tuple[str, str]:
    joins = " ".join(
        f"""ASOF LEFT JOIN (SELECT * FROM daily WHERE ticker = '{t}') {alias}
        ON w.window_start + INTERVAL 1 HOUR >= {alias}.at"""
        for t, alias in (("click", "a"), ("view", "b"), ("error", "g"), ("purchase", "s"), ("signup", "u"))
    )
    columns = ("coalesce(nullif(a.close, 0.0), b.close) AS dxy, g.close AS gold_price,"
               " s.daily_return AS sp500_return_1d, u.close AS us_10y_yield")
    return f"{windows} w {joins}", columns


_FROM_MACRO, _MACRO_COLUMNS = _macro_join("hours")
SQL["macro_asof"] = with_(
    MACRO, DAILY, HOURS, last=f"SELECT w.window_start, {_MACRO_COLUMNS} FROM {_FROM_MACRO}"
)
SNAPSHOTS = ("snapshots", """
  SELECT ts, CASE WHEN event_id % 3 <> 0 THEN value END AS btc_dominance,
    CASE WHEN event_id % 3 = 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END
      AS fear_greed_index
  FROM events""")
SQL["snapshot_json_path"] = with_(SNAPSHOTS, HOURS, last="""
SELECT 'reading' AS kind, ts AS at, btc_dominance, fear_greed_index FROM snapshots
UNION ALL
SELECT 'as of', h.window_start, d.btc_dominance, f.fear_greed_index
FROM hours h
ASOF LEFT JOIN (SELECT * FROM snapshots WHERE btc_dominance IS NOT NULL) d
  ON h.window_start + INTERVAL 1 HOUR >= d.ts
ASOF LEFT JOIN (SELECT * FROM snapshots WHERE fear_greed_index IS NOT NULL) f
  ON h.window_start + INTERVAL 1 HOUR >= f.ts""")


def _merged(news: tuple, macro_source: str = "every_hour") -> str:
    source, macro_columns = _macro_join(macro_source)
    news_columns = ", ".join(
        f"w.{c}" for c in ("window_start", "article_count", "total_raw", "noise_ratio", *[a for a, _ in _ALL])
    )
    prices = ", ".join(f"{rd('p.' + c, 8)} AS {c}" for c in _MARKET_COLUMNS)
    every = ("every_hour", _every_hour("(SELECT min(window_start) FROM features)",
                                       "(SELECT max(window_start) FROM features)"))
    return with_(*news, every, *PRICES, MACRO, DAILY, SNAPSHOTS, last=f"""
SELECT {news_columns}, {prices}, {macro_columns},
  CASE WHEN w.article_count > 0 THEN d.btc_dominance END AS btc_dominance,
  CAST(NULL AS DOUBLE) AS fear_greed_index,
  coalesce({rd('w.avg_sentiment - lag(w.avg_sentiment) OVER (ORDER BY w.window_start)', 4)}, 0.0)
    AS sentiment_momentum
FROM {source}
ASOF LEFT JOIN (SELECT * FROM market WHERE symbol = '{inp.SYMBOL}') p ON w.window_start >= p.open_time
ASOF LEFT JOIN (SELECT * FROM snapshots WHERE btc_dominance IS NOT NULL) d
  ON w.window_start + INTERVAL 1 HOUR >= d.ts""")


SQL["merge_feature_groups"] = _merged((*NEWS, FEATURES))

# The whole job: normalised articles, verdicts by id, lexicon scores, no weights table.
_JOB = (
    ARTICLES, RAW, NORMAL, ("verdict_ids", inp.VERDICTS_BY_ID),
    ("first_articles", """
      SELECT * FROM normal
      QUALIFY row_number() OVER (PARTITION BY window_start, id ORDER BY feed_ord, entry_ord) = 1"""),
    ("weights", "SELECT '' AS source, 0.6 AS weight WHERE false"),
    ("texts", f"""
      SELECT n.*, v.is_noise, v.category,
        lower({strip("concat_ws(' ', nullif(title, ''), nullif(content, ''))")}) AS txt
      FROM first_articles n LEFT JOIN verdict_ids v ON n.id = v.id"""),
    FOUND, CLASSED, IMPACT,
    ("counts", f"SELECT *, {_G} AS g, {_B} AS b, {_CG} AS cg, {_CB} AS cb FROM impacted"),
    ("scored", """
      SELECT *, g / (g + b + 1) AS p_pos, b / (g + b + 1) AS p_neg, cg / (cg + cb + 1) AS c_pos,
        cb / (cg + cb + 1) AS c_neg FROM counts"""),
    ("cleaned", _sentiments("scored")),
    ENRICHED, FEATURES,
)
SQL["hourly_features"] = _merged(_JOB)
SQL["pipeline_from_envelopes"] = SQL["hourly_features"]
# The user's classifier instead of given verdicts: it knows two phrases and names no category.
SQL["pipeline_with_plugins"] = _merged(tuple(
    (name, sql.replace("v.is_noise, v.category,", """
        regexp_matches(lower(concat(title, ' | ', content)), 'top 10|could') AS is_noise, 'unknown' AS category,"""))
    if name == "texts" else (name, sql)
    for name, sql in _JOB
))

SQL["stage_counts_in_flight"] = with_(*_JOB, last="""
SELECT 'raw' AS stage, count(*) AS n_rows FROM raw UNION ALL SELECT 'normalised', count(*) FROM normal
UNION ALL SELECT 'unique', count(*) FROM first_articles
UNION ALL SELECT 'candidates', count(*) FROM texts WHERE is_noise = false
UNION ALL SELECT 'kept', count(*) FROM enriched""")
SQL["ask_with_store"] = with_(ARTICLES, last="""
SELECT doc_id, regexp_matches(lower(concat(coalesce(title, ''), ' | ', coalesce(content, ''))), 'top 10|could') AS is_noise,
  CAST(NULL AS VARCHAR) AS reply_error
FROM articles""")
SQL["prompt_rounds"] = with_(ARTICLES, ("one", "SELECT doc_id, title, length(title) AS a FROM articles"),
    ("two", "SELECT *, length(concat(a, ' ', title)) AS b FROM one"),
    ("three", "SELECT *, length(concat(b, ' ', title)) AS c FROM two"), last="""
SELECT doc_id, CAST(CASE WHEN a % 2 = 1 THEN 1 WHEN b % 2 = 1 THEN 2 ELSE 3 END AS BIGINT) AS n_asked,
  CAST(CASE WHEN a % 2 = 1 THEN a WHEN b % 2 = 1 THEN b ELSE c END AS VARCHAR) AS reply,
  CAST(NULL AS VARCHAR) AS reply_error
FROM three""")

# ---- feature table --------------------------------------------------------------------------------

_NEWS_COLUMNS = ("total_raw", "noise_ratio", *[alias for alias, _ in _ALL])
_ABSENT = "".join(
    f", CAST(NULL AS DOUBLE) AS {c}"
    for c in ("sentiment_momentum", *_MARKET_COLUMNS, "btc_dominance", "fear_greed_index", "dxy", "gold_price",
              "sp500_return_1d", "us_10y_yield")
)
_KEPT = ", ".join(
    "CASE WHEN NOT second OR third THEN avg_sentiment END AS avg_sentiment" if c == "avg_sentiment" else c
    for c in _NEWS_COLUMNS
)
_ADDED = ", ".join("NULL" if c == "avg_sentiment" else c for c in _NEWS_COLUMNS)
SQL["upsert_features"] = with_(*NEWS, FEATURES, last=f"""
SELECT window_start,
  article_count + CASE WHEN third THEN 5000 WHEN second THEN 1000 ELSE 0 END AS article_count, {_KEPT}{_ABSENT}
FROM (SELECT *, hour(window_start) % 3 = 0 AND hour(window_start) > 0 AS second,
        hour(window_start) % 5 = 1 AS third FROM features) t
UNION ALL
SELECT window_start + INTERVAL 40 DAY, article_count + 1000, {_ADDED}{_ABSENT} FROM features
WHERE hour(window_start) = 0""")
SQL["latest_windows"] = with_(*NEWS, FEATURES, last="""
SELECT window_start, article_count, total_raw, avg_sentiment FROM features
ORDER BY window_start DESC LIMIT 5""")

# ---- streams --------------------------------------------------------------------------------------

OWN = ("articles", inp.articles_sql(twins=False))
SQL["stream_clean"] = with_(OWN, last="SELECT doc_id, id, title, published_at FROM articles")
_STREAMED = (
    OWN, ("weights", "SELECT '' AS source, 0.6 AS weight WHERE false"), TEXTS, FOUND, CLASSED, IMPACT,
    ("counts", f"SELECT *, {_G} AS g, {_B} AS b, {_CG} AS cg, {_CB} AS cb FROM impacted"),
    ("scored", """
      SELECT *, CASE WHEN doc_id % 3 <> 0 THEN doc_id % 3 = 1 END AS is_noise, g / (g + b + 1) AS p_pos,
        b / (g + b + 1) AS p_neg, cg / (cg + cb + 1) AS c_pos, cb / (cg + cb + 1) AS c_neg FROM counts"""),
    ("cleaned", _sentiments("scored")),
    ENRICHED, FEATURES,
)
SQL["stream_window_features"] = with_(*_STREAMED, last=f"""
SELECT window_start, article_count, total_raw, noise_ratio, avg_sentiment, sentiment_std, avg_impact,
  has_hack, regulation_count, btc_mentions, avg_source_weight,
  coalesce({rd('avg_sentiment - lag(avg_sentiment) OVER (ORDER BY window_start)', 4)}, 0.0)
    AS sentiment_momentum
FROM features""")


_FIRST = dict(_JOB)["first_articles"]
SQL["stream_intake"] = with_(ARTICLES, RAW, NORMAL, ("first_articles", _FIRST), last="""
SELECT window_start, id, CAST(feed_ord AS BIGINT) AS feed_ord, url, title, content_hash FROM first_articles""")
SQL["stream_survivor_features"] = with_(*_JOB, last=f"""
SELECT window_start, article_count, total_raw, noise_ratio, avg_sentiment, sentiment_std, avg_impact,
  has_hack, regulation_count, btc_mentions, avg_source_weight,
  coalesce({rd('avg_sentiment - lag(avg_sentiment) OVER (ORDER BY window_start)', 4)}, 0.0)
    AS sentiment_momentum
FROM features""")
_SLICES = (
    ARTICLES, RAW,
    ("newest", """
      SELECT doc_id % 6 AS batch, max(published_at) FILTER (error IS NULL) AS newest FROM raw GROUP BY ALL"""),
    ("marks", "SELECT b.batch, max(a.newest) - INTERVAL 20 DAY AS mark FROM newest b LEFT JOIN newest a ON a.batch < b.batch GROUP BY ALL"),
    ("dealt", """
      SELECT r.*, m.batch, CASE WHEN error IS NOT NULL THEN 'rejected' WHEN published_at < mark THEN 'late' ELSE 'accepted' END AS outcome
      FROM raw r JOIN marks m ON r.doc_id % 6 = m.batch"""),
    ("placed", """
      SELECT *, outcome = 'accepted' AND row_number() OVER (PARTITION BY outcome, window_start, id ORDER BY feed_ord, entry_ord) = 1
        AS first FROM dealt"""),
)
SQL["stream_accounts"] = with_(*_SLICES, last="""
SELECT batch, count(*) AS read, count(*) FILTER (outcome = 'late') AS late,
  count(*) FILTER (outcome = 'rejected') AS rejected, count(*) FILTER (first) AS first,
  count(*) FILTER (outcome = 'accepted' AND NOT first) AS copies
FROM placed GROUP BY batch""")
SQL["stream_late_rows"] = with_(*_SLICES, last="""
SELECT batch, id, published_at, full_title AS title FROM dealt WHERE outcome = 'late'""")
