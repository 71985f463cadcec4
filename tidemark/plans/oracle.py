"""DuckDB SQL oracles, one per registered query.

Written independently of the Spark code from the same rules (FIXTURES.md
§3): the bindings, the envelope router and every operator are restated in
plain SQL over the driver's views. Shared pieces are CTE fragments.
Parity rules: doubles rounded to 6 dp, integers as BIGINT, ratios as DOUBLE.
"""

from __future__ import annotations

from tidemark import constants as K
from tidemark.functions.dates import lookback_cutoff

RAW = "('twitter_raw','reddit_raw','news_raw')"
SCORED_TOPICS = "('sentiment_scored','twitter_raw','reddit_raw','news_raw')"

EV = """
ev0 AS (
  SELECT *, 'U'||lpad(CAST(user_id AS VARCHAR),greatest(4,length(CAST(user_id AS VARCHAR)))::INT,'0') AS sym,
            'u'||lpad(CAST(user_id AS VARCHAR),greatest(4,length(CAST(user_id AS VARCHAR)))::INT,'0') AS comp,
            strftime(ts,'%Y-%m-%d') AS day,
            strftime(ts,'%Y-%m-%dT%H:%M:%S.%f') AS iso,
            CASE event_type WHEN 'error' THEN 'NEGATIVE' WHEN 'purchase' THEN 'POSITIVE'
                 ELSE 'NEUTRAL' END AS label,
            CASE WHEN event_type='signup' AND event_id % 5 = 0 THEN NULL
                 ELSE value/500 END AS score,
            CASE WHEN event_type IN ('click','view') THEN 'prices_raw'
                 WHEN event_type='error' THEN 'twitter_raw'
                 WHEN event_type='signup' AND event_id % 13 = 0 THEN 'alerts_raw'
                 ELSE 'sentiment_scored' END AS topic
  FROM events),
ev AS (
  SELECT *, CASE WHEN event_id % 50 = 0 THEN NULL
                 WHEN event_id % 3 = 0 THEN comp||' shares tumble after weak guidance'
                 WHEN event_id % 3 = 1 THEN comp||' posts record quarterly revenue'
                 ELSE 'Market reacts to '||comp||' news' END AS txt
  FROM ev0)"""

BARS = """
bars AS (
  SELECT sym AS symbol, day AS date, arg_min(value, event_id) AS open, max(value) AS high,
         min(value) AS low, arg_max(value, event_id) AS close, round(sum(value), 2) AS volume
  FROM ev WHERE event_type IN ('click','view') GROUP BY 1, 2)"""

SCORED = """
scored AS (
  SELECT CAST(event_id AS VARCHAR) AS id, comp AS company, iso AS timestamp, day AS date,
         label, score, event_id, txt AS text
  FROM ev WHERE event_type IN ('error','purchase','signup'))"""

DIM = """
dim AS (SELECT DISTINCT comp AS company, sym AS symbol FROM ev WHERE user_id % 4 <> 3)"""

MESSAGES = """
messages AS (
  SELECT topic, user_id % 4 AS partition, event_id AS "offset",
         epoch_us(ts) // 1000 AS timestamp_ms,
         CASE WHEN event_id % 101 = 0 THEN 'not json'
              WHEN event_id % 97 = 0 THEN '"plain"'
              ELSE CASE WHEN event_id % 89 = 0 THEN chr(10) WHEN event_id % 83 = 0 THEN chr(9) || ' '
                        WHEN event_id % 79 = 0 THEN chr(13) || chr(10) ELSE '' END || CASE
              WHEN topic = 'prices_raw' THEN json_object(
                'symbol', sym, 'closing_price', value, 'opening_price', value - 0.25,
                'high', value + 0.5, 'low', value - 0.5,
                'volume', CAST(user_id * 10 + event_id % 10 AS DOUBLE), 'timestamp', day)::VARCHAR
              WHEN topic = 'twitter_raw' THEN json_object(
                'id', CAST(event_id AS VARCHAR), 'company', comp,
                'timestamp', CASE WHEN event_id % 7 = 0 THEN '' ELSE iso END, 'text', txt,
                'replyCount', event_id % 7, 'likeCount', event_id % 11,
                'quoteCount', event_id % 3, 'repostCount', event_id % 5)::VARCHAR
              WHEN topic = 'sentiment_scored' THEN json_object(
                'id', CAST(event_id AS VARCHAR), 'company', comp, 'text', txt,
                'sentiment_label', label, 'sentiment_score', score, 'timestamp', iso)::VARCHAR
              ELSE json_object('company', comp, 'timestamp', iso, 'event_id', event_id)::VARCHAR END
         END AS value
  FROM ev)"""

ENVELOPE = """
m1 AS (SELECT *, CASE WHEN json_valid(value) THEN value::JSON END AS j FROM messages),
m2 AS (SELECT *, json_type(j) = 'OBJECT' AS obj FROM m1 WHERE j IS NOT NULL),
env AS (
  SELECT topic AS source_topic, timestamp_ms AS kafka_timestamp_ms, partition AS kafka_partition,
    "offset" AS kafka_offset,
    CASE WHEN NOT obj THEN NULL
         WHEN topic = 'prices_raw' THEN j->>'$.symbol'
         WHEN topic IN {scored_topics} THEN j->>'$.company'
         ELSE coalesce(nullif(j->>'$.symbol', ''), j->>'$.company') END AS symbol,
    coalesce(CASE WHEN NOT obj THEN '{as_of}'
                  WHEN topic IN ('prices_raw','sentiment_scored') THEN j->>'$.timestamp'
                  ELSE coalesce(nullif(j->>'$.timestamp', ''), '{as_of}') END, '{as_of}') AS timestamp,
    CASE WHEN NOT obj THEN 'unknown' WHEN topic = 'prices_raw' THEN 'price'
         WHEN topic = 'sentiment_scored' THEN 'sentiment'
         WHEN topic IN {raw} THEN topic ELSE 'unknown_topic' END AS doc_type,
    CASE WHEN obj AND topic = 'prices_raw' THEN TRY_CAST(json_extract(j, '$.closing_price') AS DOUBLE) END AS closing_price,
    CASE WHEN obj AND topic = 'prices_raw' THEN TRY_CAST(json_extract(j, '$.opening_price') AS DOUBLE) END AS opening_price,
    CASE WHEN obj AND topic = 'prices_raw' THEN TRY_CAST(json_extract(j, '$.high') AS DOUBLE) END AS high,
    CASE WHEN obj AND topic = 'prices_raw' THEN TRY_CAST(json_extract(j, '$.low') AS DOUBLE) END AS low,
    CASE WHEN obj AND topic = 'prices_raw' THEN TRY_CAST(json_extract(j, '$.volume') AS DOUBLE) END AS volume,
    CASE WHEN obj AND topic IN {scored_topics} THEN j->>'$.text' END AS text,
    CASE WHEN obj AND topic IN {scored_topics} THEN j->>'$.id' END AS id,
    CASE WHEN obj AND topic = 'sentiment_scored'
         THEN coalesce(j->>'$.sentiment_label', j->>'$.sentiment') END AS sentiment_label,
    CASE WHEN obj AND topic = 'sentiment_scored'
         THEN TRY_CAST(json_extract(j, '$.sentiment_score') AS DOUBLE) END AS sentiment_score,
    CAST(NULL AS VARCHAR) AS original_text, CAST(NULL AS VARCHAR) AS processed_at,
    CASE WHEN NOT obj OR topic NOT IN ('prices_raw', {scored_topics_inner})
         THEN value END AS payload
  FROM m2)"""


def envelope_ctes(as_of: str = K.AS_OF) -> str:
    return ",".join([EV, MESSAGES, ENVELOPE.format(
        as_of=as_of, raw=RAW, scored_topics=SCORED_TOPICS,
        scored_topics_inner=SCORED_TOPICS[1:-1])])


def nudge_rounding(sql: str, digits: int = 6) -> str:
    """Rewrite every ``round(expr, 6)`` into ``round((expr) * (1 + 1e-12), 6) + 0.0``,
    the same tie-proof rounding the Spark side applies at its report edge
    (the ``+ 0.0`` normalises DuckDB's -0.0, which Spark's rounding never emits)."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k, comma = 1, j + len(key), -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner, arg = sql[j + len(key):comma], sql[comma + 1:k - 1].strip()
        out.append(sql[i:j])
        if arg == str(digits):
            # "+ 0.0" turns -0.0 into 0.0 (Spark's round never yields -0.0)
            out.append(f"(round(({nudge_rounding(inner, digits)}) * (1 + 1e-12), {digits}) + 0.0::DOUBLE)")
        else:
            out.append(f"(round({nudge_rounding(inner, digits)}, {arg}) + 0.0::DOUBLE)")
        i = k


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def r6(x: str, alias: str | None = None) -> str:
    return f"round({x}, 6) AS {alias or x}"


# flagship
def training_frame(as_of: str = K.AS_OF, days: int = K.LOOKBACK_DAYS) -> str:
    cutoff = lookback_cutoff(as_of, days)
    return with_(envelope_ctes(as_of), DIM, f"""
docs AS (
  SELECT symbol AS company, timestamp, sentiment_label AS label, sentiment_score AS score
  FROM env WHERE doc_type = 'sentiment' AND timestamp >= '{cutoff}'),
daily AS (
  SELECT company, strftime(TRY_CAST(timestamp AS TIMESTAMP), '%Y-%m-%d') AS date,
         avg(score) AS avg_sentiment, count(*) AS sentiment_count,
         avg(CASE WHEN upper(label) = 'POSITIVE' THEN 1.0 ELSE 0.0 END)::DOUBLE AS positive_ratio
  FROM docs WHERE TRY_CAST(timestamp AS TIMESTAMP) IS NOT NULL GROUP BY 1, 2),
mapped AS (SELECT daily.*, dim.symbol FROM daily JOIN dim ON lower(daily.company) = lower(dim.company)),
prices AS (
  SELECT split_part(timestamp, 'T', 1) AS date, symbol, closing_price AS close,
         opening_price AS open, high, low, volume, kafka_timestamp_ms, kafka_offset
  FROM env WHERE doc_type = 'price'),
j AS (SELECT p.*, m.avg_sentiment FROM prices p
      LEFT JOIN mapped m ON p.date = m.date AND p.symbol = m.symbol)
SELECT date, symbol,
  round(last_value(open IGNORE NULLS) OVER w, 6) AS open,
  round(last_value(high IGNORE NULLS) OVER w, 6) AS high,
  round(last_value(low IGNORE NULLS) OVER w, 6) AS low,
  round(last_value(close IGNORE NULLS) OVER w, 6) AS close,
  round(last_value(volume IGNORE NULLS) OVER w, 6) AS volume,
  round(last_value(avg_sentiment IGNORE NULLS) OVER w, 6) AS avg_sentiment
FROM j WHERE symbol IS NOT NULL
WINDOW w AS (PARTITION BY symbol ORDER BY date, kafka_timestamp_ms, kafka_offset
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")


# shared pieces
def env_query(select: str, as_of: str = K.AS_OF, extra: str = "") -> str:
    return with_(envelope_ctes(as_of), *( [extra] if extra else [])) + "\n" + select


ENV_COLS = ("source_topic, kafka_timestamp_ms, kafka_partition, kafka_offset, symbol, timestamp, "
            "doc_type, round(closing_price, 6) AS closing_price, round(opening_price, 6) AS opening_price, "
            "round(high, 6) AS high, round(low, 6) AS low, round(volume, 6) AS volume, text, id, "
            "sentiment_label, round(sentiment_score, 6) AS sentiment_score, original_text, "
            "processed_at, payload")

DAILY_OF = """
{name} AS (
  SELECT company, strftime(TRY_CAST(timestamp AS TIMESTAMP), '%Y-%m-%d') AS date,
         avg(score) AS avg_sentiment, count(*) AS sentiment_count,
         avg(CASE WHEN upper(label) = 'POSITIVE' THEN 1.0 ELSE 0.0 END)::DOUBLE AS positive_ratio
  FROM {src} WHERE TRY_CAST(timestamp AS TIMESTAMP) IS NOT NULL GROUP BY 1, 2)"""

MAPPED = """
mapped AS (SELECT daily.*, dim.symbol FROM daily JOIN dim ON lower(daily.company) = lower(dim.company))"""

PRICES = """
prices AS (
  SELECT split_part(timestamp, 'T', 1) AS date, symbol, closing_price AS close,
         opening_price AS open, high, low, volume, kafka_timestamp_ms, kafka_offset
  FROM env WHERE doc_type = 'price')"""

SPLIT = """
numbered AS (SELECT *, row_number() OVER (ORDER BY date, symbol) AS row_id,
                    count(*) OVER () AS n_rows FROM bars),
split AS (
  SELECT *, CASE WHEN row_id <= floor(0.7::DOUBLE * n_rows) THEN 'train'
                 WHEN row_id <= {val_end} THEN 'val' ELSE 'test' END AS split
  FROM numbered)"""

VAL_END = "floor(0.85::DOUBLE * n_rows)"
VAL_END_ADD = "floor(0.7::DOUBLE * n_rows) + floor(0.15::DOUBLE * n_rows)"

BAR_ROUND = ("round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, "
             "round(close, 6) AS close, round(volume, 6) AS volume")


def kw_label(text: str, neg=K.NEGATIVE_WORDS, pos=K.POSITIVE_WORDS) -> str:
    n = " OR ".join(f"contains(lower({text}), '{w}')" for w in neg)
    p = " OR ".join(f"contains(lower({text}), '{w}')" for w in pos)
    return (f"CASE WHEN {text} IS NULL THEN NULL WHEN {n} THEN 'NEGATIVE' "
            f"WHEN {p} THEN 'POSITIVE' ELSE 'NEUTRAL' END")


def polarity(label: str) -> str:
    return (f"CASE WHEN {label} = 'POSITIVE' THEN 1.0::DOUBLE WHEN {label} = 'NEGATIVE' "
            f"THEN -1.0::DOUBLE WHEN {label} IS NOT NULL THEN 0.0::DOUBLE END")


def batch_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    cut = lookback_cutoff(K.AS_OF, K.LOOKBACK_DAYS)
    base = [EV, BARS, SCORED, DIM]
    q["json_decode"] = with_(EV, MESSAGES, """
m AS (SELECT *, CASE WHEN json_valid(value) THEN value::JSON END AS j FROM messages
      WHERE topic = 'prices_raw'),
o AS (SELECT * FROM m WHERE j IS NOT NULL AND json_type(j) = 'OBJECT')""") + """
SELECT partition, "offset" AS offset, j->>'$.symbol' AS symbol,
  round(TRY_CAST(json_extract(j, '$.closing_price') AS DOUBLE), 6) AS closing_price,
  round(TRY_CAST(json_extract(j, '$.opening_price') AS DOUBLE), 6) AS opening_price,
  round(TRY_CAST(json_extract(j, '$.high') AS DOUBLE), 6) AS high,
  round(TRY_CAST(json_extract(j, '$.low') AS DOUBLE), 6) AS low,
  round(TRY_CAST(json_extract(j, '$.volume') AS DOUBLE), 6) AS volume,
  j->>'$.timestamp' AS timestamp FROM o"""
    q["multi_topic_union"] = with_(EV, MESSAGES, """
m AS (SELECT *, CASE WHEN json_valid(value) THEN value::JSON END AS j FROM messages
      WHERE topic IN ('twitter_raw','reddit_raw','news_raw','sentiment_scored')),
o AS (SELECT * FROM m WHERE j IS NOT NULL AND json_type(j) = 'OBJECT')""") + """
SELECT topic, "offset" AS offset, timestamp_ms, j->>'$.id' AS id, j->>'$.company' AS company,
  j->>'$.timestamp' AS timestamp, j->>'$.text' AS text, j->>'$.sentiment_label' AS sentiment_label,
  round(TRY_CAST(json_extract(j, '$.sentiment_score') AS DOUBLE), 6) AS sentiment_score FROM o"""
    q["headline_union"] = with_(EV) + """
SELECT CASE WHEN event_id % 2 = 0 THEN 'reddit_raw' ELSE 'news_raw' END AS topic, event_id AS "offset",
  CAST(event_id AS VARCHAR) AS id, txt AS text, floor(epoch(ts))::BIGINT AS ts,
  strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.%f') AS event_time
FROM ev WHERE event_type = 'purchase'"""
    q["headline_envelope"] = with_(EV) + """
SELECT CASE WHEN event_id % 2 = 0 THEN 'reddit_raw' ELSE 'news_raw' END AS source_topic, event_id AS kafka_offset,
  CAST(NULL AS VARCHAR) AS symbol, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
  txt AS text, CAST(event_id AS VARCHAR) AS id
FROM ev WHERE event_type = 'purchase'"""
    q["price_scan"] = env_query(
        "SELECT symbol, timestamp, round(closing_price, 6) AS closing_price, "
        "round(opening_price, 6) AS opening_price, round(high, 6) AS high, round(low, 6) AS low, "
        "round(volume, 6) AS volume FROM env WHERE doc_type = 'price'")
    q["unscored_texts"] = env_query(
        f"SELECT source_topic, kafka_offset, symbol, timestamp, text, id FROM env "
        f"WHERE doc_type IN {RAW} AND sentiment_score IS NULL")
    q["bars_load"] = with_(EV, BARS) + f"\nSELECT date, symbol, {BAR_ROUND} FROM bars"
    q["sample_by_type"] = env_query("""
SELECT doc_type, source_topic, kafka_offset, symbol, timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_type ORDER BY kafka_timestamp_ms, kafka_offset) AS r
  FROM env) WHERE r = 1""")
    for name, kind in [("envelope_price", "price"), ("envelope_sentiment", "sentiment"),
                       ("envelope_social", K.TOPIC_TWITTER),
                       ("envelope_unknown_topic", "unknown_topic"),
                       ("envelope_non_object", "unknown")]:
        q[name] = env_query(f"SELECT {ENV_COLS} FROM env WHERE doc_type = '{kind}'")
    q["timestamp_default"] = env_query(
        f"SELECT source_topic, kafka_offset, doc_type, symbol, timestamp FROM env "
        f"WHERE timestamp = '{K.AS_OF}'")
    q["envelope_all"] = env_query(f"SELECT {ENV_COLS} FROM env")
    q["flatten_posts"] = with_(EV) + """
SELECT CAST(event_id AS VARCHAR) AS id, comp AS company,
  CASE WHEN event_id % 10 = 0 THEN 'unknown' ELSE day END AS timestamp,
  coalesce(txt, '') AS text, event_id % 7 AS replyCount,
  CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 11 END AS likeCount,
  event_id % 5 AS repostCount, 0::BIGINT AS quoteCount
FROM ev WHERE event_type IN ('error','purchase','signup')"""
    q["normalize_bars"] = with_(EV) + """
SELECT sym AS symbol, round(value / 3, 2) AS closing_price, round(value / 7, 2) AS opening_price,
  round(value / 3 + 1, 2) AS high, round(value / 7 - 1, 2) AS low, round(value / 9, 2) AS volume,
  day AS timestamp
FROM ev WHERE event_type IN ('click','view')"""
    q["company_to_symbol"] = with_(*base, DAILY_OF.format(name="daily", src="scored"), MAPPED) + """
SELECT company, date, round(avg_sentiment, 6) AS avg_sentiment, sentiment_count,
  round(positive_ratio, 6) AS positive_ratio, symbol FROM mapped"""
    q["date_part"] = env_query(
        "SELECT source_topic, kafka_offset, timestamp, split_part(timestamp, 'T', 1) AS date FROM env")
    q["schema_completion"] = env_query(
        f"SELECT date, symbol, {BAR_ROUND}, CAST(NULL AS DOUBLE) AS avg_sentiment FROM prices",
        extra=PRICES)
    q["lookback_filter"] = env_query(
        f"SELECT source_topic, kafka_offset, symbol, timestamp FROM env "
        f"WHERE doc_type IN ('sentiment', 'twitter_raw') AND timestamp >= '{cut}'")
    q["temporal_split"] = with_(EV, BARS, SPLIT.format(val_end=VAL_END)) + \
        "\nSELECT symbol, date, row_id, split FROM split"
    q["temporal_split_additive"] = with_(EV, BARS, SPLIT.format(val_end=VAL_END_ADD)) + \
        "\nSELECT symbol, date, row_id, split FROM split"
    q["symbol_slice"] = with_(EV, BARS) + f"""
SELECT symbol, date, {BAR_ROUND} FROM bars
WHERE symbol = 'U0001' AND (SELECT count(*) FROM bars WHERE symbol = 'U0001') >= {K.SEQUENCE_LENGTH}"""
    q["drop_incomplete"] = "SELECT * FROM (" + training_frame() + """
) WHERE date IS NOT NULL AND symbol IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL
  AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL AND avg_sentiment IS NOT NULL"""
    for name, col in [("next_target", "open"), ("next_target_close", "close")]:
        q[name] = with_(EV, BARS) + f"""
SELECT * FROM (
  SELECT symbol, date, {BAR_ROUND},
    round(lead({col}) OVER (PARTITION BY symbol ORDER BY date), 6) AS target_price FROM bars)
WHERE target_price IS NOT NULL"""
    q["keyword_score"] = with_(*base) + f"""
SELECT id, company, text, {kw_label('text')} AS sentiment FROM scored"""
    q["price_sentiment_join"] = with_(*base, DAILY_OF.format(name="daily", src="scored"), MAPPED) + f"""
SELECT b.date, b.symbol, round(b.open, 6) AS open, round(b.high, 6) AS high, round(b.low, 6) AS low,
  round(b.close, 6) AS close, round(b.volume, 6) AS volume, m.company,
  round(m.avg_sentiment, 6) AS avg_sentiment, m.sentiment_count,
  round(m.positive_ratio, 6) AS positive_ratio
FROM bars b LEFT JOIN mapped m ON b.date = m.date AND b.symbol = m.symbol"""
    # the features' sentiment is filled forward; rows before the first value are left out
    feat = [*base, DAILY_OF.format(name="daily", src="scored"), MAPPED, """
feat AS (SELECT b.symbol, b.date, b.open, last_value(m.avg_sentiment IGNORE NULLS) OVER (
           PARTITION BY b.symbol ORDER BY b.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
         FROM bars b LEFT JOIN mapped m ON b.date = m.date AND b.symbol = m.symbol)"""]
    target = """
tgt AS (SELECT * FROM (SELECT *, lead(open) OVER (PARTITION BY symbol ORDER BY date) AS target_price FROM feat)
        WHERE target_price IS NOT NULL AND filled IS NOT NULL)"""
    ml_split = SPLIT.format(val_end=VAL_END).replace("FROM bars", "FROM tgt")
    q["ml_split_rows"] = with_(*feat, target, ml_split) + """
SELECT symbol, date, round(open, 6) AS open, round(target_price, 6) AS target_price, split FROM split"""
    q["gbt_test_keys"] = with_(*feat, target, ml_split) + """
SELECT symbol, date, true AS predicted FROM split WHERE split = 'test'"""
    q["model_roundtrip_same"] = with_(*feat, target, ml_split) + """
SELECT true AS same, count(*) AS n FROM split WHERE split = 'test'"""
    q["validated_training"] = with_(*feat, target, ml_split) + """
SELECT split, count(*) AS n_rows, true AS same FROM split WHERE split <> 'test' GROUP BY split"""
    q["predict_next_day_keys"] = with_(*feat) + """
SELECT symbol, max(date) AS date FROM feat WHERE filled IS NOT NULL GROUP BY symbol"""
    q["tweet_price_join"] = with_(*base, f"""
tw AS (SELECT id, company, date, text, {kw_label('text')} AS sentiment_label FROM scored),
tw2 AS (SELECT tw.*, {polarity('sentiment_label')} AS sentiment_score, dim.symbol AS ticker
        FROM tw JOIN dim ON lower(tw.company) = lower(dim.company))""") + f"""
SELECT t.date, t.ticker, t.id, t.company, t.text, t.sentiment_label,
  round(t.sentiment_score, 6) AS sentiment_score, {BAR_ROUND.replace('round(', 'round(b.')}
FROM tw2 t JOIN bars b ON t.date = b.date AND t.ticker = b.symbol"""
    q["unscored_antijoin"] = """
SELECT doc_id, lang, source, n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""
    q["recent_sentiment_join"] = with_(*base, f"""
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS r
           FROM bars WHERE date < '{K.AS_OF[:10]}') WHERE r = 1),
rc AS (SELECT company, sum(score) AS s, count(score) AS ns, count(*) AS n FROM scored
       WHERE TRY_CAST(timestamp AS TIMESTAMP) >= TIMESTAMP '{K.AS_OF.replace('T', ' ')}' - INTERVAL 72 HOUR
         AND TRY_CAST(timestamp AS TIMESTAMP) < TIMESTAMP '{K.AS_OF.replace('T', ' ')}'
       GROUP BY company),
rs AS (SELECT dim.symbol, sum(s) / nullif(sum(ns), 0) AS recent_sentiment, sum(n) AS recent_count
       FROM rc JOIN dim ON lower(rc.company) = lower(dim.company) GROUP BY dim.symbol)""") + f"""
SELECT l.symbol, l.date, {BAR_ROUND.replace('round(', 'round(l.')},
  round(rs.recent_sentiment, 6) AS recent_sentiment, rs.recent_count::BIGINT AS recent_count
FROM latest l LEFT JOIN rs ON l.symbol = rs.symbol"""
    upd = f"(doc_type IN {RAW} AND sentiment_score IS NULL AND text IS NOT NULL)"
    q["apply_scores"] = env_query(f"""
SELECT source_topic, kafka_timestamp_ms, kafka_partition, kafka_offset, symbol, timestamp,
  CASE WHEN {upd} THEN 'sentiment' ELSE doc_type END AS doc_type,
  round(closing_price, 6) AS closing_price, round(opening_price, 6) AS opening_price,
  round(high, 6) AS high, round(low, 6) AS low, round(volume, 6) AS volume, text, id,
  CASE WHEN {upd} THEN {kw_label('text')} ELSE sentiment_label END AS sentiment_label,
  round(CASE WHEN {upd} THEN {polarity(kw_label('text'))} ELSE sentiment_score END, 6) AS sentiment_score,
  CASE WHEN {upd} THEN text ELSE original_text END AS original_text,
  CASE WHEN {upd} THEN '{K.AS_OF}' ELSE processed_at END AS processed_at, payload
FROM env""")
    q["score_store"] = q["apply_scores"]
    q["daily_sentiment"] = env_query("""
SELECT company, date, round(avg_sentiment, 6) AS avg_sentiment, sentiment_count,
  round(positive_ratio, 6) AS positive_ratio FROM daily""", extra="""
docs AS (SELECT symbol AS company, timestamp, sentiment_label AS label, sentiment_score AS score
         FROM env WHERE doc_type = 'sentiment'),""" + DAILY_OF.format(name="daily", src="docs"))
    q["avg_sentiment_by_company"] = with_(*base) + """
SELECT date, company, round(avg(score), 6) AS avg_sentiment FROM scored GROUP BY date, company"""
    q["row_counts"] = with_(EV, MESSAGES) + "\nSELECT topic, count(*) AS n_rows FROM messages GROUP BY topic"
    q["regression_metrics"] = with_(EV, BARS) + """
SELECT round(avg((close - open) * (close - open)), 6) AS mse, round(avg(abs(close - open)), 6) AS mae,
  round(avg(abs((close - open) / nullif(close, 0))) * 100.0, 6) AS mape, count(*) AS n FROM bars"""
    feats = ["open", "high", "low", "close", "volume"]
    fit_cols = ", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in feats)
    q["minmax_fit"] = with_(EV, BARS, SPLIT.format(val_end=VAL_END)) + \
        f"\nSELECT {fit_cols} FROM split WHERE split = 'train'"
    q["distinct_symbols"] = with_(EV, BARS) + "\nSELECT DISTINCT symbol FROM bars"
    q["eligible_symbols"] = with_(EV, BARS) + f"""
SELECT symbol, count(*) AS n_rows FROM bars GROUP BY symbol HAVING count(*) >= {3 * K.SEQUENCE_LENGTH}"""
    q["daily_return"] = with_(EV, BARS) + """
SELECT symbol, date, round(close, 6) AS close,
  round(c / nullif(lag(c) OVER (PARTITION BY symbol ORDER BY date), 0) - 1, 6) AS daily_return
FROM (SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM bars)"""
    q["bucketed_return"] = q["daily_return"]
    q["forward_fill"] = with_(*base, DAILY_OF.format(name="daily", src="scored"), MAPPED, """
j AS (SELECT b.*, m.avg_sentiment, m.sentiment_count, m.positive_ratio
      FROM bars b LEFT JOIN mapped m ON b.date = m.date AND b.symbol = m.symbol)""") + f"""
SELECT date, symbol, {BAR_ROUND},
  round(last_value(avg_sentiment IGNORE NULLS) OVER w, 6) AS avg_sentiment,
  last_value(sentiment_count IGNORE NULLS) OVER w AS sentiment_count,
  round(last_value(positive_ratio IGNORE NULLS) OVER w, 6) AS positive_ratio
FROM j WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    q["row_id"] = with_(EV, BARS) + """
SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn,
  count(*) OVER (PARTITION BY symbol) AS n FROM bars"""
    seq = with_(EV, BARS, f"""
t AS (SELECT *, lead(open) OVER (PARTITION BY symbol ORDER BY date) AS target_price,
             row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn,
             count(*) OVER (PARTITION BY symbol) AS n FROM bars),
s AS (SELECT *, sum(close) OVER f AS sum_close, first_value(open) OVER f AS first_open,
             first_value(date) OVER f AS first_date,
             lead(date) OVER (PARTITION BY symbol ORDER BY date) AS label_date
      FROM t WINDOW f AS (PARTITION BY symbol ORDER BY date
                          ROWS BETWEEN {K.SEQUENCE_LENGTH - 1} PRECEDING AND CURRENT ROW)),
w AS (SELECT * FROM s WHERE rn >= {K.SEQUENCE_LENGTH} AND rn <= n - 1)""")
    q["sequence_windows"] = seq + f"""
SELECT symbol, rn - {K.SEQUENCE_LENGTH} AS idx, {K.SEQUENCE_LENGTH}::BIGINT AS n_x,
  round(sum_close, 6) AS sum_close, round(first_open, 6) AS first_open, round(target_price, 6) AS y
FROM w"""
    q["sequence_dates"] = seq + f"""
SELECT symbol, rn - {K.SEQUENCE_LENGTH} AS idx, first_date, date AS last_date, label_date FROM w"""
    q["latest_sequence"] = with_(EV, BARS) + f"""
SELECT symbol, min(date) AS first_date, max(date) AS last_date, count(*) AS n_rows,
  round(sum(close), 6) AS sum_close
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS r FROM bars)
WHERE r <= {K.SEQUENCE_LENGTH} GROUP BY symbol"""
    q["cumulative_return"] = with_(EV, BARS, """
p AS (SELECT symbol, date, close AS actual, open AS prediction FROM bars),
r AS (SELECT *, ca / nullif(lag(ca) OVER w, 0) - 1 AS ret_actual,
              cp / nullif(lag(cp) OVER w, 0) - 1 AS ret_prediction
      FROM (SELECT *, last_value(actual IGNORE NULLS) OVER u AS ca,
                      last_value(prediction IGNORE NULLS) OVER u AS cp
            FROM p WINDOW u AS (PARTITION BY symbol ORDER BY date
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
      WINDOW w AS (PARTITION BY symbol ORDER BY date)),
f AS (SELECT * FROM r WHERE ret_actual IS NOT NULL AND ret_prediction IS NOT NULL)""") + """
SELECT symbol, date, round(actual, 6) AS actual, round(prediction, 6) AS prediction,
  round(ret_actual, 6) AS ret_actual, round(ret_prediction, 6) AS ret_prediction,
  round(product(1 + ret_actual) OVER c, 6) AS cum_actual,
  round(product(1 + ret_prediction) OVER c, 6) AS cum_prediction
FROM f WINDOW c AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    q["rolling_sentiment"] = with_(*base, DAILY_OF.format(name="daily", src="scored"), MAPPED, """
j AS (SELECT b.*, m.avg_sentiment FROM bars b LEFT JOIN mapped m ON b.date = m.date AND b.symbol = m.symbol)""") + """
SELECT symbol, date, round(avg_sentiment, 6) AS avg_sentiment,
  round(avg(avg_sentiment) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6)
    AS rolling_sentiment FROM j"""
    q["limit_per_term"] = with_(*base) + """
SELECT company, id, timestamp, rank_in_key FROM (
  SELECT company, id, timestamp, row_number() OVER (PARTITION BY company ORDER BY timestamp, id) AS rank_in_key
  FROM scored) WHERE rank_in_key <= 25"""
    fit = with_(EV, BARS, SPLIT.format(val_end=VAL_END),
                f"fit AS (SELECT {fit_cols} FROM split WHERE split = 'train')")
    scaled = ", ".join(
        f"CASE WHEN fit.max_{c} - fit.min_{c} = 0 THEN -1.0::DOUBLE ELSE "
        f"(s.{c} - fit.min_{c}) / (fit.max_{c} - fit.min_{c}) * 2.0 + -1.0 END AS {c}" for c in feats)
    q["minmax_scale"] = fit + f"""
SELECT symbol, date, split, {', '.join(f'round({c}, 6) AS {c}' for c in feats)}
FROM (SELECT s.symbol, s.date, s.split, {scaled} FROM split s, fit)"""
    inv = ", ".join(f"({c} - -1.0) / 2.0 * (max_{c} - min_{c}) + min_{c} AS {c}" for c in feats)
    q["minmax_inverse"] = fit + f"""
SELECT symbol, date, {', '.join(f'round({c}, 6) AS {c}' for c in feats)} FROM (
  SELECT symbol, date, {inv} FROM (SELECT s.symbol, s.date, {scaled}, fit.* FROM split s, fit))"""
    return q


def stream_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    b = batch_sql()
    q["stream_json_source"] = b["json_decode"]
    q["topic_counts"] = b["row_counts"]
    q["envelope_sink"] = b["envelope_all"]
    q["offset_ledger"] = with_(EV, MESSAGES, """
m AS (SELECT topic, partition::BIGINT AS partition, "offset" AS o FROM messages
      WHERE "offset" // 50 % 2 = 0 OR "offset" % 1000 < 900 OR "offset" % 3 = 0),
r AS (SELECT *, o - row_number() OVER (PARTITION BY topic, partition ORDER BY o) AS run FROM m),
n AS (SELECT topic, partition, count(*) AS n_stored FROM m GROUP BY ALL)""") + """
SELECT topic, partition, min(o) AS lo, max(o) AS hi, n_stored FROM r JOIN n USING (topic, partition)
GROUP BY topic, partition, run, n_stored"""
    q["stream_daily_sentiment"] = b["daily_sentiment"]
    valid = "event_id % 101 <> 0 AND event_id % 97 <> 0"
    q["stream_scored"] = with_(EV) + f"""
SELECT CAST(event_id AS VARCHAR) AS id, comp AS company,
  CASE WHEN event_id % 7 = 0 THEN '' ELSE iso END AS timestamp, txt AS text,
  event_id % 7 AS replyCount, event_id % 11 AS likeCount, event_id % 3 AS quoteCount,
  event_id % 5 AS repostCount, {kw_label('txt')} AS sentiment
FROM ev WHERE topic = 'twitter_raw' AND {valid}"""
    q["stream_restart"] = with_(EV, MESSAGES) + \
        '\nSELECT topic, partition, "offset" AS offset FROM messages'
    q["index_sink"] = with_(EV) + f"""
SELECT event_id AS offset, CAST(event_id AS VARCHAR) AS id, comp AS company, txt AS text,
  label AS sentiment_label, round(score, 6) AS sentiment_score, iso AS timestamp
FROM ev WHERE topic = 'sentiment_scored' AND {valid}"""
    upd = f"doc_type IN {RAW} AND sentiment_score IS NULL AND text IS NOT NULL"
    q["incremental_scoring"] = env_query(f"""
SELECT source_topic, kafka_partition, kafka_offset, text, {kw_label('text')} AS sentiment_label,
  round({polarity(kw_label('text'))}, 6) AS sentiment_score, '{K.AS_OF}' AS processed_at
FROM env WHERE {upd}""")
    q["scoring_loop"] = b["apply_scores"]
    q["scoring_polls"] = env_query(f"""
SELECT CASE WHEN kafka_offset % 10 = 0 THEN 1 ELSE 0 END::BIGINT AS poll, count(*) AS n_scored, 0::BIGINT AS n_failed
FROM env WHERE {upd} GROUP BY 1""")
    q["redrive"] = with_(EV, MESSAGES) + f"""
SELECT topic AS source_topic, "offset" AS kafka_offset,
  CASE topic WHEN 'twitter_raw' THEN 'twitter_raw' WHEN 'prices_raw' THEN 'price' ELSE 'dead_letter' END AS doc_type,
  CASE topic WHEN 'twitter_raw' THEN 'u1' WHEN 'prices_raw' THEN 'U1' END AS symbol,
  CASE WHEN topic IN ('twitter_raw', 'prices_raw') THEN '2024-01-09' ELSE '{K.AS_OF}' END AS timestamp,
  CASE WHEN topic NOT IN ('twitter_raw', 'prices_raw') THEN 2::BIGINT END AS attempts
FROM messages WHERE NOT json_valid(value)"""
    q["dead_letter"] = with_(EV, MESSAGES) + """
SELECT topic AS source_topic, "offset" AS kafka_offset, value AS payload
FROM messages WHERE NOT json_valid(value)"""
    return q


def ml_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    feats = ["open", "high", "low", "close", "volume", "target_price"]
    fit_cols = ", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in feats)
    scaled = ", ".join(
        f"CASE WHEN fit.max_{c} - fit.min_{c} = 0 THEN -1.0::DOUBLE ELSE "
        f"(s.{c} - fit.min_{c}) / (fit.max_{c} - fit.min_{c}) * 2.0 + -1.0 END AS {c}" for c in feats)
    L = K.SEQUENCE_LENGTH
    q["sequence_dataset"] = with_(EV, BARS, """
t0 AS (SELECT * FROM (SELECT *, lead(open) OVER (PARTITION BY symbol ORDER BY date) AS target_price
                      FROM bars) WHERE target_price IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (ORDER BY date, symbol) AS row_id,
                    count(*) OVER () AS n_rows FROM t0),
split AS (SELECT *, CASE WHEN row_id <= floor(0.7::DOUBLE * n_rows) THEN 'train'
                         WHEN row_id <= floor(0.85::DOUBLE * n_rows) THEN 'val' ELSE 'test' END AS split
          FROM numbered)""", f"fit AS (SELECT {fit_cols} FROM split WHERE split = 'train')",
                                 f"sc AS (SELECT s.split, s.symbol, s.date, {scaled} FROM split s, fit)",
                                 f"""
w AS (SELECT *, row_number() OVER (PARTITION BY split, symbol ORDER BY date) AS rn,
             count(*) OVER (PARTITION BY split, symbol) AS n,
             sum(close) OVER (PARTITION BY split, symbol ORDER BY date
                              ROWS BETWEEN {L - 1} PRECEDING AND CURRENT ROW) AS sum_close,
             first_value(volume) OVER (PARTITION BY split, symbol ORDER BY date
                              ROWS BETWEEN {L - 1} PRECEDING AND CURRENT ROW) AS first_volume
      FROM sc)""") + f"""
SELECT split, symbol, rn - {L} AS idx, round(sum_close, 6) AS sum_close,
  round(first_volume, 6) AS first_volume, round(target_price, 6) AS y
FROM w WHERE rn >= {L} AND rn <= n - 1"""
    q["batch_score"] = f"""
SELECT doc_id, {kw_label('text', ('hate',), ('great',))} AS sentiment_label,
  round({polarity(kw_label('text', ('hate',), ('great',)))}, 6) AS sentiment_score FROM documents"""
    q["per_symbol_apply"] = with_(EV, BARS) + """
SELECT symbol, substr(date, 1, 7) AS month, count(*) AS n_rows, round(avg(close), 6) AS mean_close,
  round(arg_max(close, date), 6) AS last_close FROM bars GROUP BY 1, 2"""
    q["per_symbol_stream"] = with_(EV, BARS, """
p AS (SELECT *, max(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak
      FROM bars)""") + """
SELECT symbol, count(*) AS n_rows, round(max(peak - close), 6) AS largest_fall FROM p GROUP BY symbol"""
    from tidemark.plans.ml_queries import PREDICT_LENGTH as N
    from tidemark.plans.queries import BAR_FEATURES as X
    terms = " + ".join(f"(({{0}} * 7 + {3 * j}) % 11 - 5) / 100.0::DOUBLE * ((v.{c} - f.min_{c}) / (f.max_{c} - f.min_{c}) * 2 - 1)".format(f"({N} - r)")
                       for j, c in enumerate(X))
    fits = ", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in X)
    gap = "CASE WHEN date >= '2024-01-28' AND symbol LIKE '%7' THEN NULL ELSE close END AS close"
    q["predict_sequence"] = with_(EV, BARS, f"""
f AS (SELECT {fits} FROM bars WHERE date < '2024-01-25'),
v AS (SELECT symbol, date, open, high, low, {gap}, volume,
             row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS r FROM bars),
s AS (SELECT symbol, max(date) AS last_date, count(*) AS n_rows, sum({terms}) + 0.01 AS y,
             bool_or(open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL) AS gap
      FROM v, f WHERE r <= {N} GROUP BY symbol),
w AS (SELECT DISTINCT symbol FROM bars UNION ALL SELECT 'NONE'),
t AS (SELECT w.symbol, last_date, coalesce(n_rows, 0)::BIGINT AS n_rows, y,
             CASE WHEN n_rows IS NULL THEN 'unknown' WHEN n_rows < {N} THEN 'too_short' WHEN gap THEN 'incomplete' ELSE 'ok' END AS status
      FROM w LEFT JOIN s ON w.symbol = s.symbol)""") + """
SELECT symbol, last_date, n_rows, status,
  CASE WHEN status = 'ok' THEN round((y + 1) / 2 * (f.max_open - f.min_open) + f.min_open, 6) END AS prediction FROM t, f"""
    q["rebuild_table"] = with_(EV, BARS) + f"\nSELECT symbol, date, {BAR_ROUND} FROM bars"
    return q


def long_series_sql() -> str:
    return """
WITH ls AS (
  SELECT 'P' || CAST(l_partkey % 50 AS VARCHAR) AS symbol, strftime(l_shipdate, '%Y-%m-%d') AS date,
         l_extendedprice AS close, l_orderkey, l_linenumber FROM lineitem),
p AS (SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date, l_orderkey, l_linenumber, close
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM ls)
SELECT symbol, date, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round(close, 6) AS close,
  round(c / nullif(lag(c) OVER w, 0) - 1, 6) AS ret, row_number() OVER w AS rn,
  round(avg(close) OVER (PARTITION BY symbol ORDER BY date, l_orderkey, l_linenumber, close
        ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS close_mean_5
FROM p WINDOW w AS (PARTITION BY symbol ORDER BY date, l_orderkey, l_linenumber, close)"""


def json_value_sql() -> str:
    """``to_json`` leaves NULL fields out; the template text (and with it the
    label) is NULL on every 50th event."""
    label = kw_label("txt")
    full = f"json_object('id', CAST(event_id AS VARCHAR), 'company', comp, 'timestamp', iso, 'text', txt, 'sentiment', {label})"
    short = "json_object('id', CAST(event_id AS VARCHAR), 'company', comp, 'timestamp', iso)"
    return with_(EV) + f"""
SELECT CASE WHEN txt IS NULL THEN {short} ELSE {full} END::VARCHAR AS value
FROM ev WHERE event_type IN ('error','purchase','signup')"""
