"""Fixed values that must equal the reference's for matching results.

Fixed values (kept verbatim, in natural order):
  topics: twitter "twitter_raw", reddit "reddit_raw", news "news_raw",
          prices "prices_raw", scored stream "sentiment_scored"
  raw text types that still need scoring: "twitter_raw", "reddit_raw", "news_raw"
  sentiment labels: "POSITIVE", "NEGATIVE", "NEUTRAL"
  keyword scorer: "tumble", "trouble" -> NEGATIVE (checked first);
                  "record", "moon"   -> POSITIVE
  company map of the feature job: microsoft -> MSFT
  GBT settings: maxIter 100, maxDepth 5, stepSize 0.05, seed 42
  feature columns: open, high, low, close, volume, avg_sentiment
  split fractions: 0.7 train, 0.85 (or 0.7 + 0.15) validation end
"""

TOPIC_TWITTER = "twitter_raw"
TOPIC_REDDIT = "reddit_raw"
TOPIC_NEWS = "news_raw"
TOPIC_PRICES = "prices_raw"
TOPIC_SCORED = "sentiment_scored"

RAW_TEXT_TYPES = (TOPIC_TWITTER, TOPIC_REDDIT, TOPIC_NEWS)
LABELS = ("POSITIVE", "NEGATIVE", "NEUTRAL")

NEGATIVE_WORDS = ("tumble", "trouble")
POSITIVE_WORDS = ("record", "moon")

COMPANY_MAP = {"microsoft": "MSFT"}

GBT_PARAMS = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.05, "seed": 42}
FEATURES = ("open", "high", "low", "close", "volume", "avg_sentiment")
TRAINING_COLUMNS = ("date", "symbol", "open", "high", "low", "close", "volume", "avg_sentiment")

TRAIN_FRACTION = 0.7
VAL_END_FRACTION = 0.85
VAL_FRACTION = 0.15

# Parameters of the driver-table bindings (not reference values).
AS_OF = "2024-01-31T00:00:00"
LOOKBACK_DAYS = 15
SEQUENCE_LENGTH = 5
