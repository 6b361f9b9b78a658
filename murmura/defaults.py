"""Default settings of the analysis."""

# Topics searched for, and the polarity lexicon.
TOPICS = ["nifty50", "sensex", "intraday", "banknifty"]

BULLISH = [
    "bullish", "breakout", "upside", "rally", "surge", "long", "buy", "accumulation", "support",
    "strong", "moon", "green", "profit", "target", "bounce", "recovery", "higher", "strength",
]

BEARISH = [
    "bearish", "breakdown", "downside", "crash", "fall", "short", "sell", "distribution",
    "resistance", "weak", "dump", "red", "loss", "stoploss", "sl", "panic", "lower", "weakness",
    "correction",
]

# Tuning constants.
MIXED_TOPIC = "mixed"
EMPTY_TAG = "unknown"
TARGET_POSTS = 2000
LOOKBACK_HOURS = (24, 36, 48, 72)
NGRAM_RANGE = (1, 2)
MAX_FEATURES = 5000
MIN_DF = 2
MAX_DF = 0.9
BUCKET = "1 hour"
BOOTSTRAP_SAMPLES = 400
CONFIDENCE = 0.95
PLOT_SAMPLE = 1500
SEED = 42
HISTOGRAM_BINS = 40
SAMPLE_ROWS = 100
LEXICON_SHARE = 0.7
TEXT_SHARE = 0.3
