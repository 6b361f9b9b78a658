"""Table layouts, as DDL strings that every reader takes directly."""

# A captured page element, before any field is parsed.
CAPTURE = """permalink string, datetime string, user_block string, content string,
    reply_label string, retweet_label string, like_label string, views_label string,
    query_tag string, scraped_at string"""

# JSON lines are read loosely: numbers may be quoted and a list may be a bare string, so every
# field arrives as text and is cast by `clean_rows`.
RAW_TEXT = """tweet_id string, username string, timestamp string, content string,
    replies string, retweets string, likes string, views string,
    mentions string, hashtags string, query_tag string, permalink string, scraped_at string"""

# The numbers of a post.
COUNTS = ["replies", "retweets", "likes", "views"]

CLEAN_COLUMNS = [
    "tweet_id", "username", "timestamp", "content", "content_norm", "replies", "retweets", "likes",
    "views", "mentions", "hashtags", "query_tag", "permalink", "scraped_at", "content_hash",
    "engagement",
]

AGG_COLUMNS = [
    "bucket_start", "tweet_count", "signal_mean", "ci_low", "ci_high", "mean_engagement",
    "mean_likes",
]
