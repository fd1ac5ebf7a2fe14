"""Declared schemas: stored datasets and landed API payloads. Never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, B, D, TS = T.StringType(), T.LongType(), T.BooleanType(), T.DoubleType(), T.TimestampNTZType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The column lists of the stored datasets, in their order. captured_at (when a
# page was fetched) and published_ts (published_at as a timestamp) are additions.

# --- stored datasets ------------------------------------------------------------------

TRENDS = _struct(("query", S), ("start_date", TS), ("end_date", TS), ("active", B),
                 ("search_volume", L), ("increase_percentage", L), ("categories", S),
                 ("trend_breakdown", S), ("captured_at", TS))

JOBS = _struct(("title", S), ("company_name", S), ("location", S), ("via", S), ("description", S),
               ("job_highlights", S), ("extensions", S), ("detected_extensions", S),
               ("apply_options", S), ("job_id", S), ("scraped_at", TS))

POSTS = _struct(("genre", S), ("title", S), ("flair", S), ("score", L), ("id", S), ("subreddit", S),
                ("url", S), ("num_comments", L), ("body", S), ("upvote_ratio", D), ("awards", L),
                ("author", S), ("over_18", B), ("spoiler", B), ("is_self", B), ("created", TS),
                ("today_date", TS), ("subscribers", L), ("engagement_rate", D),
                ("engagement_intensity", D))

POPULAR = _struct(("country_code", S), ("country_name", S), ("region", S), ("video_id", S),
                  ("title", S), ("description", S), ("channel_title", S), ("category_id", S),
                  ("category_name", S), ("published_at", S), ("tags", S), ("duration", S),
                  ("duration_secs", L), ("view_count", L), ("like_count", L), ("comment_count", L),
                  ("published_ts", TS), ("captured_at", TS))

KEYWORD_VIDEOS = _struct(("keyword", S), ("video_id", S), ("title", S), ("channel_title", S),
                         ("category_name", S), ("published_at", S), ("duration", S),
                         ("duration_secs", L), ("tags", S), ("view_count", L), ("like_count", L),
                         ("comment_count", L), ("region_code", S), ("published_ts", TS), ("captured_at", TS))

DATASETS = {"trends": TRENDS, "jobs": JOBS, "posts": POSTS, "popular": POPULAR,
            "keyword_videos": KEYWORD_VIDEOS}

# --- landed payloads (one JSON document per line) -------------------------------------
# Nested parts that are stored as JSON text are declared as STRING: the JSON reader
# then keeps their raw text, whatever shape they have. A page carries the epoch second
# it was fetched at; pages without one sort as the oldest.

TREND_ITEM = _struct(
    ("query", S), ("start_timestamp", S), ("end_timestamp", S), ("active", B),
    ("search_volume", L), ("increase_percentage", L),
    ("categories", T.ArrayType(_struct(("id", T.IntegerType()), ("name", S)))),
    ("trend_breakdown", T.ArrayType(S)),
    ("serpapi_google_trends_link", S), ("serpapi_news_link", S))
TRENDS_PAYLOAD = _struct(("captured_at", L), ("trending_searches", T.ArrayType(TREND_ITEM)))

JOB_ITEM = _struct(("title", S), ("company_name", S), ("location", S), ("via", S), ("description", S),
                   ("job_highlights", S), ("extensions", S), ("detected_extensions", S),
                   ("apply_options", S), ("job_id", S))
# A job stays JSON text in its page: the kind of a nested part is told from its value, not from its text.
JOBS_PAYLOAD = _struct(("jobs_results", T.ArrayType(S)))

POST_ITEM = _struct(("title", S), ("link_flair_text", S), ("score", L), ("id", S), ("subreddit", S),
                    ("url", S), ("num_comments", L), ("selftext", S), ("upvote_ratio", D),
                    ("total_awards_received", L), ("author", S), ("over_18", B), ("spoiler", B),
                    ("is_self", B), ("created", D))
POSTS_PAYLOAD = _struct(("subreddit", S), ("genre", S), ("posts", T.ArrayType(POST_ITEM)))



def _video_item(*snippet) -> T.StructType:
    return _struct(
        ("id", S),
        ("snippet", _struct(("title", S), *snippet, ("channelTitle", S), ("categoryId", S),
                            ("publishedAt", S), ("tags", T.ArrayType(S)))),
        ("statistics", _struct(("viewCount", S), ("likeCount", S), ("commentCount", S))),
        ("contentDetails", _struct(("duration", S))))


VIDEO_ITEM = _video_item(("description", S))
VIDEOS_PAYLOAD = _struct(("region_code", S), ("captured_at", L), ("items", T.ArrayType(VIDEO_ITEM)))
# Details for keyword videos, whose rows have no description: it is not even parsed.
DETAILS_PAYLOAD = _struct(("region_code", S), ("captured_at", L), ("items", T.ArrayType(_video_item())))

SEARCH_ITEM = _struct(("id", _struct(("kind", S), ("videoId", S))))
SEARCH_PAYLOAD = _struct(("keyword", S), ("items", T.ArrayType(SEARCH_ITEM)))
