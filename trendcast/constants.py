"""Fixed values that must equal the behaviour being reproduced.

Everything here is a documented business rule: label texts, thresholds,
time zone, dataset keys and rollover grace periods. Keep them together and in
their natural order; the column functions read them from here.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES — do not edit without changing the expected results.
# ---------------------------------------------------------------------------

# Local time zone of the audience (East Africa Time, UTC+3, no DST).
LOCAL_TZ = "Africa/Nairobi"
LOCAL_UTC_OFFSET_HOURS = 3

# Recommendation score weights.
SCORE_VOLUME_WEIGHT = 0.5
SCORE_INCREASE_WEIGHT = 8
SCORE_ACTIVE_BONUS = 4000
SCORE_EARLY_BONUS = 3000          # duration <= 6 h
SCORE_EARLY_MAX_HRS = 6
SCORE_WINDOW_BONUS = 1500         # 2 h <= duration <= 12 h
SCORE_WINDOW_HRS = (2, 12)

# Content window: (max duration hours, label) for active trends, first match wins.
CONTENT_WINDOWS = [
    (3, "Act Now — Just Started"),
    (12, "Still Hot — Publish Today"),
    (24, "Fading — Quick Content Only"),
]
CONTENT_WINDOW_ACTIVE_REST = "Long Tail — Deep Content OK"
CONTENT_WINDOW_ENDED = "Ended — Historical Reference"

# Urgency tier: (min search volume, label) for active trends, first match wins.
URGENCY_TIERS = [
    (10000, "Viral"),
    (2000, "Hot"),
    (500, "Rising"),
]
URGENCY_ACTIVE_REST = "Active"
URGENCY_ENDED = "Ended"

# Time of day by local start hour (inclusive ranges); anything else is Night.
TIME_OF_DAY = [
    (5, 11, "Morning"),
    (12, 16, "Afternoon"),
    (17, 20, "Evening"),
]
TIME_OF_DAY_REST = "Night"
TIMES_OF_DAY = ["Morning", "Afternoon", "Evening", "Night"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Recurrence label.
RECUR_SERIES = (10, 30, "Series Material — Trends Regularly")   # times, span days
RECUR_RECURRING = (5, "Recurring — Worth Scheduling")
RECUR_TWICE = (2, "Appeared Twice — Keep Watching")
RECUR_ONE_OFF = "One-Off — Reactive Content Only"

# Scheduling tip text parts.
TIP_PREFIX = "Best time: "
TIP_JOIN = " on "

# Gap opportunity: (exclusive lower bound on gap_score, label), first match wins.
OPPORTUNITY = [
    (50, "Strong Gap"),
    (10, "Good Opportunity"),
    (1, "Competitive"),
]
OPPORTUNITY_REST = "Saturated"

# Allowed values of increase_percentage.
INCREASE_LADDER = [50, 75, 100, 200, 500, 1000, 2000, 5000, 10000, 20000, 50000]

# Lookup default.
UNKNOWN = "Unknown"

# Watchable video filter.
MIN_DURATION_SECS = 60
MIN_VIEWS = 1

# Rollover grace days per dataset.
GRACE_DAYS = {"trends": 2, "jobs": 3, "posts": 1, "popular": 2, "keyword_videos": 7}

# Dataset keys.
KEYS = {
    "trends": ["query", "start_date"],
    "jobs": ["title", "description", "company_name", "via"],
    "posts": ["id"],
    "popular": ["video_id", "country_code", "country_name", "region"],
    "keyword_videos": ["keyword", "video_id", "region_code"],
}
ROLLOVER_MATCH_KEYS = ["video_id", "published_at"]

# Snapshot lifetime in days.
SNAPSHOT_RETENTION_DAYS = 60

# Trailing rows in the keyword-count comparison and keyword selection window.
TRAILING_ROWS = 7
KEYWORD_WINDOW_HOURS = 24

# Top-n card size per category.
TOP_PER_CATEGORY = 5

# Data-quality not-null rules: model -> columns.
NOT_NULL_RULES = {
    "stg_trending_now": ["query", "start_date", "active", "search_volume", "increase_percentage"],
    "mart_trending_topics": ["query", "recommendation_score"],
    "mart_category_pulse": ["categories", "trend_date"],
    "mart_keyword_recurrence": ["query"],
}
