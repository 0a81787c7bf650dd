"""Results depend on these exact texts, numbers and dates."""

# Text literals that stand for a missing value in the JSON input.
NULL_LITERALS = ["\\n", "null", ""]

# Characters after which a title-cased word starts anew (besides white space).
WORD_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|(){}<>"

# Placeholders written by the cleaning rules.
UNKNOWN = "Unknown"
NONE = "None"
NOT_AVAILABLE = "NA"
MISSING_NUMBER = -1
MISSING_DATE = "1900-01-01"

# Quality status and scores per layer.
VALID = "VALID"
INVALID = "INVALID"
SCORE_VALID = 1.0
SCORE_BRONZE_INVALID = 0.0
SCORE_SILVER_INVALID = 0.5
SCORE_GATE_INVALID = 0.3
NULL_SHARE_BRONZE = 0.05
NULL_SHARE_SILVER = 0.01

# Constant audit column of the bronze tables.
SOURCE_SYSTEM = "CRICKET_JSON"

# Constants of the star-schema match fact.
REFEREE_ID = 0
TOTAL_OVERS = 50
BALLS_PER_OVER = 6

# Date range of the seeded calendar.
CALENDAR_START = "2023-10-12"
CALENDAR_END = "2023-12-31"

# Freshness classes (minutes) and their labels.
FRESH_MINUTES = 15
STALE_MINUTES = 30
FRESHNESS_LABELS = ("Green (Fresh)", "Yellow (Stale)", "Red (Delayed)")

# Marks of the run and latency reports.
RUN_MARKS = ("✓", "✗")
SLA_LABELS = ("✓ SLA Met", "✗ SLA Miss")

# Alert thresholds: task seconds, lag as a multiple of the target, failed runs, invalid percent, row drop percent.
ALERT_THRESHOLDS = {
    "task_duration_seconds": 300.0,
    "lag_over_target": 2.0,
    "failed_runs": 0.0,
    "invalid_pct": 5.0,
    "row_drop_pct": 10.0,
}

# Table layouts: the columns each table is clustered by when written.
CLUSTER_KEYS = {
    "bronze_player": ["match_type_number", "ingestion_ts"],
    "bronze_delivery": ["match_type_number", "team_name", "over"],
    "bronze_match": ["match_type_number", "event_date"],
    "silver_player": ["match_type_number", "country"],
    "silver_delivery": ["match_type_number", "team_name", "over"],
    "silver_match": ["match_type_number", "event_date"],
    "gold_player_dim": ["country", "match_type_number"],
    "gold_delivery_fact": ["match_type_number", "team_name", "over"],
    "gold_match_dim": ["event_date", "match_type_number"],
    "player_performance": ["player_name", "country"],
    "match_summary": ["event_date"],
}
