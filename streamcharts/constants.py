"""Fixed values.

These must stay as they are for results to line up with the service behaviour
being reproduced (limits, TTLs, histogram bounds, role ranks, validation
pattern). They are configuration, not logic.
"""

# --- fixed values: leaderboard / trending -------------------------------
TREND_TTL_SECONDS = 1800          # minute buckets expire 30 min after last write
TRENDING_WINDOW_MINUTES = 10      # "trending now" = current minute + 9 before
TRENDING_DEFAULT_LIMIT = 10
TRENDING_MAX_LIMIT = 50
FOR_YOU_LIMIT = 10

# --- fixed values: catalog ----------------------------------------------
CATALOG_DEFAULT_LIMIT = 100
CATALOG_MAX_LIMIT = 200

# --- fixed values: event types and roles --------------------------------
EVENT_TYPES = ("play", "skip", "like")
ROLE_RANK = {"free": 1, "premium": 2, "admin": 3}
ROLES = ("free", "premium", "admin")
ANON_USER = "anon"
GLOBAL_TRENDING = "global-trending"
ALL_GENRES = "all"

# --- fixed values: registration -----------------------------------------
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
MIN_PASSWORD_LENGTH = 8

# --- fixed values: request metrics --------------------------------------
LATENCY_BUCKETS_SECONDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0)
RATE_WINDOW_SECONDS = 60
RATE_LIMIT_WINDOW_SECONDS = 60
RATE_LIMIT_MAX_ATTEMPTS = 20

# --- fixed values: load-test thresholds (name, metric, op, bound) -------
SLO_THRESHOLDS = (
    ("load", "p95_ms", "<", 500.0),
    ("load", "error_rate", "<", 0.01),
    ("scalability", "p95_ms", "<", 800.0),
    ("scalability", "p99_ms", "<", 1500.0),
    ("stress", "error_rate", "<", 0.25),
)
