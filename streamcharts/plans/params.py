"""Parameters of the registered queries.

The test events are sparse (about 10k events over 43k minutes at sf0.01), so
trending reads use a fixed anchor at the end of the data and a one-day trailing
window instead of the service's ten minutes; operator defaults are unchanged.
"""

# Key of the user pseudonym in the registered queries. Jobs must be given a secret of their own.
SALT = "streamcharts-test-key"
ASOF = "2024-01-30 23:59:00"
WINDOW_MINUTES = 1440
SEARCH_TEXT = "red"
SEARCH_GENRE = "SMALL"
SONG_ID = 42
SLIDING_WINDOW = "10 days"
SLIDING_SLIDE = "1 day"
ATTEMPT_WINDOW = "1 day"
# Batches simulated for the merge checks: events are dealt round-robin by id.
MERGE_BATCHES = 3
HISTOGRAM_GRAIN = "1 hour"
RUN_GRAIN = "1 day"
UPSTREAM_REPLICAS = 3
# Micro-batches that the registered streaming queries aim at, and where the log is cut into weeks.
STREAM_BATCHES = 3
STREAM_CUTS = ("2024-01-08", "2024-01-15", "2024-01-23")
# The counters are sparse in the test data; the dashboard's own window is a minute.
RATE_WINDOW_SECONDS = 3600
# Three standard errors of a sketch with 2 ** 12 registers, as the rollups keep them.
SKETCH_ERROR = 0.05
# Windows of the tree reads: anchor and minutes.
TREE_WINDOWS = (("2024-01-30 23:59:00", 10), ("2024-01-30 23:59:00", 1440), ("2024-01-17 13:37:00", 10_000), ("2024-01-28 06:10:00", 30_011))
# Segments of a level that the registered queries merge, so that a few epochs reach higher levels.
MERGE_FAN = 2
# Windows that open at a client's first attempt, and the attempts that they admit.
ATTEMPT_SECONDS = 86_400
ATTEMPT_LIMIT = 2
# A heartbeat that ends all windows of the test data.
HEARTBEAT = "2025-01-01"
# Steps of the panels over stored samples, and the range of their rates.
PANEL_START, PANEL_END, PANEL_STEP_SECONDS, PANEL_RANGE_SECONDS = "2024-01-01 00:00:00", "2024-01-30 23:00:00", 1_800, 7_200
# Patterns beside the titles' own words: wildcards, short ones, one that nothing matches.
SEARCH_PATTERNS = ("r_d", "re%en", "e", "%", "__", "zzz", "AN", "a\\\\b", " b", "plier#0000000")
# When the catalog's change feed had the first rows.
CATALOG_FROM = "2023-12-31"
# Minutes before the anchor at which the leaderboard's three writes come: the first two are a session, so are the last two.
BOARD_AGES = (50, 35, 10)
