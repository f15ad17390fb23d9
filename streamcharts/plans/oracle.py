"""Independent DuckDB SQL for the registered queries (the correctness oracle).

Written straight from the table mapping in ``sources.tables``; it shares no
code with the Spark plans, only their fixed values and query parameters.
"""

from __future__ import annotations

from streamcharts.constants import LATENCY_BUCKETS_SECONDS, SLO_THRESHOLDS
from streamcharts.plans import params as P

# HMAC-SHA256 by its definition, for a key of at most 64 bytes.
_KEY = P.SALT.encode().ljust(64, b"\0")
_INNER, _OUTER = (bytes(x ^ pad for x in _KEY).hex() for pad in (0x36, 0x5C))


def pseudonym_sql(user: str) -> str:
    inner = f"unhex(sha256(unhex('{_INNER}') || encode(CAST({user} AS VARCHAR))))"
    return f"coalesce(sha256(unhex('{_OUTER}') || {inner}), 'anon')"


ASOF = f"TIMESTAMP '{P.ASOF}'"
WIN_LO = f"(date_trunc('minute', {ASOF}) - INTERVAL {P.WINDOW_MINUTES - 1} MINUTE)"
WIN_HI = f"date_trunc('minute', {ASOF})"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SONGS = """songs AS (
  SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS title, CAST(p_partkey % 10 AS BIGINT) AS artist_id,
         p_type AS genre, CAST(120 + p_size AS INTEGER) AS duration_sec,
         'track-' || CAST(p_partkey AS VARCHAR) || '.wav' AS audio_key,
         'covers/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS cover_url,
         (p_partkey % 4 = 0) AS premium_only
  FROM part)"""

ARTISTS = """artists AS (
  SELECT CAST(s.s_suppkey AS BIGINT) AS id, s.s_name AS name, g.genre
  FROM supplier s LEFT JOIN (SELECT artist_id, min(genre) AS genre FROM songs GROUP BY artist_id) g
    ON g.artist_id = s.s_suppkey)"""

USERS = """users AS (
  SELECT CAST(c_custkey AS BIGINT) AS id, lower(c_name) || '@x.io' AS email,
         CASE WHEN c_custkey % 10 = 0 THEN 'admin' WHEN c_custkey % 10 BETWEEN 1 AND 3 THEN 'premium'
              ELSE 'free' END AS role
  FROM customer)"""

EV = """ev AS (
  SELECT event_id,
         CASE event_type WHEN 'view' THEN 'play' WHEN 'click' THEN 'like' WHEN 'error' THEN 'skip'
              ELSE event_type END AS type,
         CAST(user_id AS BIGINT) AS user_id,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS song_id,
         CAST(ts AS TIMESTAMP) AS ts
  FROM events)"""

PLAYS = f"""plays AS (
  SELECT e.event_id, e.song_id, s.genre, {pseudonym_sql('e.user_id')} AS user_hash, e.ts,
         date_trunc('minute', e.ts) AS window_start
  FROM ev e JOIN songs s ON s.id = e.song_id
  WHERE e.type = 'play')"""

BASE = (SONGS, ARTISTS, USERS, EV, PLAYS)

# Ids that the catalog does not know take part until the limit.
WINDOWED = f"""w AS (
  SELECT song_id, CAST(count(*) AS BIGINT) AS plays FROM {{plays}}
  WHERE window_start BETWEEN {WIN_LO} AND {WIN_HI} {{genre_filter}} GROUP BY song_id)"""


ANY_SONG = """anysong AS (
  SELECT song_id, ts, date_trunc('minute', ts) AS window_start FROM ev WHERE type = 'play' AND song_id IS NOT NULL)"""


def _trending(limit: int, genre: str | None = None, plays: str | None = None) -> str:
    gf = f"AND genre = '{genre}'" if genre else ""
    plays = plays or ("plays" if genre else "anysong")
    return _with(*BASE, ANY_SONG, WINDOWED.format(genre_filter=gf, plays=plays), f"""top AS (
  SELECT song_id, plays,
         CAST(row_number() OVER (ORDER BY plays DESC, CAST(song_id AS VARCHAR) DESC) AS INTEGER) AS rank
  FROM w QUALIFY rank <= {limit})""")


ORACLE: dict[str, str] = {}

ORACLE["trending_global"] = _trending(10) + """
SELECT t.song_id AS id, s.title, s.genre, s.cover_url, a.name AS artist, t.plays, t.rank
FROM top t JOIN songs s ON s.id = t.song_id JOIN artists a ON a.id = s.artist_id"""

ORACLE["trending_genre"] = _trending(50, P.SEARCH_GENRE) + """
SELECT t.song_id AS id, s.title, s.genre, s.cover_url, a.name AS artist, t.plays, t.rank
FROM top t JOIN songs s ON s.id = t.song_id JOIN artists a ON a.id = s.artist_id"""

ORACLE["trending_share"] = _trending(50) + """
SELECT t.song_id AS id, t.plays, t.rank,
       round(t.plays / greatest(max(t.plays) OVER (), 1), 6) AS share
FROM top t JOIN songs s ON s.id = t.song_id JOIN artists a ON a.id = s.artist_id"""

PER_GENRE = f"""pg AS (
  SELECT genre, song_id, CAST(count(*) AS BIGINT) AS plays FROM plays
  WHERE window_start BETWEEN {WIN_LO} AND {WIN_HI} GROUP BY genre, song_id),
tg AS (
  SELECT genre, song_id, plays,
         CAST(row_number() OVER (PARTITION BY genre ORDER BY plays DESC, CAST(song_id AS VARCHAR) DESC)
              AS INTEGER) AS rank
  FROM pg QUALIFY rank <= {{limit}})"""

ORACLE["trending_by_genre"] = _with(*BASE, PER_GENRE.format(limit=10)) + """
SELECT t.genre, t.song_id AS id, s.title, s.cover_url, a.name AS artist, t.plays, t.rank
FROM tg t JOIN songs s ON s.id = t.song_id JOIN artists a ON a.id = s.artist_id"""

ORACLE["sliding_trending"] = _with(*BASE) + """
SELECT ws AS window_start, ws + INTERVAL 10 DAY AS window_end, song_id, CAST(count(*) AS BIGINT) AS plays
FROM (SELECT p.song_id, date_trunc('day', p.ts) - to_days(CAST(r.k AS INTEGER)) AS ws
      FROM plays p, range(0, 10) r(k))
GROUP BY ws, song_id"""

AFFINITY = """aff AS (
  SELECT user_hash, genre, CAST(count(*) AS BIGINT) AS play_count, max(ts) AS updated_at
  FROM plays GROUP BY user_hash, genre)"""

FAV = """fav AS (
  SELECT user_hash, genre, play_count FROM aff
  QUALIFY row_number() OVER (PARTITION BY user_hash ORDER BY play_count DESC, genre ASC) = 1)"""

ORACLE["user_genre_affinity"] = _with(*BASE, AFFINITY) + "SELECT user_hash, genre, play_count, updated_at FROM aff"

ORACLE["favourite_genre"] = _with(*BASE, AFFINITY, FAV) + "SELECT user_hash, genre, play_count FROM fav"

ORACLE["for_you_all"] = _with(
    *BASE, AFFINITY, FAV, PER_GENRE.format(limit=10), ANY_SONG, WINDOWED.format(genre_filter="", plays="anysong"),
    """top AS (
  SELECT song_id, plays,
         CAST(row_number() OVER (ORDER BY plays DESC, CAST(song_id AS VARCHAR) DESC) AS INTEGER) AS rank
  FROM w QUALIFY rank <= 10)""",
    """lists AS (
  SELECT genre AS based_on, song_id, rank FROM tg
  UNION ALL SELECT 'global-trending', song_id, rank FROM top)""",
    f"""picked AS (
  SELECT u.id AS user_id, coalesce(f.genre, 'global-trending') AS based_on
  FROM users u LEFT JOIN fav f ON f.user_hash = {pseudonym_sql('u.id')})""",
) + """
SELECT p.user_id, p.based_on, c.rank, c.song_id AS id, c.title, c.genre, c.cover_url, c.artist
FROM picked p LEFT JOIN (
  SELECT l.based_on, l.rank, l.song_id, s.title, s.genre, s.cover_url, a.name AS artist
  FROM lists l JOIN songs s ON s.id = l.song_id JOIN artists a ON a.id = s.artist_id) c
  ON c.based_on = p.based_on"""

MESSAGE_COLS = """SELECT e.*, s.genre, u.role FROM ev e LEFT JOIN songs s ON s.id = e.song_id
  LEFT JOIN users u ON u.id = e.user_id"""

ORACLE["event_messages"] = _with(*BASE, f"m AS ({MESSAGE_COLS})") + """
SELECT CAST(song_id AS VARCHAR) AS key,
       CAST(json_object('type', type, 'userId', CAST(user_id AS VARCHAR), 'songId', CAST(song_id AS VARCHAR),
                        'genre', genre, 'role', role, 'ts', strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')) AS VARCHAR)
         AS value
FROM m"""

ORACLE["decode_events"] = _with(*BASE, f"m AS ({MESSAGE_COLS})") + f"""
SELECT type, CAST(song_id AS VARCHAR) AS "songId", genre, role,
       date_trunc('millisecond', ts) AS ts, date_trunc('minute', ts) AS window_start,
       {pseudonym_sql('user_id')} AS user_hash, song_id,
       CASE WHEN type IS NULL OR type NOT IN ('play', 'skip', 'like') THEN 'unknown_type'
            WHEN song_id IS NULL THEN 'bad_song_id'
            WHEN ts IS NULL THEN 'bad_ts'
            WHEN genre IS NULL THEN 'missing_genre' END AS decode_error
FROM m"""

ORACLE["published_log"] = ORACLE["decode_events"]

ORACLE["page_limits"] = """
WITH a AS (SELECT event_id, CASE WHEN event_id % 7 > 1 THEN value - 20 END AS n FROM events)
SELECT event_id,
       CAST(CASE WHEN coalesce(n, 0) = 0 THEN 10 WHEN n > 0 THEN greatest(1, floor(least(n, 50))) END AS INTEGER) AS trending_limit,
       CAST(CASE WHEN coalesce(n, 0) = 0 THEN 100 WHEN n > 0 THEN greatest(1, floor(least(n, 200))) END AS INTEGER) AS catalog_limit
FROM a"""

ORACLE["pseudonymize"] = _with(EV) + f"""
SELECT event_id, {pseudonym_sql('user_id')} AS user_hash FROM ev"""

ORACLE["events_by_type"] = _with(EV) + "SELECT type, CAST(count(*) AS BIGINT) AS events FROM ev GROUP BY type"

MINUTE_COUNTS = """
SELECT song_id, min(genre) AS genre, window_start, window_start + INTERVAL 1 MINUTE AS window_end,
       CAST(count(*) AS BIGINT) AS play_count
FROM plays GROUP BY song_id, window_start"""

ORACLE["minute_play_counts"] = _with(*BASE) + MINUTE_COUNTS
ORACLE["merge_additive"] = _with(*BASE) + MINUTE_COUNTS

ORACLE["minute_unique_exact"] = _with(*BASE) + """
SELECT song_id, window_start, CAST(count(DISTINCT user_hash) AS BIGINT) AS unique_listeners
FROM plays GROUP BY song_id, window_start"""

for _name in ("minute_unique_approx", "unique_union_sketch"):
    ORACLE[_name] = _with(*BASE) + "SELECT DISTINCT song_id, window_start, true AS within_error FROM plays"

ORACLE["unique_max_merge"] = _with(*BASE) + f"""
SELECT song_id, window_start, CAST(max(u) AS BIGINT) AS unique_listeners
FROM (SELECT song_id, window_start, event_id % {P.MERGE_BATCHES} AS epoch, count(DISTINCT user_hash) AS u
      FROM plays GROUP BY ALL)
GROUP BY song_id, window_start"""

ORACLE["ttl_live_buckets"] = _with(*BASE, """b AS (
  SELECT CAST(floor(epoch(window_start) / 60) AS BIGINT) AS minute, genre, max(ts) AS written_at
  FROM plays GROUP BY ALL)""") + f"""
SELECT * FROM (
  SELECT 'genre' AS scope, genre, minute, max(written_at) + INTERVAL 1800 SECOND AS expires_at
  FROM b GROUP BY minute, genre
  UNION ALL
  SELECT 'global', CAST(NULL AS VARCHAR), minute, max(written_at) + INTERVAL 1800 SECOND
  FROM b GROUP BY minute)
WHERE expires_at > {ASOF}"""

# ------------------------------------------------------------ catalog
CARDS = """cards AS (
  SELECT s.id, s.title, s.genre, s.duration_sec, s.audio_key, s.cover_url, s.premium_only, a.name AS artist
  FROM songs s JOIN artists a ON a.id = s.artist_id)"""

PS = """ps AS (
  SELECT CAST(l_orderkey AS BIGINT) AS playlist_id, CAST(l_partkey AS BIGINT) AS song_id,
         CAST(min(l_linenumber) AS INTEGER) AS position
  FROM lineitem GROUP BY l_orderkey, l_partkey)"""

PL = """pl AS (
  SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_custkey AS BIGINT) AS user_id, o_orderpriority AS name,
         CAST(o_orderdate AS TIMESTAMP) AS created_at
  FROM orders)"""

ORACLE["list_songs"] = _with(SONGS, ARTISTS, CARDS) + "SELECT * FROM cards ORDER BY id LIMIT 100"

ORACLE["search_songs"] = _with(SONGS, ARTISTS, CARDS) + f"""
SELECT * FROM cards WHERE genre = '{P.SEARCH_GENRE}'
  AND (title ILIKE '%{P.SEARCH_TEXT}%' OR artist ILIKE '%{P.SEARCH_TEXT}%')
ORDER BY id LIMIT 200"""

ORACLE["get_song"] = _with(SONGS, ARTISTS, CARDS) + f"SELECT * FROM cards WHERE id = {P.SONG_ID}"

ORACLE["list_artists"] = _with(SONGS, ARTISTS) + "SELECT id, name, genre FROM artists ORDER BY name, id"

ORACLE["genre_counts"] = _with(SONGS) + """
SELECT genre, CAST(count(*) AS INTEGER) AS count FROM songs GROUP BY genre ORDER BY genre"""

ORACLE["duration_text"] = _with(SONGS) + """
SELECT id, duration_sec,
       CAST(duration_sec // 60 AS VARCHAR) || ':' || lpad(CAST(duration_sec % 60 AS VARCHAR), 2, '0')
         AS duration_text
FROM songs"""

RANKED = """ranked AS (
  SELECT playlist_id, song_id,
         CAST(row_number() OVER (PARTITION BY playlist_id ORDER BY position, song_id) AS BIGINT) AS rank
  FROM ps)"""

ORACLE["playlists"] = _with(PS, PL, RANKED) + """
SELECT p.id, p.user_id, p.name, p.created_at, r.rank, r.song_id
FROM pl p LEFT JOIN ranked r ON r.playlist_id = p.id"""

ORACLE["playlist_owner_check"] = _with(EV, PL) + """
SELECT e.event_id, e.user_id, e.event_id AS playlist_id, e.song_id, coalesce(p.user_id = e.user_id, false) AS owned
FROM ev e LEFT JOIN pl p ON p.id = e.event_id
WHERE e.type = 'like'"""

ORACLE["playlist_insert_new"] = _with(EV, PL, PS, """newest AS (
  SELECT user_id, id AS playlist_id FROM pl
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, id DESC) = 1)""", """req AS (
  SELECT DISTINCT n.playlist_id, e.song_id FROM ev e JOIN newest n ON n.user_id = e.user_id
  WHERE e.type = 'like')""") + """
SELECT r.playlist_id, r.song_id, CAST(0 AS INTEGER) AS position FROM req r
WHERE NOT EXISTS (SELECT 1 FROM ps WHERE ps.playlist_id = r.playlist_id AND ps.song_id = r.song_id)"""

ORACLE["playlist_create"] = _with(EV, PL) + """
SELECT CAST((SELECT coalesce(max(id), 0) FROM pl) + row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS id,
       CAST(c_custkey AS BIGINT) AS user_id, 'Liked songs' AS name
FROM customer WHERE c_custkey IN (SELECT user_id FROM ev WHERE type = 'like')"""

NEIGHBOURS = """nb AS (
  SELECT playlist_id, song_id,
         CAST(row_number() OVER w AS INTEGER) AS track_no,
         coalesce(lead(song_id) OVER w, first_value(song_id) OVER w) AS next_song_id
  FROM ps WINDOW w AS (PARTITION BY playlist_id ORDER BY position, song_id))"""

ORACLE["next_track"] = _with(PS, NEIGHBOURS) + "SELECT playlist_id, song_id, next_song_id FROM nb"
ORACLE["numbered_listing"] = _with(PS, NEIGHBOURS) + """
SELECT playlist_id, song_id, track_no, CASE WHEN track_no < 10 THEN '0' ELSE '' END || CAST(track_no AS VARCHAR) AS label FROM nb"""

REGS = """regs AS (
  SELECT 's1-' || CAST(s_suppkey AS VARCHAR) AS request_id, s_suppkey * 2 AS requested_at, lower(s_name) || '@x.io' AS email, s_name AS password
  FROM supplier
  UNION ALL
  SELECT 's2-' || CAST(s_suppkey AS VARCHAR), s_suppkey * 2 + CASE WHEN s_suppkey % 3 = 0 THEN -1 ELSE 1 END, upper(s_name) || '@X.IO', repeat('p', s_nationkey) FROM supplier
  UNION ALL
  SELECT 'c-' || CAST(c_custkey AS VARCHAR), c_custkey, c_name || '@X.io', repeat('p', c_nationkey) FROM customer)"""

ORACLE["register_split"] = _with(USERS, REGS, r"""r AS (
  SELECT request_id, requested_at, lower(email) AS email,
         coalesce(regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$'), false)
           AND coalesce(length(password) >= 8, false) AS valid
  FROM regs)""", """f AS (SELECT email, request_id AS first_id FROM r WHERE valid
      QUALIFY row_number() OVER (PARTITION BY email ORDER BY requested_at, request_id) = 1)""",
    """t AS (SELECT DISTINCT lower(email) AS email FROM users)""") + """
SELECT r.request_id, r.email, o.outcome, CASE WHEN o.outcome = 'accepted' THEN 'free' END AS role
FROM r LEFT JOIN f ON f.email = r.email LEFT JOIN t ON t.email = r.email,
LATERAL (SELECT CASE WHEN NOT r.valid THEN 'invalid'
                     WHEN t.email IS NOT NULL OR r.request_id <> f.first_id THEN 'conflict'
                     ELSE 'accepted' END AS outcome) o"""

ORACLE["role_at_least"] = _with(USERS) + """
SELECT id, role, CAST(CASE role WHEN 'free' THEN 1 WHEN 'premium' THEN 2 WHEN 'admin' THEN 3 END AS INTEGER) AS rank,
       role IN ('free', 'premium', 'admin') AS at_least_free,
       role IN ('premium', 'admin') AS at_least_premium,
       role = 'admin' AS at_least_admin
FROM users"""

ERASE = """er AS (SELECT CAST(c_custkey AS BIGINT) AS id FROM customer WHERE c_acctbal < 0)"""

ORACLE["erase_user_cascade"] = _with(USERS, PL, PS, ERASE) + """
SELECT 'users' AS "table", CAST(count(*) FILTER (WHERE id NOT IN (SELECT id FROM er)) AS BIGINT) AS kept,
       CAST(count(*) FILTER (WHERE id IN (SELECT id FROM er)) AS BIGINT) AS erased FROM users
UNION ALL
SELECT 'playlists', CAST(count(*) FILTER (WHERE user_id NOT IN (SELECT id FROM er)) AS BIGINT),
       CAST(count(*) FILTER (WHERE user_id IN (SELECT id FROM er)) AS BIGINT) FROM pl
UNION ALL
SELECT 'playlist_songs',
       CAST(count(*) FILTER (WHERE playlist_id NOT IN (SELECT id FROM pl WHERE user_id IN (SELECT id FROM er))) AS BIGINT),
       CAST(count(*) FILTER (WHERE playlist_id IN (SELECT id FROM pl WHERE user_id IN (SELECT id FROM er))) AS BIGINT)
FROM ps"""

ORACLE["erase_artist_cascade"] = _with(SONGS, ARTISTS, PS, """ea AS (
  SELECT CAST(s_suppkey AS BIGINT) AS id FROM supplier WHERE s_acctbal < 0)""") + """
SELECT 'artists' AS "table", CAST(count(*) FILTER (WHERE id NOT IN (SELECT id FROM ea)) AS BIGINT) AS kept,
       CAST(count(*) FILTER (WHERE id IN (SELECT id FROM ea)) AS BIGINT) AS erased FROM artists
UNION ALL
SELECT 'songs', CAST(count(*) FILTER (WHERE artist_id NOT IN (SELECT id FROM ea)) AS BIGINT),
       CAST(count(*) FILTER (WHERE artist_id IN (SELECT id FROM ea)) AS BIGINT) FROM songs
UNION ALL
SELECT 'playlist_songs',
       CAST(count(*) FILTER (WHERE song_id NOT IN (SELECT id FROM songs WHERE artist_id IN (SELECT id FROM ea))) AS BIGINT),
       CAST(count(*) FILTER (WHERE song_id IN (SELECT id FROM songs WHERE artist_id IN (SELECT id FROM ea))) AS BIGINT)
FROM ps"""

ORACLE["export_user"] = _with(USERS, PL, PS, ERASE, RANKED) + """
SELECT u.id AS user_id, p.id AS playlist_id, r.rank,
       CAST(json_object('user_id', u.id, 'email', u.email, 'role', u.role, 'playlist_id', p.id,
                        'playlist_name', p.name, 'created', strftime(p.created_at, '%Y-%m-%d'),
                        'rank', r.rank, 'song_id', r.song_id) AS VARCHAR)
         AS document
FROM users u LEFT JOIN pl p ON p.user_id = u.id LEFT JOIN ranked r ON r.playlist_id = p.id
WHERE u.id IN (SELECT id FROM er)"""

ACCEPT = """acc AS (
  SELECT e.event_id, e.type, e.user_id, e.song_id, s.genre, u.role,
         CASE WHEN NOT coalesce(e.song_id > 0, false) THEN 'invalid_song_id'
              WHEN e.type IS NULL OR e.type NOT IN ('play', 'skip', 'like') THEN 'invalid_type'
              WHEN s.id IS NULL THEN 'song_not_found'
              WHEN e.type = 'play' AND s.premium_only AND coalesce(u.role = 'free', false) THEN 'premium_required'
         END AS reject_reason
  FROM ev e LEFT JOIN songs s ON s.id = e.song_id LEFT JOIN users u ON u.id = e.user_id)"""

ORACLE["accept_events"] = _with(SONGS, USERS, EV, ACCEPT) + """
SELECT event_id, type, user_id, song_id, genre, role FROM acc WHERE reject_reason IS NULL"""

ORACLE["reject_reasons"] = _with(SONGS, USERS, EV, ACCEPT) + """
SELECT reject_reason, CAST(count(*) AS BIGINT) AS rejected FROM acc WHERE reject_reason IS NOT NULL
GROUP BY reject_reason"""

ORACLE["find_users"] = _with(USERS, REGS) + """
SELECT id, email, role FROM users WHERE lower(email) IN (SELECT lower(email) FROM regs)"""

ORACLE["trending_labels"] = _trending(10, P.SEARCH_GENRE) + f"""
SELECT t.song_id AS id, t.plays, t.rank, CAST({P.WINDOW_MINUTES} AS INTEGER) AS window_minutes, '{P.SEARCH_GENRE}' AS requested_genre
FROM top t JOIN songs s ON s.id = t.song_id JOIN artists a ON a.id = s.artist_id"""

# ------------------------------------------------------- observability

REQ = """req AS (
  SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, 'svc-' || CAST(user_id % 5 AS VARCHAR) AS service,
         'GET' AS method, event_type AS route,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
         value / CAST(1000.0 AS DOUBLE) AS duration_seconds, CAST(user_id AS BIGINT) AS client
  FROM events)"""

_LABELS = [f"{b:g}" for b in LATENCY_BUCKETS_SECONDS] + ["+Inf"]

ORACLE["requests_by_route"] = _with(REQ) + """
SELECT method, route, status, service, CAST(count(*) AS BIGINT) AS requests FROM req
GROUP BY method, route, status, service"""

ORACLE["latency_histogram"] = _with(REQ) + "\nUNION ALL\n".join(
    f"SELECT service, '{lab}' AS le, CAST(count(*) FILTER (WHERE duration_seconds <= CAST({b} AS DOUBLE)) AS BIGINT)"
    f" AS count FROM req GROUP BY service"
    for lab, b in zip(_LABELS, LATENCY_BUCKETS_SECONDS)
) + "\nUNION ALL\nSELECT service, '+Inf', CAST(count(*) AS BIGINT) FROM req GROUP BY service"


def _quantile_sql(q: float) -> str:
    b = LATENCY_BUCKETS_SECONDS
    rank = f"(CAST({q} AS DOUBLE) * c_inf)"
    parts = []
    for i in range(len(b)):
        lower = b[i - 1] if i else 0.0
        below = f"c{i - 1}" if i else "0"
        parts.append(
            f"WHEN c{i} >= {rank} THEN CAST({lower} AS DOUBLE) + (CAST({b[i]} AS DOUBLE) - CAST({lower} AS DOUBLE))"
            f" * (({rank} - {below}) / (c{i} - {below}))"
        )
    return f"CASE WHEN c_inf > 0 THEN CASE {' '.join(parts)} ELSE CAST({b[-1]} AS DOUBLE) END END"


_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE duration_seconds <= CAST({v} AS DOUBLE)) AS c{i}"
    for i, v in enumerate(LATENCY_BUCKETS_SECONDS)
)

ORACLE["histogram_p95"] = _with(REQ, f"""h AS (
  SELECT service, date_trunc('hour', ts) AS window_start, {_COUNTS}, count(*) AS c_inf
  FROM req GROUP BY ALL)""") + f"""
SELECT service, window_start, round({_quantile_sql(0.95)}, 6) AS p95_seconds FROM h"""

def _rates(name: str, counted: str) -> str:
    """Every minute between a service's first and last request, also those without one."""
    return _with(REQ, """steps AS (
  SELECT service, unnest(generate_series(date_trunc('minute', min(ts)), date_trunc('minute', max(ts)), INTERVAL 1 MINUTE)) AS window_start
  FROM req GROUP BY service)""", f"""n AS (
  SELECT service, date_trunc('minute', ts) AS window_start, count(*) FILTER (WHERE {counted}) AS n FROM req GROUP BY ALL)""") + f"""
SELECT steps.service, steps.window_start, round(coalesce(n.n, 0) / 60.0, 6) AS {name}
FROM steps LEFT JOIN n ON n.service = steps.service AND n.window_start = steps.window_start"""


ORACLE["throughput_rate"] = _rates("rate", "true")
ORACLE["error_rate"] = _rates("error_rate", "status BETWEEN 500 AND 599")

ORACLE["metric_rate"] = _with("""s AS (
  SELECT 'svc-' || CAST(user_id % 5 AS VARCHAR) AS service, CAST(ts AS TIMESTAMP) AS ts, CAST(value AS DOUBLE) AS value
  FROM events WHERE ts IS NOT NULL AND value IS NOT NULL)""", """d AS (
  SELECT service, (epoch_us(ts) // 5000000 + 1) * 5 AS step_at, value, lag(value) OVER (PARTITION BY service ORDER BY ts, value) AS prev
  FROM s)""", """i AS (
  SELECT service, step_at, sum(CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END) AS inc
  FROM d GROUP BY service, step_at)""") + f"""
SELECT service, make_timestamp(step_at * 1000000) AS ts,
       round(sum(inc) OVER (PARTITION BY service ORDER BY step_at RANGE BETWEEN {P.RATE_WINDOW_SECONDS - 1} PRECEDING AND CURRENT ROW)
             / {float(P.RATE_WINDOW_SECONDS)}, 6) AS rate
FROM i"""

ORACLE["latest_up"] = _with(REQ) + """
SELECT service, arg_max(CASE WHEN status < 500 THEN 1 ELSE 0 END,
                        {'t': ts, 'u': CASE WHEN status < 500 THEN 1 ELSE 0 END}) AS up,
       max(ts) AS last_seen
FROM req GROUP BY service"""

SUMMARY = """summary AS (
  SELECT service, CAST(count(*) AS BIGINT) AS requests,
         round(count(*) / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 0), 6) AS req_per_s,
         round(count(*) FILTER (WHERE status >= 400) / count(*), 6) AS error_rate,
         round(avg(duration_seconds * 1000.0), 6) AS avg_ms,
         round(quantile_cont(duration_seconds * 1000.0, 0.5), 6) AS p50_ms,
         round(quantile_cont(duration_seconds * 1000.0, 0.9), 6) AS p90_ms,
         round(quantile_cont(duration_seconds * 1000.0, 0.95), 6) AS p95_ms,
         round(quantile_cont(duration_seconds * 1000.0, 0.99), 6) AS p99_ms,
         round(max(duration_seconds * 1000.0), 6) AS max_ms
  FROM req GROUP BY service)"""

ORACLE["load_summary"] = _with(REQ, SUMMARY) + "SELECT * FROM summary"


def _slo_sql() -> str:
    flags, per = [], {}
    for profile, metric, op, bound in SLO_THRESHOLDS:
        name = f"{profile}_{metric}_ok"
        flags.append(f"coalesce({metric} {op} {bound}, false) AS {name}")
        per.setdefault(profile, []).append(name)
    verdicts = [f"({' AND '.join(ns)}) AS {p}_passed" for p, ns in per.items()]
    return f"SELECT service, {', '.join(flags)} FROM summary", verdicts


_slo_inner, _slo_verdicts = _slo_sql()
ORACLE["slo_check"] = _with(REQ, SUMMARY, f"f AS ({_slo_inner})") + f"SELECT *, {', '.join(_slo_verdicts)} FROM f"

ORACLE["run_compare"] = _with(REQ, """r AS (
  SELECT service, date_trunc('day', ts) AS run, CAST(count(*) AS BIGINT) AS requests,
         quantile_cont(duration_seconds * 1000.0, 0.95) AS p95
  FROM req GROUP BY ALL)""") + """
SELECT service, run, requests, round(p95, 6) AS p95_ms,
       round(requests / lag(requests) OVER w, 6) AS throughput_ratio,
       round((p95 - lag(p95) OVER w) / lag(p95) OVER w * 100.0, 6) AS p95_change_pct
FROM r WINDOW w AS (PARTITION BY service ORDER BY run)"""

ORACLE["upstream_share"] = _with(REQ, f"""u AS (
  SELECT CASE WHEN event_id % 11 <> 0 THEN service || ':' || CAST(4000 + event_id % {P.UPSTREAM_REPLICAS} AS VARCHAR) END AS upstream
  FROM req)""") + """
SELECT upstream, CAST(count(*) AS BIGINT) AS requests,
       round(CASE WHEN upstream IS NOT NULL THEN count(*) END
             / sum(CASE WHEN upstream IS NOT NULL THEN count(*) END) OVER (), 6) AS share
FROM u GROUP BY upstream"""

ORACLE["access_log"] = _with(REQ) + """
SELECT ok AS parsed, CASE WHEN ok THEN method ELSE '' END AS method, CASE WHEN ok THEN '/api/' || route ELSE '' END AS path,
       CAST(CASE WHEN ok THEN status END AS INTEGER) AS status,
       CAST(CASE WHEN ok THEN CASE WHEN event_id % 5 = 0 THEN 2 ELSE 1 END END AS INTEGER) AS tries, CAST(count(*) AS BIGINT) AS requests
FROM (SELECT *, event_id % 11 <> 0 AS ok FROM req) GROUP BY ALL"""

ORACLE["throttled_clients"] = _with(REQ) + """
SELECT client, date_trunc('day', ts) AS window_start, CAST(count(*) AS BIGINT) AS attempts,
       count(*) > 20 AS throttled
FROM req GROUP BY ALL"""

ORACLE["service_overview"] = _with(REQ, f"""h AS (
  SELECT service, date_trunc('minute', ts) AS window_start, {_COUNTS}, count(*) AS c_inf,
         count(*) FILTER (WHERE status BETWEEN 500 AND 599) AS errors,
         arg_max(CASE WHEN status < 500 THEN 1 ELSE 0 END,
                 {{'t': ts, 'u': CASE WHEN status < 500 THEN 1 ELSE 0 END}}) AS up
  FROM req GROUP BY ALL)""") + f"""
SELECT service, window_start, round(c_inf / 60.0, 6) AS req_rate, round(errors / 60.0, 6) AS error_rate,
       round({_quantile_sql(0.95)}, 6) AS p95_seconds, up
FROM h"""

# The streaming job's read views must equal the batch rollups over the same events.
ORACLE["stream_minute_counts"] = ORACLE["minute_play_counts"]
ORACLE["stream_affinity"] = _with(*BASE, AFFINITY) + "SELECT user_hash, genre, play_count FROM aff"
# the decoder refuses plays of unknown songs (they have no genre), so only known ones reach the stored buckets
ORACLE["stream_trending"] = _trending(10, plays="plays") + """
SELECT t.song_id AS id, s.title, s.genre, s.cover_url, a.name AS artist, t.plays, t.rank
FROM top t JOIN songs s ON s.id = t.song_id JOIN artists a ON a.id = s.artist_id"""

ORACLE["stream_intake_rejects"] = ORACLE["reject_reasons"]

# Only accepted plays (premium gate, catalog lookup) reach the log; event times keep millisecond precision.
ORACLE["stream_end_to_end"] = _with(SONGS, USERS, EV, ACCEPT) + """
SELECT acc.song_id, min(acc.genre) AS genre, date_trunc('minute', e.ts) AS window_start,
       CAST(count(*) AS BIGINT) AS play_count
FROM acc JOIN ev e ON e.event_id = acc.event_id
WHERE acc.reject_reason IS NULL AND acc.type = 'play'
GROUP BY acc.song_id, date_trunc('minute', e.ts)"""

ORACLE["stream_windowed_counts"] = _with(*BASE) + """
SELECT window_start, song_id, genre, CAST(count(*) AS BIGINT) AS plays
FROM plays GROUP BY window_start, song_id, genre"""

ORACLE["stream_deduplicated"] = ORACLE["stream_windowed_counts"]
ORACLE["stream_late_dropped"] = _with(*BASE) + f"""
SELECT window_start, song_id, genre, CAST(count(*) AS BIGINT) AS plays
FROM plays WHERE ts >= TIMESTAMP '{P.STREAM_CUTS[1]}' GROUP BY window_start, song_id, genre"""
ORACLE["stream_compacted_counts"] = ORACLE["minute_play_counts"]
ORACLE["stream_batch_log"] = _with(*BASE) + """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST((SELECT count(*) FROM plays) AS BIGINT) AS plays,
       CAST(count(*) FILTER (WHERE type IS NULL OR type NOT IN ('play', 'skip', 'like') OR e.song_id IS NULL OR ts IS NULL
                             OR s.genre IS NULL) AS BIGINT) AS rejected
FROM ev e LEFT JOIN songs s ON s.id = e.song_id"""

# Folding, merging and a replay change nothing.
ORACLE["stream_levelled_counts"] = ORACLE["minute_play_counts"]
ORACLE["stream_window_tree"] = _with(*BASE) + " UNION ALL ".join(f"""
SELECT {n} AS window_no, song_id, CAST(count(*) AS BIGINT) AS plays FROM plays
WHERE window_start BETWEEN date_trunc('minute', TIMESTAMP '{asof}') - INTERVAL {minutes - 1} MINUTE AND date_trunc('minute', TIMESTAMP '{asof}')
GROUP BY song_id""" for n, (asof, minutes) in enumerate(P.TREE_WINDOWS))
ORACLE["stream_erased_affinity"] = _with(*BASE, f"""gone AS (
  SELECT {pseudonym_sql('c_custkey')} AS user_hash FROM customer WHERE c_acctbal < 0)""") + f"""
SELECT user_hash, genre, CAST(count(*) AS BIGINT) AS play_count FROM plays
WHERE ts >= TIMESTAMP '{P.STREAM_CUTS[1]}' OR user_hash NOT IN (SELECT user_hash FROM gone) GROUP BY ALL"""

ORACLE["throttle_windows"] = _with(REQ, """attempts AS (
  SELECT client, ts, count(*) AS n FROM req WHERE client IS NOT NULL AND ts IS NOT NULL GROUP BY ALL)""").replace(
    "WITH ", "WITH RECURSIVE ", 1) + f""", windows(client, s) AS (
  SELECT client, min(ts) FROM attempts GROUP BY client
  UNION ALL
  SELECT w.client, min(a.ts) FROM windows w JOIN attempts a ON a.client = w.client AND a.ts >= w.s + INTERVAL {P.ATTEMPT_SECONDS} SECOND
  GROUP BY w.client, w.s),
counted AS (
  SELECT w.client, w.s AS window_start, CAST(sum(a.n) AS BIGINT) AS attempts
  FROM windows w JOIN attempts a ON a.client = w.client AND a.ts >= w.s AND a.ts < w.s + INTERVAL {P.ATTEMPT_SECONDS} SECOND GROUP BY ALL)
SELECT client, window_start, attempts, greatest(attempts - {P.ATTEMPT_LIMIT}, 0) AS refused, attempts > {P.ATTEMPT_LIMIT} AS throttled FROM counted"""
ORACLE["stream_throttle_windows"] = ORACLE["throttle_windows"]

ORACLE["search_songs_indexed"] = ORACLE["search_songs"]
ORACLE["search_patterns"] = _with(SONGS, ARTISTS, CARDS, f"""patterns AS (
  SELECT DISTINCT pattern FROM (SELECT unnest(string_split(title, ' ')) AS pattern FROM songs UNION ALL SELECT name FROM artists
    UNION ALL SELECT unnest([{', '.join("'" + x + "'" for x in P.SEARCH_PATTERNS)}])) WHERE pattern IS NOT NULL)""") + r"""
SELECT pattern, CAST(count(*) AS BIGINT) AS matches, CAST(sum(id) AS BIGINT) AS id_sum, min(id) AS first_id FROM patterns JOIN cards
  ON title ILIKE '%' || pattern || '%' ESCAPE '\' OR artist ILIKE '%' || pattern || '%' ESCAPE '\' GROUP BY pattern"""

# Stored samples: one a time and series.
_SAMPLES = ("""s AS (
  SELECT 'svc-' || CAST(user_id % 5 AS VARCHAR) AS service, CAST(ts AS TIMESTAMP) AS ts, max(CAST(value AS DOUBLE)) AS value
  FROM events WHERE ts IS NOT NULL AND value IS NOT NULL GROUP BY ALL)""", f"""grid AS (
  SELECT service, unnest(generate_series(TIMESTAMP '{P.PANEL_START}', TIMESTAMP '{P.PANEL_END}', INTERVAL {P.PANEL_STEP_SECONDS} SECOND)) AS t
  FROM (SELECT DISTINCT 'svc-' || CAST(user_id % 5 AS VARCHAR) AS service FROM events))""")
ORACLE["metric_instant"] = _with(*_SAMPLES) + """
SELECT g.service, g.t AS ts, s.ts AS sample_ts, s.value FROM grid g ASOF JOIN s ON s.service = g.service AND g.t >= s.ts
WHERE g.t - s.ts < INTERVAL 300 SECOND"""
ORACLE["metric_extrapolated_rate"] = _with(*_SAMPLES, """d AS (
  SELECT *, lag(value) OVER (PARTITION BY service ORDER BY ts) AS prev FROM s)""", """i AS (
  SELECT service, ts, value, CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS inc FROM d)""", f"""w AS (
  SELECT g.service, g.t, count(*) AS n, min(i.ts) AS a, max(i.ts) AS b, arg_min(i.value, i.ts) AS v, sum(i.inc) - arg_min(i.inc, i.ts) AS grown
  FROM grid g JOIN i ON i.service = g.service AND i.ts <= g.t AND i.ts > g.t - INTERVAL {P.PANEL_RANGE_SECONDS} SECOND
  GROUP BY g.service, g.t HAVING count(*) > 1)""", f"""x AS (
  SELECT *, (epoch_us(b) - epoch_us(a)) / 1e6 AS sampled, (epoch_us(t) - epoch_us(b)) / 1e6 AS e,
         (epoch_us(a) - epoch_us(t)) / 1e6 + {P.PANEL_RANGE_SECONDS} AS b0 FROM w)""", """y AS (
  SELECT *, CASE WHEN e >= 1.1 * sampled / (n - 1) THEN sampled / (n - 1) / 2 ELSE e END AS to_end,
         CASE WHEN b0 >= 1.1 * sampled / (n - 1) THEN sampled / (n - 1) / 2 ELSE b0 END AS to_start,
         CASE WHEN grown > 0 AND v >= 0 THEN sampled * v / grown ELSE 1e300 END AS to_zero FROM x)""") + f"""
SELECT service, t AS ts, round(grown * (sampled + least(to_start, to_zero) + to_end) / sampled / {float(P.PANEL_RANGE_SECONDS)}, 6) AS rate FROM y"""

# Places on a logarithmic scale whose buckets are one per cent wide to either side.
_STATE = """b AS (
  SELECT service, ts, status, CASE WHEN duration_seconds IS NULL THEN NULL WHEN abs(duration_seconds) < 1e-12 THEN 0
         ELSE sign(duration_seconds) * (ceil(ln(abs(duration_seconds) / CAST(1e-12 AS DOUBLE)) / ln(CAST(1.01 AS DOUBLE) / CAST(0.99 AS DOUBLE))) + 1) END AS place
  FROM req WHERE ts IS NOT NULL)"""


def _place_value(place: str) -> str:
    return (f"CASE WHEN {place} = 0 THEN 0 ELSE sign({place}) * 2e-12 * pow(CAST(1.01 AS DOUBLE) / 0.99, abs({place}) - 1)"
            f" / (CAST(1.01 AS DOUBLE) / 0.99 + 1) END * 1000")


def _places(group: str, where: str = "true") -> str:
    """Per group: requests, error rate, and the places of the quantiles."""
    nth = ", ".join(f"min(place) FILTER (WHERE no > floor(CAST({p} AS DOUBLE) * (timed - 1))) AS p{int(p * 100)}" for p in (0.5, 0.9, 0.95, 0.99))
    return f"""q AS (
  SELECT service, {group}, count(*) AS requests, round(count(*) FILTER (WHERE status >= 400) / count(*), 6) AS error_rate, {nth}
  FROM (SELECT *, {group.rsplit(' AS ', 1)[0]} AS g, CASE WHEN place IS NOT NULL THEN row_number() OVER (PARTITION BY service, {group.rsplit(' AS ', 1)[0]}
          ORDER BY place NULLS LAST) END AS no, count(place) OVER (PARTITION BY service, {group.rsplit(' AS ', 1)[0]}) AS timed FROM b WHERE {where})
  GROUP BY ALL)"""


ORACLE["stream_latency_quantiles"] = _with(REQ, _STATE, _places(
    "date_trunc('day', ts) AS day", f"ts >= TIMESTAMP '{P.STREAM_CUTS[0]}' AND ts < TIMESTAMP '{P.STREAM_CUTS[2]}'")) + """
SELECT service, CAST(day AS TIMESTAMP) AS day, CAST(requests AS BIGINT) AS requests, error_rate, """ + ", ".join(
    f"round({_place_value(f'p{x}')}, 6) AS p{x}_ms" for x in (50, 90, 95, 99)) + " FROM q"
ORACLE["stream_latency_runs"] = _with(REQ, _STATE, _places("date_trunc('day', ts) AS run"), f"""r AS (
  SELECT service, CAST(run AS TIMESTAMP) AS run, CAST(requests AS BIGINT) AS requests, round({_place_value('p95')}, 6) AS p95_ms FROM q)""") + """
SELECT service, run, requests, p95_ms, round(requests / lag(requests) OVER w, 6) AS throughput_ratio,
       round((p95_ms - lag(p95_ms) OVER w) / nullif(lag(p95_ms) OVER w, 0) * 100, 6) AS p95_change_pct
FROM r WINDOW w AS (PARTITION BY service ORDER BY run)"""

ORACLE["stream_catalog_asof"] = _with(SONGS, EV, f"""feed AS (
  SELECT id AS song_id, genre, true AS live, TIMESTAMP '2000-01-01' AS valid_from FROM songs
  UNION ALL SELECT id, 'NEW ' || genre, true, TIMESTAMP '{P.STREAM_CUTS[1]}' + INTERVAL 1 HOUR * (id % 24) FROM songs WHERE id % 3 = 0
  UNION ALL SELECT id, genre, false, TIMESTAMP '{P.STREAM_CUTS[2]}' FROM songs WHERE id % 50 = 7)""") + """
SELECT e.type, CASE WHEN f.live THEN f.genre END AS genre, coalesce(f.live, false) AS known, CAST(count(*) AS BIGINT) AS events
FROM ev e ASOF LEFT JOIN feed f ON f.song_id = e.song_id AND e.ts >= f.valid_from WHERE e.ts IS NOT NULL GROUP BY ALL"""

ORACLE["stream_unique_exact"] = ORACLE["minute_unique_exact"]
ORACLE["stream_unique_daily"] = _with(*BASE) + """
SELECT song_id, CAST(date_trunc('day', window_start) AS TIMESTAMP) AS window_start, CAST(count(DISTINCT user_hash) AS BIGINT) AS unique_listeners
FROM plays GROUP BY ALL"""


def _boards(scope: str, keys: str, genre: str) -> str:
    """Alive: written at the last time. The write before it is of the same session, the first one through the second only."""
    return f"""
SELECT '{scope}' AS scope, minute, {genre} AS genre, song_id, CAST(sum(plays) AS BIGINT) AS plays,
       {ASOF} + INTERVAL {30 - P.BOARD_AGES[2]} MINUTE AS expires_at
FROM d JOIN (SELECT {keys}, bool_or(epoch = 1) AS second FROM d GROUP BY {keys} HAVING bool_or(epoch = 2)) k USING ({keys})
WHERE epoch > 0 OR second GROUP BY minute, {genre}, song_id"""


ORACLE["stream_leaderboard"] = _with(*BASE, f"""d AS (
  SELECT CAST(floor(epoch(window_start) / 60) AS BIGINT) AS minute, genre, song_id, event_id % {P.MERGE_BATCHES} AS epoch, count(*) AS plays
  FROM plays GROUP BY ALL)""") + _boards("genre", "minute, genre", "genre") + " UNION ALL " + _boards("global", "minute", "CAST(NULL AS VARCHAR)")
