"""The same results as plain SQL over the test tables, for a side-by-side check."""

from __future__ import annotations

from sluicework.plans.feeds import FIRST_LOAD_UNTIL, SNAPSHOTS

PLAY_COLUMNS = (
    "play_id, user_id, content_id, device_id, played_at, event_date, created_at,"
    " late_arriving_data, ms_played, bronze_ingested_at, source_file, snapshot_date"
)
USER_COLUMNS = (
    "user_id, email, country, plan_tier, created_at, updated_at, bronze_ingested_at,"
    " source_file, snapshot_date"
)

RAW_PLAYS = """
raw_plays AS (
  SELECT event_id, event_type,
    CAST(CASE WHEN event_id % 41 = 0 AND event_id > 0 THEN event_id - 1 ELSE event_id END
      AS VARCHAR) AS play_id,
    CASE WHEN event_id % 53 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
    regexp_extract(props, '([0-9]+)', 1) AS content_id,
    CAST(event_id % 5 + 1 AS VARCHAR) AS device_id,
    CASE WHEN event_id % 97 = 0 THEN '03/01/2026'
      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS played_at,
    strftime(recorded, '%Y-%m-%dT%H:%M:%S.%f') AS created_at,
    CASE WHEN event_id % 61 = 0 THEN 'NaN' WHEN event_id % 67 = 0 THEN '-5000'
      ELSE CAST(event_id * 37 % 300000 + 1000 AS VARCHAR) END AS ms_played,
    CAST(CAST(recorded AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) AS ingested_at,
    'f' || CAST(event_id % 4 AS VARCHAR) AS source_file,
    CAST(recorded AS DATE) AS snapshot_date
  FROM (SELECT *, CASE WHEN event_id % 29 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS recorded
        FROM events)
)"""


def typed_plays(raw: str, out: str) -> str:
    """Casts, with the reasons of the rows that fail one."""
    return f"""
{out} AS (
  SELECT *, concat_ws('; ',
      CASE WHEN bad_played THEN 'cast_error_played_at' END,
      CASE WHEN bad_ms THEN 'cast_error_ms_played' END) AS cast_reason
  FROM (
    SELECT TRY_CAST(play_id AS BIGINT) AS play_id, TRY_CAST(user_id AS BIGINT) AS user_id,
      TRY_CAST(content_id AS BIGINT) AS content_id, TRY_CAST(device_id AS BIGINT) AS device_id,
      TRY_CAST(played_at AS TIMESTAMP) AS played_at,
      CAST(TRY_CAST(played_at AS TIMESTAMP) AS DATE) AS event_date,
      TRY_CAST(created_at AS TIMESTAMP) AS created_at,
      CAST(TRY_CAST(created_at AS TIMESTAMP) AS DATE)
        > CAST(TRY_CAST(played_at AS TIMESTAMP) AS DATE) AS late_arriving_data,
      TRY_CAST(ms_played AS BIGINT) AS ms_played,
      ingested_at AS bronze_ingested_at, source_file, snapshot_date,
      played_at IS NOT NULL AND TRY_CAST(played_at AS TIMESTAMP) IS NULL AS bad_played,
      ms_played IS NOT NULL AND TRY_CAST(ms_played AS BIGINT) IS NULL AS bad_ms
    FROM {raw})
)"""


PLAY_RULES = """concat_ws('; ',
    CASE WHEN play_id IS NULL THEN 'null_play_id' END,
    CASE WHEN user_id IS NULL THEN 'null_user_id' END,
    CASE WHEN content_id IS NULL THEN 'null_content_id' END,
    CASE WHEN device_id IS NULL THEN 'null_device_id' END,
    CASE WHEN played_at IS NULL THEN 'null_played_at' END,
    CASE WHEN created_at IS NULL THEN 'null_created_at' END,
    CASE WHEN ms_played IS NULL THEN 'null_ms_played' END,
    CASE WHEN ms_played <= 0 THEN 'non_positive_ms_played' END)"""


def gated_plays(raw: str, name: str) -> str:
    """``<name>_typed``, ``_judged``, ``_ranked`` and the accepted rows as ``<name>``."""
    return f"""{typed_plays(raw, f"{name}_typed")},
{name}_judged AS (
  SELECT {PLAY_COLUMNS}, {PLAY_RULES} AS rule_reason FROM {name}_typed WHERE cast_reason = ''
),
{name}_ranked AS (
  SELECT {PLAY_COLUMNS}, row_number() OVER (PARTITION BY play_id
      ORDER BY bronze_ingested_at DESC, created_at DESC, source_file DESC) AS nth
  FROM {name}_judged WHERE rule_reason = ''
),
{name} AS (SELECT {PLAY_COLUMNS} FROM {name}_ranked WHERE nth = 1)"""


def play_errors(name: str) -> str:
    return f"""
SELECT {PLAY_COLUMNS}, cast_reason AS error_reason, 'cast' AS error_stage
FROM {name}_typed WHERE cast_reason <> ''
UNION ALL
SELECT {PLAY_COLUMNS}, rule_reason, 'validation' FROM {name}_judged WHERE rule_reason <> ''
UNION ALL
SELECT {PLAY_COLUMNS}, 'duplicate_play_id', 'deduplication' FROM {name}_ranked WHERE nth > 1"""


def upserted(current: str, loaded: str, out: str) -> str:
    """The loaded days after an upsert."""
    columns = ", ".join(f"l.{c.strip()}" for c in PLAY_COLUMNS.split(","))
    return f"""
{out} AS (
  SELECT {columns}, c.play_sk FROM {loaded} l
  JOIN {current} c ON c.play_id = l.play_id AND c.snapshot_date = l.snapshot_date
  UNION ALL
  SELECT {columns}, row_number() OVER (ORDER BY l.play_id)
      + (SELECT coalesce(max(play_sk), 0) FROM {current}) AS play_sk
  FROM {loaded} l WHERE l.play_id NOT IN (SELECT play_id FROM {current})
)"""


NO_FACTS = f"""
no_facts AS (
  SELECT {PLAY_COLUMNS}, CAST(0 AS BIGINT) AS play_sk FROM typed_once WHERE 1 = 0
)"""

FACTS = f"""WITH {RAW_PLAYS},
first_raw AS (SELECT * FROM raw_plays WHERE snapshot_date <= DATE '{FIRST_LOAD_UNTIL}'),
next_raw AS (SELECT * FROM raw_plays WHERE snapshot_date > DATE '{FIRST_LOAD_UNTIL}'),
again_raw AS (SELECT * REPLACE (replace(ms_played, '-', '') AS ms_played) FROM first_raw
  WHERE event_type <> 'error'),
{typed_plays("raw_plays", "typed_once")},{NO_FACTS},
{gated_plays("first_raw", "first_load")},{gated_plays("next_raw", "next_load")},
{gated_plays("again_raw", "again_load")},{upserted("no_facts", "first_load", "first_rows")},
{upserted("first_rows", "next_load", "next_rows")},
both_rows AS (SELECT * FROM first_rows UNION ALL SELECT * FROM next_rows),
{upserted("both_rows", "again_load", "again_rows")},
redropped AS (SELECT * FROM again_rows UNION ALL SELECT * FROM next_rows)
"""

PLAYS = f"WITH {RAW_PLAYS},{gated_plays('raw_plays', 'plays')}"

STORED_PLAYS = f"""{PLAYS},
stored AS (SELECT *, row_number() OVER (ORDER BY play_id) AS play_sk FROM plays)
"""


def raw_users(snapshot: str, out: str) -> str:
    return f"""
{out} AS (
  SELECT CASE WHEN c_custkey % 97 = 0 THEN 'u-' ELSE '' END || CAST(c_custkey AS VARCHAR)
      AS user_id,
    CASE WHEN c_custkey % 89 <> 0
      THEN lower(replace(c_name, '#', '.')) || '@example.org' END AS email,
    n_name AS country,
    CASE WHEN copy = 0 AND first_day IS NOT NULL THEN 'trial'
      ELSE lower(o_orderpriority) END AS plan_tier,
    strftime(first_day, '%Y-%m-%dT%H:%M:%S') AS created_at,
    CASE WHEN c_custkey % 101 = 0 THEN 'n/a'
      WHEN o_orderdate > first_day THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END
      AS updated_at,
    TIMESTAMP '{snapshot} 10:00:00' AS ingested_at,
    'users_' || CAST(copy AS VARCHAR) AS source_file,
    DATE '{snapshot}' AS snapshot_date
  FROM customer LEFT JOIN (SELECT o_custkey, o_orderdate, o_orderpriority,
          min(o_orderdate) OVER (PARTITION BY o_custkey) AS first_day,
          row_number() OVER (PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth
        FROM orders WHERE o_orderdate <= TIMESTAMP '{snapshot} 00:00:00') latest
    ON c_custkey = o_custkey AND nth = 1
  JOIN nation ON n_nationkey = c_nationkey
  CROSS JOIN (VALUES (0), (1)) copies(copy)
  WHERE copy = 1 OR c_custkey % 31 = 0
)"""


def gated_users(raw: str, name: str) -> str:
    return f"""
{name}_typed AS (
  SELECT *, concat_ws('; ', CASE WHEN bad_id THEN 'cast_error_user_id' END,
      CASE WHEN bad_update THEN 'cast_error_updated_at' END) AS cast_reason
  FROM (
    SELECT TRY_CAST(user_id AS BIGINT) AS user_id, email, country, plan_tier,
      TRY_CAST(created_at AS TIMESTAMP) AS created_at,
      TRY_CAST(updated_at AS TIMESTAMP) AS updated_at,
      ingested_at AS bronze_ingested_at, source_file, snapshot_date,
      user_id IS NOT NULL AND TRY_CAST(user_id AS BIGINT) IS NULL AS bad_id,
      updated_at IS NOT NULL AND TRY_CAST(updated_at AS TIMESTAMP) IS NULL AS bad_update
    FROM {raw})
),
{name}_judged AS (
  SELECT {USER_COLUMNS}, concat_ws('; ',
    CASE WHEN user_id IS NULL THEN 'null_user_id' END,
    CASE WHEN email IS NULL THEN 'null_email' END,
    CASE WHEN country IS NULL THEN 'null_country' END,
    CASE WHEN plan_tier IS NULL THEN 'null_plan_tier' END,
    CASE WHEN created_at IS NULL THEN 'null_created_at' END) AS rule_reason
  FROM {name}_typed WHERE cast_reason = ''
),
{name}_ranked AS (
  SELECT {USER_COLUMNS}, row_number() OVER (PARTITION BY user_id
      ORDER BY coalesce(updated_at, created_at) DESC, bronze_ingested_at DESC,
        source_file DESC, email DESC, country DESC, plan_tier DESC) AS nth
  FROM {name}_judged WHERE rule_reason = ''
),
{name} AS (SELECT {USER_COLUMNS} FROM {name}_ranked WHERE nth = 1)"""


def user_errors(name: str) -> str:
    return f"""
SELECT {USER_COLUMNS}, cast_reason AS error_reason, 'cast' AS error_stage
FROM {name}_typed WHERE cast_reason <> ''
UNION ALL
SELECT {USER_COLUMNS}, rule_reason, 'validation' FROM {name}_judged WHERE rule_reason <> ''
UNION ALL
SELECT {USER_COLUMNS}, 'duplicate_user_id', 'deduplication' FROM {name}_ranked WHERE nth > 1"""


def merged(current: str, loaded: str, out: str) -> str:
    """One type-2 merge; ``<out>_new`` holds the new versions."""
    columns = ", ".join(f"l.{c.strip()}" for c in USER_COLUMNS.split(","))
    kept = ", ".join(f"c.{c.strip()}" for c in USER_COLUMNS.split(","))
    return f"""
{out}_new AS (
  SELECT {columns}, coalesce(l.updated_at, l.created_at) AS valid_from,
    a.user_id IS NOT NULL AS closes, a.valid_from AS since
  FROM {loaded} l LEFT JOIN (SELECT * FROM {current} WHERE is_current) a
    ON a.user_id = l.user_id
  WHERE a.user_id IS NULL OR a.email IS DISTINCT FROM l.email
    OR a.country IS DISTINCT FROM l.country OR a.plan_tier IS DISTINCT FROM l.plan_tier
),
{out} AS (
  SELECT {USER_COLUMNS}, customer_sk, valid_from, valid_to, is_current
  FROM {current} WHERE NOT is_current
  UNION ALL
  SELECT {kept}, c.customer_sk, c.valid_from, n.valid_from, n.user_id IS NULL
  FROM {current} c LEFT JOIN {out}_new n ON n.user_id = c.user_id AND n.closes
  WHERE c.is_current
  UNION ALL
  SELECT {USER_COLUMNS}, row_number() OVER (ORDER BY user_id)
      + (SELECT coalesce(max(customer_sk), 0) FROM {current}),
    valid_from, CAST(NULL AS TIMESTAMP), TRUE
  FROM {out}_new
)"""


NO_USERS = f"""
no_users AS (
  SELECT {USER_COLUMNS}, CAST(0 AS BIGINT) AS customer_sk, created_at AS valid_from,
    created_at AS valid_to, TRUE AS is_current
  FROM users1 WHERE 1 = 0
)"""

USERS = "WITH " + ",".join(
    raw_users(day, f"raw_users{n}") + "," + gated_users(f"raw_users{n}", f"users{n}")
    for n, day in enumerate(SNAPSHOTS, 1)
)
HISTORY = (
    f"{USERS},{NO_USERS},{merged('no_users', 'users1', 'dim1')},"
    f"{merged('dim1', 'users2', 'dim2')},{merged('dim2', 'users3', 'dim3')}"
)
FIRST_HISTORY = f"{USERS},{NO_USERS},{merged('no_users', 'users3', 'dim')}"
# The first snapshot and the last one.
TWO_DAYS = (
    f"{USERS},{NO_USERS},{merged('no_users', 'users1', 'dim1')},{merged('dim1', 'users3', 'dim')}"
)
# The second snapshot arrives after the third.
LATE_HISTORY = f"{TWO_DAYS},{merged('dim', 'users2', 'back')}"

def _json(names: tuple[str, ...]) -> str:
    parts = [f"'\"{name}\":' || coalesce('\"' || {name} || '\"', 'null')" for name in names]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


_PLAY_NAMES = (
    "play_id",
    "user_id",
    "content_id",
    "device_id",
    "played_at",
    "created_at",
    "ms_played",
)
USER_NAMES = ("user_id", "email", "country", "plan_tier", "created_at", "updated_at")
LINES = f"""WITH {RAW_PLAYS},
play_lines AS (SELECT *, {_json(_PLAY_NAMES)} AS line FROM raw_plays)
"""


def user_lines(raw: str, out: str) -> str:
    """Users as JSON lines, and whether a line is cut short."""
    return f"""
{out} AS (
  SELECT *, {_json(USER_NAMES)} AS line,
    CAST(replace(user_id, 'u-', '') AS BIGINT) % 43 = 0 AS cut FROM {raw}
)"""
