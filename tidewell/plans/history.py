"""Change data capture over the event table: users are keys, events are changes.

The state before the cut is the target, events after it are the change batch.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidewell import catalog
from tidewell.operators import cdc
from tidewell.plans import sql
from tidewell.plans.registry import Registry
from tidewell.session import scratch_dir
from tidewell.streaming import incremental

R = Registry()
NOW = datetime.datetime(2024, 2, 1)
KEYS, TRACKED, SEQ, DELETE = ["user_id"], ["balance", "status"], "updated_at", "operation = 'DELETE'"


def _state(spark, folder):
    events = catalog.changes(spark, folder).where(F.col(SEQ) < F.lit(catalog.EVENTS_CUT))
    return cdc.scd1(events, KEYS, SEQ, DELETE, exclude=["operation", "event_id"])


def _batch(spark, folder):
    return catalog.changes(spark, folder).where(F.col(SEQ) >= F.lit(catalog.EVENTS_CUT))


def _state_sql(condition: str = "TRUE") -> str:
    return f"""SELECT user_id, balance, status, updated_at FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, event_id DESC) AS place
        FROM moves WHERE {condition}) WHERE place = 1 AND operation <> 'DELETE'"""


_BEFORE = "updated_at < TIMESTAMP '2024-01-15'"
_AFTER = "updated_at >= TIMESTAMP '2024-01-15'"
_STAMP = "TIMESTAMP '2024-02-01'"
_COLUMNS = f"user_id, {sql.dbl('balance')} AS balance"




def _fold_sql(old: str, changes: str, soft: bool, body: str) -> str:
    """Changes applied to ``old`` one by one, in order, by recursion over single changes."""
    gone = "op = 'DELETE' AND present"
    born, written = "(op = 'INSERT' AND NOT present)", "((op = 'INSERT' AND NOT present) OR (op = 'UPDATE' AND present))"
    lost = "FALSE" if soft else f"({gone})"
    status = f"WHEN {gone} THEN 'deleted'" if soft else ""
    views = sql.query("moves", "", seqd=f"""SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY updated_at, balance, status, operation, event_id) AS n FROM moves WHERE {changes}""",
        old=old,
        fold=f"""SELECT u.user_id, CAST(0 AS BIGINT) AS n, o.user_id IS NOT NULL AS present, o.balance, o.status, o.updated_at,
                NULL::TIMESTAMP AS created, NULL::TIMESTAMP AS touched, FALSE AS marked
            FROM (SELECT user_id FROM seqd UNION SELECT user_id FROM old) u LEFT JOIN old o USING (user_id)
        UNION ALL
            SELECT user_id, n, CASE WHEN {born} THEN TRUE WHEN {lost} THEN FALSE ELSE present END,
                CASE WHEN {written} THEN nb ELSE balance END,
                CASE WHEN {written} THEN ns {status} ELSE status END, CASE WHEN {written} THEN nu ELSE updated_at END,
                CASE WHEN {born} THEN {_STAMP} WHEN {lost} THEN NULL ELSE created END,
                CASE WHEN {written} OR ({gone} AND {soft}) THEN {_STAMP} WHEN {lost} THEN NULL ELSE touched END,
                marked OR ({gone} AND {soft})
            FROM (SELECT f.*  EXCLUDE (n), s.n, s.operation AS op, s.balance AS nb, s.status AS ns, s.updated_at AS nu
                  FROM fold f JOIN seqd s ON s.user_id = f.user_id AND s.n = f.n + 1)""",
        final="SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC) AS r FROM fold) WHERE r = 1 AND present",
    )
    return views.replace("WITH ", "WITH RECURSIVE ", 1) + body


_NOTHING = "SELECT * FROM (" + _state_sql(_BEFORE) + ") WHERE FALSE"


@R.add(_fold_sql(_state_sql(_BEFORE), _AFTER, False, f"""SELECT {_COLUMNS}, status, updated_at,
    created AS _created_at, touched AS _last_updated FROM final"""))
def merge_hard_delete(spark, folder):
    target = _state(spark, folder)
    return cdc.merge(target, _batch(spark, folder), KEYS, [*TRACKED, SEQ], NOW, sequence=SEQ)


@R.add(_fold_sql(_state_sql(_BEFORE), _AFTER, True, f"""SELECT {_COLUMNS}, status, updated_at, created AS _created_at,
    touched AS _last_updated, marked AS _is_deleted, CASE WHEN marked THEN {_STAMP} END AS _deleted_at FROM final"""))
def merge_soft_delete(spark, folder):
    target = _state(spark, folder)
    return cdc.merge(target, _batch(spark, folder), KEYS, [*TRACKED, SEQ], NOW, sequence=SEQ, delete="soft")


@R.add(_fold_sql(_NOTHING, "TRUE", False, f"SELECT {_COLUMNS}, status, updated_at FROM final"))
def merge_first_load(spark, folder):
    loaded = cdc.first_load(catalog.changes(spark, folder), KEYS, NOW, sequence=SEQ)
    return loaded.select("user_id", "balance", "status", SEQ)


@R.add(sql.query("moves", f"""SELECT {_COLUMNS}, status, updated_at FROM new
    UNION ALL SELECT {_COLUMNS}, status, updated_at FROM old WHERE user_id NOT IN (SELECT user_id FROM new)""",
    old=_state_sql(_BEFORE), new=_state_sql(_AFTER)))
def upserted_state(spark, folder):
    source = cdc.scd1(_batch(spark, folder), KEYS, SEQ, DELETE, exclude=["operation", "event_id"])
    return cdc.upsert(_state(spark, folder), source, KEYS)


@R.add(sql.query("moves", f"SELECT {_COLUMNS}, status, updated_at FROM now_", now_=_state_sql()))
def scd1_state(spark, folder):
    return cdc.scd1(catalog.changes(spark, folder), KEYS, SEQ, DELETE, exclude=["operation", "event_id"])


_HISTORY = {
    "e": """SELECT *, operation = 'DELETE' AS gone, lag(balance) OVER w AS pb, lag(status) OVER w AS ps,
        lag(operation = 'DELETE') OVER w AS pg FROM moves WINDOW w AS (PARTITION BY user_id ORDER BY updated_at)""",
    "bounds": """SELECT * FROM e WHERE (NOT gone AND (pg IS NULL OR pg OR balance IS DISTINCT FROM pb
        OR status IS DISTINCT FROM ps)) OR (gone AND pg = FALSE)""",
    "ended": "SELECT *, lead(updated_at) OVER (PARTITION BY user_id ORDER BY updated_at) AS valid_to FROM bounds",
    "hist": """SELECT user_id, balance, status, updated_at AS valid_from, valid_to, valid_to IS NULL AS is_current,
        CAST(row_number() OVER (PARTITION BY user_id ORDER BY updated_at) AS INT) AS version FROM ended WHERE NOT gone""",
}
_HISTORY_SQL = sql.query("moves", f"SELECT * REPLACE ({sql.dbl('balance')} AS balance) FROM hist", **_HISTORY)


def _history(spark, folder, **options):
    return cdc.scd2(catalog.changes(spark, folder), KEYS, SEQ, TRACKED, DELETE, **options)


@R.add(_HISTORY_SQL)
def scd2_history(spark, folder):
    return _history(spark, folder)


@R.add(_HISTORY_SQL)
def scd2_history_split(spark, folder):
    """The same history by the route for keys with too many rows for one task."""
    return _history(spark, folder, split_rows=20)


@R.add(_HISTORY_SQL)
def scd2_history_updated(spark, folder):
    """History of the events before the cut, then the batch after it."""
    early = catalog.changes(spark, folder).where(F.col(SEQ) < F.lit(catalog.EVENTS_CUT))
    history = cdc.scd2(early, KEYS, SEQ, TRACKED, DELETE)
    return cdc.scd2_update(history, early, _batch(spark, folder), KEYS, SEQ, TRACKED, DELETE)


@R.add(sql.query("moves", f"""SELECT {_COLUMNS}, status, valid_from, valid_to, version FROM hist
    WHERE valid_from <= TIMESTAMP '2024-01-20' AND (valid_to IS NULL OR TIMESTAMP '2024-01-20' < valid_to)""", **_HISTORY))
def state_as_of(spark, folder):
    found = cdc.as_of(_history(spark, folder), catalog.EVENTS_LATE)
    return found.select("user_id", *TRACKED, "valid_from", "valid_to", "version")


_SNAPSHOTS = {"first_": _state_sql(_BEFORE), "second": _state_sql()}


@R.add(sql.query("moves", f"""
    SELECT user_id, {sql.dbl('f.balance')} AS balance, f.status, TIMESTAMP '2024-01-15' AS valid_from,
           CASE WHEN s.user_id IS NULL OR {{0}} THEN {_STAMP} END AS valid_to,
           s.user_id IS NOT NULL AND NOT ({{0}}) AS is_current, 1 AS version
    FROM first_ f LEFT JOIN second s USING (user_id)
    UNION ALL
    SELECT user_id, {sql.dbl('s.balance')}, s.status, {_STAMP}, NULL, TRUE, CASE WHEN f.user_id IS NULL THEN 1 ELSE 2 END
    FROM second s LEFT JOIN first_ f USING (user_id) WHERE f.user_id IS NULL OR {{0}}""".format(
        "(f.balance IS DISTINCT FROM s.balance OR f.status IS DISTINCT FROM s.status)"), **_SNAPSHOTS))
def scd2_snapshot_merge(spark, folder):
    first = _state(spark, folder)
    second = cdc.scd1(catalog.changes(spark, folder), KEYS, SEQ, DELETE)
    history = cdc.scd2_merge(cdc.empty_history(first, KEYS, TRACKED), first, KEYS, TRACKED, catalog.EVENTS_CUT)
    return cdc.scd2_merge(history, second, KEYS, TRACKED, NOW, close_missing=True)


@R.add(sql.query("moves", f"""
    SELECT CASE WHEN f.user_id IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change_type, s.user_id,
           {sql.dbl('s.balance')} AS balance, s.status, s.updated_at
    FROM second s LEFT JOIN first_ f USING (user_id) WHERE f IS DISTINCT FROM s
    UNION ALL
    SELECT CASE WHEN s.user_id IS NULL THEN 'delete' ELSE 'update_preimage' END, f.user_id, {sql.dbl('f.balance')},
           f.status, f.updated_at
    FROM first_ f LEFT JOIN second s USING (user_id) WHERE f IS DISTINCT FROM s""", **_SNAPSHOTS))
def snapshot_changes(spark, folder):
    second = cdc.scd1(catalog.changes(spark, folder), KEYS, SEQ, DELETE, exclude=["operation", "event_id"])
    return cdc.snapshot_diff(_state(spark, folder), second, KEYS)


@R.add(sql.query("moves", f"SELECT {_COLUMNS}, status, updated_at FROM second", **_SNAPSHOTS))
def applied_feed(spark, folder):
    before = _state(spark, folder)
    after = cdc.scd1(catalog.changes(spark, folder), KEYS, SEQ, DELETE, exclude=["operation", "event_id"])
    return cdc.apply_feed(before, cdc.snapshot_diff(before, after, KEYS), KEYS)


# --- versions ---------------------------------------------------------------------------------

# Ends of the batches that make versions 1, 2 and 3 of the user table.
VERSION_ENDS = [datetime.datetime(2024, 1, 11), datetime.datetime(2024, 1, 21), datetime.datetime(2100, 1, 1)]


def _versions(spark, folder, keep=None):
    """The user table after three batches of changes, each a version."""
    moves, begin, table = catalog.changes(spark, folder), datetime.datetime(1970, 1, 1), None
    place = scratch_dir(spark, "versions")
    for number, end in enumerate(VERSION_ENDS):
        batch = moves.where((F.col(SEQ) >= F.lit(begin)) & (F.col(SEQ) < F.lit(end)))
        table = incremental.apply_batch(batch, number, place, KEYS, SEQ, DELETE, buckets=8, keep=keep, at=NOW)
        begin = end
    return table


_STATES = {f"v{i + 1}": _state_sql(f"updated_at < TIMESTAMP '{end}'") for i, end in enumerate(VERSION_ENDS)}


def _moved_sql(old: str, new: str, version: str = "") -> str:
    """Changes from one state to another, as the feed shows them."""
    return f"""
    SELECT CASE WHEN f.user_id IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change_type, s.user_id,
           {sql.dbl('s.balance')} AS balance, s.status, s.updated_at{version}
    FROM {new} s LEFT JOIN {old} f USING (user_id) WHERE f IS DISTINCT FROM s
    UNION ALL
    SELECT CASE WHEN s.user_id IS NULL THEN 'delete' ELSE 'update_preimage' END, f.user_id, {sql.dbl('f.balance')},
           f.status, f.updated_at{version}
    FROM {old} f LEFT JOIN {new} s USING (user_id) WHERE f IS DISTINCT FROM s"""


_SHOWN = ["_change_type", "user_id", "balance", "status", SEQ]


@R.add(sql.query("moves", f"""{_moved_sql('v1', 'v2', ', CAST(2 AS BIGINT) AS _commit_version')} UNION ALL
    {_moved_sql('v2', 'v3', ', CAST(3 AS BIGINT)')}""", **_STATES))
def changes_since_version(spark, folder):
    """What versions 2 and 3 changed, from their logs."""
    return _versions(spark, folder).changes(2).select(*_SHOWN, "_commit_version")


@R.add(sql.query("moves", _moved_sql("v1", "v3"), **_STATES))
def net_changes_since_version(spark, folder):
    """What versions 2 and 3 come to together."""
    return cdc.net_changes(_versions(spark, folder).changes(2), KEYS).select(*_SHOWN)


@R.add(sql.query("moves", f"SELECT {_COLUMNS}, status, updated_at FROM v2", **_STATES))
def state_at_version(spark, folder):
    return _versions(spark, folder).state(2).select("user_id", *TRACKED, SEQ)


@R.add(sql.query("moves", f"SELECT {_COLUMNS}, status, updated_at FROM v1", **_STATES))
def state_rewound(spark, folder):
    """Version 1 after its folders are gone: the latest rows, taken back by the log."""
    table = _versions(spark, folder, keep=1)
    return cdc.rewound(table.state(), table.changes(2), KEYS).select("user_id", *TRACKED, SEQ)


@R.add(sql.query("moves", """SELECT event_id, user_id, CASE operation WHEN 'INSERT' THEN 'new_order'
    WHEN 'UPDATE' THEN 'status_change' WHEN 'DELETE' THEN 'cancellation' ELSE 'unknown' END AS change_type,
    operation = 'DELETE' AS is_deleted FROM moves"""))
def classified_changes(spark, folder):
    marked = cdc.classify_changes(catalog.changes(spark, folder))
    return marked.select("event_id", "user_id", "change_type", "is_deleted")


@R.add(sql.query("moves", """SELECT 'users' AS table_name, CAST(user_id AS VARCHAR) AS record_id, operation,
        updated_at AS change_timestamp FROM moves
    UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR),
        CASE o_orderstatus WHEN 'P' THEN 'DELETE' WHEN 'F' THEN 'UPDATE' ELSE 'INSERT' END, o_orderdate FROM orders"""))
def audit_trail(spark, folder):
    orders = catalog.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderstatus") == "P", "DELETE").when(F.col("o_orderstatus") == "F", "UPDATE").otherwise("INSERT")
        .alias("operation"),
        F.col("o_orderdate").alias("updated_at"),
    )
    return cdc.audit_trail({"users": (catalog.changes(spark, folder), "user_id"), "orders": (orders, "order_id")})
