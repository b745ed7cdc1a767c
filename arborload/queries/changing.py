"""Key propagation, upserts, deletes, merges and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborload.operators import changes, links, reports
from arborload.queries import fixtures as X
from arborload.queries.registry import query
from arborload.queries.scans import DELETE_KEYS_SQL
from arborload.sources.scratch import materialise

# The linked star tables in SQL, as a template over the names of the base tables.
LINKED_SQL = """
    {p}customer AS (
        SELECT c.*, CASE WHEN c_custkey IN (SELECT o_custkey FROM {orders})
                    THEN md5(concat_ws('|', 'orders', md5(concat_ws('|', 'customer', c_custkey)))) END AS orders_fk,
               CASE WHEN c_custkey IN (SELECT user_id FROM {events})
                    THEN md5(concat_ws('|', 'events', md5(concat_ws('|', 'customer', c_custkey)))) END AS events_fk,
               md5(concat_ws('|', 'customer', c_custkey)) AS root_key
        FROM {customer} c
    ),
    {p}orders AS (
        SELECT md5(concat_ws('|', 'orders', md5(concat_ws('|', 'customer', o_custkey)))) AS customer_id, o.*,
               CASE WHEN o_orderkey IN (SELECT l_orderkey FROM {lineitem})
                    THEN md5(concat_ws('|', 'lineitem', md5(concat_ws('|', 'orders', o_orderkey)))) END AS lineitem_fk,
               md5(concat_ws('|', 'customer', o_custkey)) AS root_key
        FROM {orders} o
    ),
    {p}lineitem AS (
        SELECT md5(concat_ws('|', 'lineitem', md5(concat_ws('|', 'orders', l_orderkey)))) AS orders_id, l.*,
               md5(concat_ws('|', 'part',
                   md5(concat_ws('|', 'lineitem', l_orderkey, l_linenumber, l_partkey, l_suppkey)))) AS part_fk,
               md5(concat_ws('|', 'customer', o_custkey)) AS root_key
        FROM {lineitem} l JOIN (SELECT o_orderkey, o_custkey FROM {orders}) ON l_orderkey = o_orderkey
    ),
    {p}events AS (
        SELECT md5(concat_ws('|', 'events', md5(concat_ws('|', 'customer', user_id)))) AS customer_id, e.*,
               md5(concat_ws('|', 'customer', user_id)) AS root_key
        FROM {events} e
    )"""
TARGET_SQL = LINKED_SQL.format(
    p="t_", customer="customer", orders="orders", lineitem="lineitem", events="events"
)
BASE_STAGE_SQL = f"""
    b_customer AS (
        SELECT * REPLACE (c_name || '*' AS c_name) FROM customer WHERE c_mktsegment = '{X.CHANGED}'
        UNION ALL
        SELECT * REPLACE (c_custkey + {X.NEW_CUSTOMER} AS c_custkey) FROM customer
        WHERE c_mktsegment = '{X.COPIED}'
    ),
    b_orders AS (
        SELECT o.* FROM orders o JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = '{X.CHANGED}'
        UNION ALL
        SELECT o.* REPLACE (o_orderkey + {X.NEW_ORDER} AS o_orderkey, o_custkey + {X.NEW_CUSTOMER} AS o_custkey)
        FROM orders o JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = '{X.COPIED}'
    ),
    b_lineitem AS (
        SELECT l.* FROM lineitem l JOIN b_orders ON l_orderkey = o_orderkey
        UNION ALL
        SELECT l.* REPLACE (l_orderkey + {X.NEW_ORDER} AS l_orderkey)
        FROM lineitem l JOIN b_orders ON l_orderkey + {X.NEW_ORDER} = o_orderkey
    ),
    b_events AS (
        SELECT e.* FROM events e JOIN customer ON user_id = c_custkey WHERE c_mktsegment = '{X.CHANGED}'
        UNION ALL
        SELECT e.* REPLACE (user_id + {X.NEW_CUSTOMER} AS user_id)
        FROM events e JOIN customer ON user_id = c_custkey WHERE c_mktsegment = '{X.COPIED}'
    )"""
STAGE_SQL = (
    BASE_STAGE_SQL
    + ","
    + LINKED_SQL.format(
        p="s_", customer="b_customer", orders="b_orders", lineitem="b_lineitem", events="b_events"
    )
)
KEYS_SQL = f"k AS ({DELETE_KEYS_SQL})"
AFFECTED = {
    "keys": "SELECT pncid FROM k",
    "stage": "SELECT c_custkey FROM b_customer",
}
# Base-table condition that says a row belongs to one of the given customers.
OWNED = {
    "customer": "c_custkey IN ({keys})",
    "orders": "o_custkey IN ({keys})",
    "lineitem": "l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN ({keys}))",
    "events": "user_id IN ({keys})",
}


def _owned(table: str, keys: str) -> str:
    return OWNED[table].format(keys=f"SELECT * FROM ({AFFECTED[keys]}) q(v) WHERE v IS NOT NULL")


def _delete_keys(spark: SparkSession, sf: str) -> DataFrame:
    return X.delete_feed(spark, sf).select(F.col("body.PNCID").alias("c_custkey"))


# -- key propagation ---------------------------------------------------------


@query(
    "keys_root",
    f"""WITH {TARGET_SQL}, {STAGE_SQL}
    SELECT c_custkey, orders_fk, events_fk FROM t_customer WHERE {_owned("customer", "stage")}""",
)
def keys_root(spark: SparkSession, sf: str) -> DataFrame:
    targets, stage = X.star_targets(spark, sf, rooted=False), X.star_stage(spark, sf)
    return links.root_links(targets["customer"], stage["customer"], X.STAR)


@query(
    "keys_root_delete",
    f"""WITH {TARGET_SQL}, {KEYS_SQL}
    SELECT c_custkey, orders_fk, events_fk FROM t_customer WHERE {_owned("customer", "keys")}""",
)
def keys_root_delete(spark: SparkSession, sf: str) -> DataFrame:
    targets = X.star_targets(spark, sf, rooted=False)
    return links.root_links(targets["customer"], _delete_keys(spark, sf), X.STAR)


def _keep(spark: SparkSession) -> links.Keep:
    """Write every level of links once."""
    folder = X.scratch_dir(spark, "links")
    return lambda frame, table: materialise(frame, folder, table)[0]


def _propagated(spark: SparkSession, sf: str, table: str, keep: links.Keep | None = None) -> DataFrame:
    """Links of one table: a short walk has one consumer per level, so no level need be written."""
    targets = X.star_targets(spark, sf, rooted=False)
    return links.propagate(targets, _delete_keys(spark, sf), X.STAR, keep)[table]


@query(
    "keys_child",
    f"""WITH {TARGET_SQL}, {KEYS_SQL}
    SELECT lineitem_fk FROM t_orders WHERE customer_id IN (
        SELECT orders_fk FROM t_customer WHERE {_owned("customer", "keys")})""",
)
def keys_child(spark: SparkSession, sf: str) -> DataFrame:
    return _propagated(spark, sf, "orders")


@query(
    "keys_second_branch",
    f"""WITH {TARGET_SQL}, {KEYS_SQL}
    SELECT event_id, customer_id FROM t_events WHERE customer_id IN (
        SELECT events_fk FROM t_customer WHERE {_owned("customer", "keys")})""",
)
def keys_second_branch(spark: SparkSession, sf: str) -> DataFrame:
    """The second branch has no links of its own: its rows are found by the root's links."""
    targets = X.star_targets(spark, sf, rooted=False)
    root = links.root_links(targets["customer"], _delete_keys(spark, sf), X.STAR)
    keys, back = links.table_keys({"customer": root}, X.STAR, "events")
    return links.matched(targets["events"], keys, back).select("event_id", back)


@query(
    "keys_grandchild",
    f"""WITH {TARGET_SQL}, {KEYS_SQL}
    SELECT DISTINCT part_fk FROM t_lineitem WHERE orders_id IN (
        SELECT lineitem_fk FROM t_orders WHERE customer_id IN (
            SELECT orders_fk FROM t_customer WHERE {_owned("customer", "keys")}))""",
)
def keys_grandchild(spark: SparkSession, sf: str) -> DataFrame:
    return _propagated(spark, sf, "lineitem")


@query(
    "keys_deep",
    f"""WITH {TARGET_SQL}, {KEYS_SQL}
    SELECT DISTINCT md5(concat_ws('|', 'supplier',
        md5(concat_ws('|', 'lineitem', l_orderkey, l_linenumber, l_partkey, l_suppkey)))) AS supplier_fk
    FROM t_lineitem JOIN part ON l_partkey = p_partkey
    WHERE {_owned("lineitem", "keys")}""",
)
def keys_deep(spark: SparkSession, sf: str) -> DataFrame:
    return _propagated(spark, sf, "part", _keep(spark))


@query(
    "unmatched_keys",
    f"""WITH {KEYS_SQL} SELECT CAST(pncid AS VARCHAR) AS c_custkey FROM k
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = pncid)""",
)
def unmatched_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = links.unmatched_keys(_delete_keys(spark, sf), X.table(spark, sf, "customer"), "c_custkey")
    return keys.select(F.col("c_custkey").cast("string"))


# -- single tables -----------------------------------------------------------


@query(
    "merge_by_key",
    f"""WITH {BASE_STAGE_SQL}
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM b_customer)
    UNION ALL (SELECT * FROM b_customer UNION ALL SELECT * FROM b_customer)""",
)
def merge_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated stage rows stay; a column the target lacks is dropped by name."""
    target = X.table(spark, sf, "customer")
    stage = X.star_stage(spark, sf)["customer"].select(*target.columns, F.lit("f").alias("input_filename"))
    return changes.merge_by_key(target, stage, "c_custkey", drop=("input_filename",))


@query(
    "upsert_root",
    f"""WITH {BASE_STAGE_SQL}
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM b_customer)
    UNION ALL SELECT DISTINCT * FROM b_customer""",
)
def upsert_root(spark: SparkSession, sf: str) -> DataFrame:
    target = X.table(spark, sf, "customer")
    stage = X.star_stage(spark, sf)["customer"].select(*target.columns)
    return changes.upsert_by_key(target, stage, stage, "c_custkey")


@query(
    "delete_root",
    f"""WITH {KEYS_SQL} SELECT * FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM k WHERE pncid = c_custkey)""",
)
def delete_root(spark: SparkSession, sf: str) -> DataFrame:
    return changes.delete_by_key(X.table(spark, sf, "customer"), _delete_keys(spark, sf), "c_custkey")


# -- trees -------------------------------------------------------------------


def _upserted(spark: SparkSession, sf: str, table: str) -> DataFrame:
    targets, stage = X.star_targets(spark, sf), X.star_stage(spark, sf)
    return changes.upsert_tree(targets, stage, X.ROOTED)[table]


def _upsert_sql(table: str) -> str:
    return f"""WITH {TARGET_SQL}, {STAGE_SQL}
    SELECT * FROM t_{table} WHERE NOT ({_owned(table, "stage")})
    UNION ALL SELECT DISTINCT * FROM s_{table}"""


@query("upsert_tree_customer", _upsert_sql("customer"))
def upsert_tree_customer(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, "customer")


@query("upsert_tree_orders", _upsert_sql("orders"))
def upsert_tree_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, "orders")


@query("upsert_tree_lineitem", _upsert_sql("lineitem"))
def upsert_tree_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, "lineitem")


@query("upsert_tree_events", _upsert_sql("events"))
def upsert_tree_events(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, "events")


def _deleted(spark: SparkSession, sf: str, table: str, by: str) -> DataFrame:
    targets = X.star_targets(spark, sf)
    # One table is asked for, so every level of links has one consumer and none is written.
    return changes.delete_tree(targets, _delete_keys(spark, sf), X.ROOTED, by)[table]


def _delete_sql(table: str) -> str:
    return f"WITH {TARGET_SQL}, {KEYS_SQL} SELECT * FROM t_{table} WHERE NOT ({_owned(table, 'keys')})"


@query("delete_tree_orders", _delete_sql("orders"))
def delete_tree_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _deleted(spark, sf, "orders", "root_key")


@query("delete_tree_lineitem", _delete_sql("lineitem"))
def delete_tree_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return _deleted(spark, sf, "lineitem", "root_key")


@query("delete_tree_events", _delete_sql("events"))
def delete_tree_events(spark: SparkSession, sf: str) -> DataFrame:
    return _deleted(spark, sf, "events", "root_key")


@query("delete_links_lineitem", _delete_sql("lineitem"))
def delete_links_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows as by root key, found by walking down the links."""
    return _deleted(spark, sf, "lineitem", "links")


@query(
    "delete_links_deep",
    f"""WITH {TARGET_SQL}, {KEYS_SQL}
    SELECT md5(concat_ws('|', 'supplier',
               md5(concat_ws('|', 'lineitem', l_orderkey, l_linenumber, l_partkey, l_suppkey)))) AS part_id,
           supplier.*
    FROM t_lineitem JOIN supplier ON l_suppkey = s_suppkey
    WHERE NOT ({_owned("lineitem", "keys")})""",
)
def delete_links_deep(spark: SparkSession, sf: str) -> DataFrame:
    """Fifth level: the supplier rows below the line items of deleted customers."""
    targets = X.star_targets(spark, sf, rooted=False)
    return changes.delete_tree(targets, _delete_keys(spark, sf), X.STAR, "links", _keep(spark))["supplier"]


# -- reports -----------------------------------------------------------------

REPORT_SQL = """
    r_customer AS (SELECT * FROM t_customer WHERE {customer}),
    r_orders AS (SELECT * FROM t_orders WHERE {orders}),
    r_lineitem AS (SELECT * FROM t_lineitem WHERE {lineitem})"""


def _report_sql(keys: str) -> str:
    return REPORT_SQL.format(**{t: _owned(t, keys) for t in ("customer", "orders", "lineitem")})


@query(
    "report_updates",
    f"""WITH {TARGET_SQL}, {STAGE_SQL}, {_report_sql("stage")}
    SELECT 'customer' AS table, count(c_custkey) AS update_count FROM r_customer
    UNION ALL SELECT 'orders', count(orders_fk) FROM r_customer
    UNION ALL SELECT 'events', count(events_fk) FROM r_customer
    UNION ALL SELECT 'lineitem', count(lineitem_fk) FROM r_orders
    UNION ALL SELECT 'part', count(DISTINCT part_fk) FROM r_lineitem
    UNION ALL SELECT 'supplier', count(DISTINCT part_fk) FROM r_lineitem""",
)
def report_updates(spark: SparkSession, sf: str) -> DataFrame:
    targets, stage = X.star_targets(spark, sf, rooted=False), X.star_stage(spark, sf)
    return reports.update_counts(links.propagate(targets, stage["customer"], X.STAR, _keep(spark)), X.STAR)


@query(
    "report_deletes",
    f"""WITH {TARGET_SQL}, {KEYS_SQL}, {_report_sql("keys")}
    SELECT 'customer' AS table, count(*) AS delete_count FROM r_customer
    UNION ALL SELECT 'orders', count(*) FROM r_customer
    UNION ALL SELECT 'events', count(*) FROM r_customer
    UNION ALL SELECT 'lineitem', count(*) FROM r_orders
    UNION ALL SELECT 'part', count(DISTINCT part_fk) FROM r_lineitem
    UNION ALL SELECT 'supplier', count(DISTINCT part_fk) FROM r_lineitem""",
)
def report_deletes(spark: SparkSession, sf: str) -> DataFrame:
    targets = X.star_targets(spark, sf, rooted=False)
    return reports.delete_counts(links.propagate(targets, _delete_keys(spark, sf), X.STAR, _keep(spark)), X.STAR)
