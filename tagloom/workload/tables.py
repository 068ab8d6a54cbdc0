"""The canonical tables, derived from the given ones.

Each is one SQL text that Spark and DuckDB both read, apart from three marks:
``TS'...'`` is a timestamp literal, ``PLUS_US(ts, n)`` adds microseconds and
``PLUS_MIN(ts, n)`` minutes.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tagloom.session import configure

# The given tables read here; naming the schema spares a look into the files.
SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}

# Range and "now" of the events, and "now" of orders and lineitem.
START, END, NOW = "2024-01-01", "2024-01-31", "2024-01-31"
MIDDLE = "2024-01-16"
ORDERS_NOW = "2001-12-01"

VIEWS = {
    "history": """
        SELECT event_type AS tag, ts, CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value,
               CASE WHEN event_id % 50 = 0 THEN 0 ELSE 192 END AS quality
        FROM events""",
    "discrete": """
        SELECT event_type AS tag, ts,
               CASE WHEN event_id % 50 = 0 THEN NULL WHEN value >= 50 THEN 1.0E0 ELSE 0.0E0 END AS value,
               CASE WHEN event_id % 50 = 0 THEN 0 ELSE 192 END AS quality
        FROM events""",
    "user_history": """
        SELECT concat('', user_id) AS tag, ts,
               CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value,
               CASE WHEN event_id % 50 = 0 THEN 0 ELSE 192 END AS quality
        FROM events""",
    "versioned": """
        SELECT concat('P', l_partkey) AS tag, l_shipdate AS ts, max(l_quantity) AS value,
               l_orderkey * 10 + l_linenumber AS version, max(l_extendedprice) AS price
        FROM lineitem GROUP BY l_partkey, l_shipdate, l_orderkey, l_linenumber""",
    "queued_request": """
        SELECT DISTINCT l_suppkey AS entity_key,
               PLUS_US(l_shipdate, 18000001000) AS mod_start_utc,
               PLUS_MIN(l_shipdate, 1740) AS mod_end_utc
        FROM lineitem WHERE l_quantity >= 25""",
    "order_history": """
        SELECT concat('', o_custkey) AS tag, PLUS_US(o_orderdate, o_orderkey) AS ts,
               CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS value,
               CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 192 END AS quality
        FROM orders""",
    "customer_tag": """
        SELECT concat('', c_custkey) AS tag, min(c_name) AS description,
               CAST(min(c_nationkey % 5) AS INT) AS io_server_key,
               min(o_orderdate) AS date_created
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey
        GROUP BY c_custkey""",
    "tag_history": """
        SELECT concat('', o_custkey) AS tag, o_orderpriority AS description, o_orderstatus AS unit,
               floor(o_totalprice / 50000) AS min_eu, floor(o_totalprice / 20000) AS max_eu,
               o_orderdate AS date_created
        FROM orders""",
    "ns": """
        SELECT 1 AS name_key, CAST(NULL AS INT) AS parent_key, 'Public' AS name, 1 AS type
        FROM region WHERE r_regionkey = 0
        UNION ALL
        SELECT r_regionkey + 10, 1, r_name, CASE WHEN r_name = 'AFRICA' THEN 1000000 ELSE 2 END
        FROM region
        UNION ALL
        SELECT n_nationkey + 100, n_regionkey + 10, n_name, 3 FROM nation""",
    "group_tag": "SELECT c_nationkey + 100 AS name_key, c_custkey AS domain_tag_key FROM customer",
    "tag_ref": "SELECT c_custkey AS domain_tag_key, concat('', c_custkey) AS tag FROM customer",
    "part_tag": """
        SELECT concat('P', p_partkey) AS tag, p_name AS description, p_size % 8 AS tag_type,
               p_size % 4 AS acquisition_type, p_size % 3 AS io_server_key, p_size % 5 AS raw_type,
               CASE p_brand WHEN 'Brand#13' THEN 'ReplicationService' WHEN 'Brand#7' THEN NULL
                            ELSE p_brand END AS created_by,
               PLUS_MIN(TS'2000-01-01 00:00:00', p_partkey) AS date_created
        FROM part""",
    "tag_description": """
        SELECT concat('P', p_partkey) AS tag, upper(p_name) AS local_desc, p_size % 4 AS lang_id
        FROM part WHERE p_type <> 'ECONOMY'""",
    "new_description": """
        SELECT concat('P', p_partkey) AS tag, p_brand AS local_desc,
               CASE WHEN p_type = 'SMALL' THEN p_size % 4 ELSE (p_size + 1) % 4 END AS lang_id
        FROM part""",
    "attributes": """
        SELECT concat('P', l_partkey) AS attribute_name, min(l_suppkey) AS object_key
        FROM lineitem GROUP BY l_partkey""",
    "cheap_tag": "SELECT concat('P', p_partkey) AS tag FROM part WHERE p_type <> 'LARGE'",
    "objects": """
        SELECT s_suppkey AS object_key, concat('NATION_', s_suppkey) AS object_name,
               CASE WHEN s_suppkey = 0 THEN NULL ELSE s_nationkey END AS parent_key
        FROM supplier""",
    "small_attributes": """
        SELECT min(p_name) AS attribute_name, CAST(p_size AS BIGINT) AS object_key
        FROM part GROUP BY p_size""",
    "pending": """
        SELECT concat('NATION_', s_suppkey) AS object_name FROM supplier WHERE s_acctbal < 2000""",
    "sessions": """
        SELECT concat('node', user_id % 10) AS node, concat('user', user_id) AS user_name,
               event_type AS application, concat('mac', user_id % 7) AS mac,
               concat('10.0.0.', user_id % 100) AS ip,
               CASE event_type WHEN 'view' THEN 'master' WHEN 'error' THEN NULL ELSE 'plant' END
                 AS database,
               CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN ''
                    ELSE concat('', user_id) END AS host_process,
               concat(user_id, '-', event_type) AS conn_id, CAST(user_id % 1000 AS INT) AS pid,
               min(ts) AS first_ts, max(ts) AS last_ts,
               CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cpu,
               count(*) AS io, max(event_id) AS mem
        FROM events GROUP BY user_id, event_type""",
    "tracked": """
        SELECT concat('node', user_id % 10) AS node, concat('user', user_id) AS user_name,
               concat(user_id, '-', event_type, CASE event_type WHEN 'purchase' THEN '-old' ELSE '' END)
                 AS conn_id,
               CAST(user_id % 1000 + CASE event_type WHEN 'click' THEN 1 ELSE 0 END AS INT) AS pid,
               concat('mac', user_id % 7) AS mac, concat('10.0.0.', user_id % 100) AS ip,
               max(ts) AS last_ts, min(ts) AS first_ts, event_type AS application,
               CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cpu,
               max(event_id) AS mem, count(*) AS io
        FROM events WHERE ts < TS'2024-01-16 00:00:00' GROUP BY user_id, event_type""",
    "usage_summary": """
        SELECT 'User' AS usage_type, concat('user', user_id) AS name, min(ts) AS first_ts,
               max(ts) AS last_ts, 3 AS active_days, count(*) AS usage
        FROM events WHERE ts < TS'2024-01-06 00:00:00' GROUP BY user_id
        UNION ALL
        SELECT 'Application', event_type, min(ts), max(ts), 5, count(*)
        FROM events WHERE ts < TS'2024-01-06 00:00:00' GROUP BY event_type""",
    "entity": """
        SELECT DISTINCT l_partkey * 100 + s_nationkey AS entity_key, concat('P', l_partkey) AS source_tag,
               s_nationkey AS group_key, n_regionkey AS server_key
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
    "supplier_entity": """
        SELECT s_suppkey AS entity_key, s_name AS source_tag, s_nationkey AS group_key,
               n_regionkey AS server_key
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "replication_group": """
        SELECT n_nationkey AS group_key, n_name AS name, n_nationkey % 4 + 1 AS type_key,
               n_regionkey AS server_key, n_nationkey % 5 AS schedule_key
        FROM nation""",
    "replication_server": """
        SELECT r_regionkey AS server_key,
               CASE r_name WHEN 'AMERICA' THEN 'Local Replication' ELSE r_name END AS name
        FROM region""",
    "schedule": """
        SELECT r_regionkey AS schedule_key, r_regionkey * 5 + 1 AS period,
               CASE r_name WHEN 'AFRICA' THEN 'Minute' WHEN 'AMERICA' THEN 'Hour'
                           WHEN 'ASIA' THEN 'Day' ELSE 'Week' END AS unit
        FROM region WHERE r_name <> 'EUROPE'""",
    "queue": """
        SELECT l_orderkey * 10 + l_linenumber AS entity_key, concat('P', l_partkey) AS source_tag,
               CAST(l_suppkey % 5 AS INT) AS server_key, l_linenumber AS request_version,
               least(o_orderdate, l_shipdate) AS mod_start_utc,
               greatest(o_orderdate, l_shipdate) AS mod_end_utc,
               PLUS_MIN(l_shipdate, l_linenumber) AS earliest_exec_utc, 0 AS execute_state
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
    "annotation": """
        SELECT concat(CASE o_orderpriority
                 WHEN '1-URGENT' THEN 'at noon Beginning backfill for '
                 WHEN '2-HIGH' THEN 'Added ' ELSE 'note on ' END,
                 o_orderkey,
                 CASE o_orderpriority WHEN '2-HIGH' THEN ' items from ' ELSE ' tags at ' END,
                 CASE o_orderstatus WHEN 'F' THEN 'ASIA' WHEN 'O' THEN 'EUROPE' ELSE 'AFRICA' END)
                 AS content,
               o_custkey AS user_key, o_orderdate AS date_created,
               concat('SysReplicationSyncQueueItems', o_orderkey % 5) AS tag
        FROM orders""",
    "users": """
        SELECT c_custkey AS user_key, c_name AS user_name FROM customer
        WHERE c_mktsegment <> 'BUILDING'""",
    "history_block": """
        SELECT DISTINCT l_shipdate AS from_ts, PLUS_MIN(l_shipdate, 1440) AS to_ts,
               -300 AS tz_offset_min
        FROM lineitem
        UNION ALL
        SELECT DISTINCT l_shipdate, PLUS_MIN(l_shipdate, 60), -300 FROM lineitem
        WHERE l_returnflag = 'R'""",
    "block_listing": """
        SELECT concat(CASE l_returnflag WHEN 'R' THEN 'rr:' ELSE '/' END, l_returnflag) AS path,
               concat('A', year(l_shipdate), lpad(concat('', month(l_shipdate)), 2, '0'),
                      lpad(concat('', day(l_shipdate)), 2, '0'), '_00', l_linenumber) AS block_name,
               max(l_quantity) > 20 AS has_status
        FROM lineitem GROUP BY l_returnflag, l_shipdate, l_linenumber""",
    "storage_location": """
        SELECT DISTINCT concat(CASE l_returnflag WHEN 'R' THEN 'rr:' ELSE '/' END, l_returnflag) AS path,
               CASE l_returnflag WHEN 'A' THEN 1 ELSE 2 END AS time_unit_id,
               CASE l_returnflag WHEN 'A' THEN 5 ELSE 1 END AS block_duration, 1 AS storage_type
        FROM lineitem""",
    "chart": """
        SELECT o_orderkey AS chart_key, o_orderpriority AS name, concat('u', o_orderkey) AS url,
               o_shippriority AS chart_type, o_custkey AS owner_key
        FROM (SELECT *, o_orderkey % 3 AS o_shippriority FROM orders) o""",
    "chart_keyword": "SELECT o_orderkey AS chart_key, o_orderstatus AS keyword FROM orders",
    "chart_tag": """
        SELECT l_orderkey AS chart_key, concat(l_partkey, '.', l_suppkey) AS fqn,
               CASE l_returnflag WHEN 'A' THEN 1 ELSE 0 END AS selected, l_linestatus AS color,
               CASE l_linestatus WHEN 'O' THEN 1 ELSE 0 END AS active_group,
               l_linenumber AS layout_index,
               CASE l_returnflag WHEN 'R' THEN NULL ELSE l_suppkey END AS selected_order
        FROM lineitem""",
    "chart_property": """
        SELECT o_orderkey AS chart_key, 'priority' AS property, o_orderpriority AS value FROM orders""",
    "dashboard": """
        SELECT l_orderkey AS chart_key, l_partkey AS member_key, l_linenumber AS position
        FROM lineitem""",
    "trend_item": """
        SELECT concat('trend', l_orderkey) AS file,
               CASE l_returnflag WHEN 'A' THEN 'SRV1' WHEN 'N' THEN NULL ELSE 'srv2' END AS server,
               concat('P', l_partkey) AS tag
        FROM lineitem""",
}

_NAMES = re.compile(r"\b(" + "|".join([*SOURCES, *VIEWS]) + r")\b")


def duck(text: str) -> str:
    """A text as DuckDB reads it."""
    text = text.replace("TS'", "TIMESTAMP'")
    text = re.sub(r"PLUS_US\(((?:[^(),]|'[^']*')+), ([^()]+?)\)", r"(\1 + to_microseconds(\2))", text)
    return re.sub(
        r"PLUS_MIN\(((?:[^(),]|'[^']*')+), ([^()]+?)\)",
        r"(\1 + to_microseconds(CAST(\2 AS BIGINT) * 60000000))",
        text,
    )


def _spark(text: str) -> str:
    text = text.replace("TS'", "TIMESTAMP_NTZ'")
    for mark, factor in (("PLUS_US", ""), ("PLUS_MIN", " * 60000000")):
        text = re.sub(
            mark + r"\(((?:[^(),]|'[^']*')+), ([^()]+?)\)",
            r"CAST(timestamp_micros(unix_micros(CAST(\1 AS TIMESTAMP)) + CAST(\2 AS BIGINT)"
            + factor
            + r") AS TIMESTAMP_NTZ)",
            text,
        )
    return text


class Tables:
    """The canonical tables as DataFrames: ``Tables(spark, sf_dir).history``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in SOURCES:
            return self._once(name, lambda: self._source(name))
        if name in VIEWS:
            return self._once(name, lambda: self._view(name))
        raise AttributeError(name)

    def _once(self, name: str, make) -> DataFrame:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def _source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def _view(self, name: str) -> DataFrame:
        text = _spark(VIEWS[name])
        used = [s for s in SOURCES if re.search(rf"\b(FROM|JOIN) {s}\b", text)]
        marked = reduce(
            lambda t, s: re.sub(rf"\b(FROM|JOIN) {s}\b", rf"\1 {{{s}}} AS {s}", t), used, text
        )
        return self.spark.sql(marked, **{s: getattr(self, s) for s in used})


def with_views(body: str, recursive: bool = False) -> str:
    """DuckDB SQL: ``body`` preceded by the canonical tables it names.

    ``body`` is a query, or further CTEs and a query when it starts with
    ``WITH``.
    """
    named = [v for v in VIEWS if re.search(rf"\b{v}\b", body)]
    ctes = ", ".join(f"{v} AS ({VIEWS[v]})" for v in named)
    body = body.strip()
    if body.upper().startswith("WITH"):
        body = body[4:].strip()
        joiner = ", " if ctes else ""
    else:
        joiner = " "
    head = ("WITH RECURSIVE " if recursive else "WITH ") if (ctes or joiner == "") else ""
    return duck(f"{head}{ctes}{joiner}{body}")


def over(df: DataFrame, view: str, source: str) -> DataFrame:
    """A canonical table that needs one source, derived from ``df`` instead."""
    text = re.sub(rf"\bFROM {source}\b", f"FROM {{{source}}} AS {source}", _spark(VIEWS[view]))
    return df.sparkSession.sql(text, **{source: df})
