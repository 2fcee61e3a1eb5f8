"""DuckDB SQL for the logical inputs of ``pipewatch.sources.derived`` -
the same projections of the driver views, used by the oracle queries."""

# Each constant is the body of a CTE.

EVENTS_LOG = """
    SELECT 0 AS "partition", event_id AS "offset",
           ts + to_seconds((event_id * 7919) % 3600) AS "timestamp",
           event_id, user_id, ts
    FROM events
"""

# key and event-time epoch of the good rows of events_log (id % 97 = 0 rejected)
EVENTS_EXTRACTED = """
    SELECT 0 AS "partition", event_id AS "offset", CAST(user_id AS VARCHAR) AS "key",
           CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS ts
    FROM events WHERE event_id % 97 <> 0
"""

ORDERS_EXTRACTED = """
    SELECT 0 AS "partition", o_orderkey AS "offset", CAST(o_custkey AS VARCHAR) AS "key",
           CAST(epoch(o_orderdate) AS BIGINT) AS ts
    FROM orders
"""

LANDED_EVENTS = """
    SELECT 0 AS "partition", event_id AS "offset",
           CASE WHEN event_id % 997 = 5 THEN CAST(user_id AS VARCHAR) || 'x' ELSE CAST(user_id AS VARCHAR) END AS "key",
           CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS ts
    FROM events WHERE event_id % 1009 <> 7
"""

TOPIC_NAMES = """
    SELECT CASE WHEN p_partkey % 10 = 0 THEN '__' || b WHEN p_partkey % 10 = 1 THEN '--' || b ELSE b END AS name
    FROM (SELECT p_partkey, lower(p_type) || '.' || replace(p_name, ' ', '-') || '-' || CAST(p_partkey AS VARCHAR) AS b
          FROM part)
"""

TASKS = """
    SELECT 'task-' || CAST(s_suppkey AS VARCHAR) AS task_id,
           'arn:task:' || CAST(s_suppkey AS VARCHAR) AS arn,
           'arn:ep:' || CAST(s_nationkey AS VARCHAR) AS source_arn,
           'arn:ep:' || CAST((s_nationkey + 7) % 25 AS VARCHAR) AS target_arn,
           CASE s_suppkey % 3 WHEN 0 THEN 'running' WHEN 1 THEN 'stopped' ELSE 'failed' END AS status,
           CASE WHEN s_suppkey % 2 = 0 THEN 'cdc' ELSE 'full-load-and-cdc' END AS migration_type,
           'arn:ri:' || CAST(s_suppkey % 4 AS VARCHAR) AS instance_arn,
           '{"TargetMetadata":{"ParallelLoadThreads":' || CAST(s_suppkey % 8 AS VARCHAR) || '}}' AS settings,
           '{"rules":[{"rule-id":"' || CAST(s_suppkey AS VARCHAR) || '"}]}' AS mappings,
           TIMESTAMP '2024-01-01 00:00:00' + to_hours(s_suppkey) AS created,
           TIMESTAMP '2024-01-01 00:00:00' + to_hours(s_suppkey) + INTERVAL 1 DAY AS started
    FROM supplier
"""

ENDPOINTS = """
    SELECT 'arn:ep:' || CAST(n_nationkey AS VARCHAR) AS arn,
           lower(n_name) || '-ep' AS id,
           CASE WHEN n_nationkey % 2 = 0 THEN 'SOURCE' ELSE 'TARGET' END AS type,
           CASE n_regionkey WHEN 0 THEN 'mysql' WHEN 1 THEN 'postgres' WHEN 2 THEN 'aurora'
                WHEN 3 THEN 'sqlserver' ELSE 'mariadb' END AS engine,
           upper(CASE n_regionkey WHEN 0 THEN 'mysql' WHEN 1 THEN 'postgres' WHEN 2 THEN 'aurora'
                WHEN 3 THEN 'sqlserver' ELSE 'mariadb' END) AS engine_name,
           'active' AS status,
           CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE lower(n_name) || '_db' END AS database,
           'db' || CAST(n_regionkey AS VARCHAR) || '.example' AS server
    FROM nation
"""

TABLE_STATS = """
    SELECT 'arn:task:' || CAST((l_suppkey // 2) * 2 AS VARCHAR) AS task_arn,
           'sch' || CAST(l_partkey % 3 AS VARCHAR) AS schema,
           CASE l_linenumber % 4
                WHEN 0 THEN 'order_line_' || CAST(year(l_shipdate) AS VARCHAR)
                WHEN 1 THEN 'order_line_p' || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') || '_'
                            || CAST(year(l_shipdate) AS VARCHAR)
                WHEN 2 THEN 'returns_' || lower(l_returnflag) || '_default'
                ELSE 'lineitem2_' || CAST(l_orderkey % 7 AS VARCHAR) END AS "table",
           CAST(sum(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS inserts,
           CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS updates,
           CAST(sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS deletes,
           min(l_orderkey * 10 + l_linenumber) AS seen_no
    FROM lineitem GROUP BY 1, 2, 3
"""

PHYSICAL_NAMES = """
    SELECT CASE p_partkey % 8
        WHEN 0 THEN b || '_' || CAST(1990 + p_size AS VARCHAR)
        WHEN 1 THEN b || '_p' || CAST(p_size AS VARCHAR) || '_default'
        WHEN 2 THEN b || '_default_p' || CAST(p_size % 100 AS VARCHAR)
        WHEN 3 THEN b || '_' || CAST(200000 + p_partkey % 1000 AS VARCHAR)
        WHEN 4 THEN b || '_p' || lpad(CAST(p_size AS VARCHAR), 3, '0')
        WHEN 5 THEN b || '_' || CAST(2020 + p_size % 5 AS VARCHAR) || '_' || lpad(CAST(p_size % 12 + 1 AS VARCHAR), 2, '0')
                    || '_' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0')
        WHEN 6 THEN upper(b) || '_2020'
        ELSE b || '_' || CAST(p_partkey AS VARCHAR) END AS "table"
    FROM (SELECT *, replace(p_name, ' ', '_') AS b FROM part)
"""

SNAPSHOTS = """
    SELECT 'cluster-' || CAST(o_custkey % 5 AS VARCHAR) AS cluster,
           CASE WHEN o_orderkey % 7 = 0 THEN 'manual-' || CAST(o_orderkey AS VARCHAR)
                ELSE 'rs:cluster-' || CAST(o_custkey % 5 AS VARCHAR) || '-'
                     || strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d-%H-%M-%S') || '-'
                     || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') END AS identifier,
           o_orderdate + to_seconds(o_orderkey % 86400) AS create_time
    FROM orders
"""

CLUSTERS = """
    SELECT CASE WHEN c_custkey % 4 = 0
                THEN 'bi-snapshot-' || lpad(CAST(19900000 + c_custkey AS VARCHAR), 8, '0') || 't'
                     || lpad(CAST(c_custkey % 240000 AS VARCHAR), 6, '0')
                ELSE 'cluster-' || lower(c_mktsegment) || '-' || CAST(c_custkey AS VARCHAR) END AS identifier
    FROM customer
"""

CATALOGUE = """
    SELECT 'dw' AS database,
           ['ods', 'stg', 'dim', 'dwd', 'dws', 'met', 'ads', 'public', 'temp'][p_size % 9 + 1] AS schema,
           CASE WHEN p_size % 11 = 0 THEN 'pg_' ELSE '' END || replace(p_name, ' ', '_') || '_'
               || CAST(p_partkey AS VARCHAR) AS "table",
           CASE WHEN p_partkey % 5 = 0 THEN 'VIEW' ELSE 'TABLE' END AS type
    FROM part
"""

QUERY_HISTORY = """
    SELECT event_id AS query_id,
           CAST(CASE WHEN event_id % 4 = 0 THEN 102 WHEN event_id % 4 = 1 THEN 109 ELSE user_id END AS INTEGER) AS user_id,
           ts AS start_time,
           CAST(trunc(value * 60000000) AS BIGINT) AS elapsed_us,
           CASE WHEN event_type IN ('click', 'view')
                THEN '-- MBI:' || event_type || CAST(user_id AS VARCHAR) || ' query: q' || CAST(event_id AS VARCHAR)
                     || ' select * from t'
                WHEN event_type = 'error' THEN repeat('x', 70) || ' -- MBI:late'
                ELSE 'select 1 /* ' || event_type || ' */' END AS query_text
    FROM events
"""

TABLE_INFO = """
    SELECT 's' || CAST(p_size % 4 AS VARCHAR) AS schema,
           replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS VARCHAR) AS "table",
           CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE round(p_retailprice % 97, 0) END AS benefit
    FROM part
"""

SLOTS = """
    SELECT CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN ''
                ELSE 'db' || CAST(user_id % 7 AS VARCHAR) END AS database,
           event_id % 2 = 0 AS active,
           'slot_' || CAST(event_id AS VARCHAR) AS slot_name,
           hex(event_id // 7) || '/' || hex((event_id * 1000003) % 4294967296) AS restart_lsn,
           hex((event_id * 3) // 7 + 16) || '/' || hex((event_id * 7919) % 4294967296) AS current_lsn
    FROM events
"""

CDC_SOURCE = """
    SELECT *,
           CASE o_orderkey % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'U' ELSE 'D' END AS op,
           strftime(o_orderdate + to_seconds(o_orderkey % 3600), '%Y-%m-%d %H:%M:%S') AS commit_timestamp,
           'tx' || CAST(o_orderkey % 1000 AS VARCHAR) AS cdc_transact_id,
           strftime(o_orderdate, '%Y/%m/%d/%H') AS event_time
    FROM orders
"""

LOAD_LOG = """
    SELECT 'load_' || CAST(o_custkey % 50 AS VARCHAR) AS label,
           CASE o_orderkey % 3 WHEN 0 THEN 'FINISHED' WHEN 1 THEN 'LOADING' ELSE 'CANCELLED' END AS state,
           o_orderdate + to_seconds(o_orderkey) AS create_time
    FROM orders
"""
