"""SQL definitions of the resource views, for the checks."""

from __future__ import annotations

VIEWS = {
    "ev": """
        SELECT event_id AS id, 'ev:' || event_id AS externalId, event_type AS type, 'u:' || user_id AS source,
               value, epoch_us(ts) // 1000 AS startTime, epoch_us(ts) // 1000 AS lastUpdatedTime,
               json_extract_string(props, '$.k') AS k
        FROM events""",
    "dp": "SELECT 'u:' || user_id AS externalId, epoch_us(ts) // 1000 AS timestamp, value AS valueNum FROM events",
    "ts_head": "SELECT DISTINCT user_id AS id, 'u:' || user_id AS externalId, 'series ' || user_id AS name FROM events",
    "ast": """
        SELECT 1 + r_regionkey::BIGINT AS id, 'region:' || r_regionkey AS externalId, r_name AS name,
               NULL::VARCHAR AS description, NULL::BIGINT AS parentId, NULL::VARCHAR AS parentExternalId,
               1 + r_regionkey::BIGINT AS rootId, 'region:' || r_regionkey AS rootExternalId,
               NULL::VARCHAR AS source, 1 + r_regionkey::BIGINT AS dataSetId
        FROM region
        UNION ALL
        SELECT 100 + n_nationkey::BIGINT, 'nation:' || n_nationkey, n_name, NULL, 1 + n_regionkey,
               'region:' || n_regionkey, 1 + n_regionkey, 'region:' || n_regionkey, NULL, 1 + n_regionkey
        FROM nation
        UNION ALL
        SELECT 1000 + c_custkey, 'customer:' || c_custkey, c_name, NULL, 100 + c_nationkey,
               'nation:' || c_nationkey, 1 + n_regionkey, 'region:' || n_regionkey, c_mktsegment, 1 + n_regionkey
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "ast_in": """
        SELECT a.id, a.externalId, a.name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'changed' END AS description,
               a.parentId, a.parentExternalId, a.rootId, a.rootExternalId, a.source, a.dataSetId
        FROM ast a LEFT JOIN customer ON a.externalId = 'customer:' || c_custkey
        WHERE c_acctbal IS NULL OR c_acctbal >= 0
        UNION ALL
        SELECT 900000000 + c_custkey, 'new:' || c_custkey, a.name, NULL, a.parentId, a.parentExternalId, a.rootId,
               a.rootExternalId, a.source, a.dataSetId
        FROM ast a JOIN customer ON a.externalId = 'customer:' || c_custkey WHERE c_acctbal > 9000""",
    "lvl": """
        SELECT externalId, externalId AS root, 0::BIGINT AS depth, externalId AS path FROM ast
        WHERE parentExternalId IS NULL
        UNION ALL
        SELECT a.externalId, l.root, l.depth + 1, l.path || '/' || a.externalId
        FROM ast a JOIN lvl l ON a.parentExternalId = l.externalId""",
    "raw": """
        SELECT 'sales' AS dbName, o_orderstatus AS tableName, 'o:' || o_orderkey AS key, o_custkey::VARCHAR AS custkey,
               o_totalprice AS totalprice, o_orderpriority AS priority, epoch_us(o_orderdate) // 1000 AS lastUpdatedTime
        FROM orders""",
    "seq": """
        SELECT 's:' || l_orderkey AS externalId, l_linenumber::BIGINT AS rowNumber, l_orderkey,
               l_quantity AS quantity, l_extendedprice AS extendedprice, l_discount AS discount, l_tax AS tax,
               l_returnflag AS returnflag, l_linestatus AS linestatus
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
              FROM lineitem)
        WHERE rn = 1""",
    "cells": """
        SELECT externalId, rowNumber, 'quantity' AS "column", quantity AS d, NULL::VARCHAR AS s FROM seq
        UNION ALL SELECT externalId, rowNumber, 'extendedprice', extendedprice, NULL FROM seq
        UNION ALL SELECT externalId, rowNumber, 'discount', discount, NULL FROM seq
        UNION ALL SELECT externalId, rowNumber, 'tax', tax, NULL FROM seq
        UNION ALL SELECT externalId, rowNumber, 'returnflag', NULL, returnflag FROM seq
        UNION ALL SELECT externalId, rowNumber, 'linestatus', NULL, linestatus FROM seq""",
    "fil": """
        SELECT page_id AS id, 'f:' || page_id AS externalId, url AS name, 'text/html' AS mimeType FROM pages""",
    "bin": """
        SELECT page_id AS id, 'f:' || page_id AS externalId, octet_length(encode(html))::BIGINT AS bytes
        FROM pages WHERE NOT contains(url, 'ref=')""",
    "items": """
        SELECT NULL::BIGINT AS id, 'ev:' || doc_id AS externalId FROM labels
        UNION ALL SELECT doc_id, NULL FROM labels WHERE quality = 1
        UNION ALL SELECT doc_id, NULL FROM labels WHERE quality = 1
        UNION ALL SELECT NULL, 'supplier:' || s_suppkey FROM supplier""",
    "reqs": """
        SELECT * FROM (VALUES (1, 'click', NULL, NULL), (2, NULL, 1704412800000, 1704844800000),
                              (3, 'error', 1704412800000, 1704844800000), (4, 'nothing', NULL, NULL))
        AS t(request_id, type, "min", "max")""",
    "state_rows": """
        SELECT event_type AS identifier, min(epoch_us(ts) // 1000) AS timestamp, max(epoch_us(ts) // 1000) AS lastUpdatedTime
        FROM events GROUP BY event_type, date_trunc('day', ts)""",
    "marks": """
        SELECT 'u:' || user_id AS key, max(epoch_us(ts) // 1000) AS high FROM events WHERE event_type <> 'error' GROUP BY 1""",
    "mark_pairs": """
        SELECT CASE WHEN value < 1 THEN NULL ELSE 'u:' || (user_id + 20) END AS key,
               CASE WHEN value > 489 THEN NULL ELSE epoch_us(ts) // 1000 END AS high, event_id AS ord
        FROM events WHERE event_type = 'error'""",
}

_NEEDS = {
    "ast_in": ("ast",),
    "lvl": ("ast",),
    "cells": ("seq",),
}


def with_views(names: tuple[str, ...], sql: str) -> str:
    """The query with its views as common table expressions."""
    wanted: list[str] = []
    for name in names:
        for needed in (*_NEEDS.get(name, ()), name):
            if needed not in wanted:
                wanted.append(needed)
    if not wanted:
        return sql.strip()
    recursive = "RECURSIVE " if "lvl" in wanted else ""
    parts = ", ".join(f"{n} AS ({VIEWS[n]})" for n in wanted)
    return f"WITH {recursive}{parts} {sql.strip()}"
