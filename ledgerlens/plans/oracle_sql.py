"""Independent DuckDB formulations of every catalogue query.

Written directly in SQL (window functions, FILTER clauses, quantile_cont),
not generated from the Spark plans, so the comparison is a real check.
The adapter CTEs restate the role mapping of ``sources/tables.py``.
"""

from __future__ import annotations

from ledgerlens.plans.registry import ORACLE, ROUNDED

# Fixed values (must equal sources/tables.py): anchors 2001-08-02 (orders),
# 2001-12-01 (lineitem months), 2024-01-31 (events), due offset 60 days.
ADAPTERS = {
    "spine": """spine AS (
  SELECT c_custkey AS id, c_mktsegment AS seg, CAST(c_nationkey AS BIGINT) AS region, c_acctbal AS acctbal,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS income,
         CASE WHEN c_custkey % 3 <> 0 THEN abs(c_acctbal) / 10000.0::DOUBLE END AS ext1,
         CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 100 AS DOUBLE) / 100.0::DOUBLE END AS ext2,
         CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_nationkey AS DOUBLE) / 25.0::DOUBLE END AS ext3
  FROM customer)""",
    "hist": """hist AS (
  SELECT o_custkey AS id, o_orderkey AS u,
         date_diff('day', DATE '2001-08-02', CAST(o_orderdate AS DATE)) AS day,
         o_totalprice AS amt, o_orderstatus AS status, o_orderpriority AS kind
  FROM orders)""",
    "bal": """bal AS (
  SELECT l_orderkey AS parent, l_linenumber AS u1, l_partkey AS u2, l_suppkey AS u3, l_extendedprice AS u4,
         CAST(floor(date_diff('day', DATE '2001-12-01', CAST(l_shipdate AS DATE)) / 30) AS BIGINT) AS month,
         CASE WHEN l_returnflag = 'N' THEN 'C'
              WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN '0'
              WHEN l_returnflag = 'A' THEN 'X'
              ELSE CAST(l_linenumber % 5 + 1 AS VARCHAR) END AS code
  FROM lineitem)""",
    "inst": """inst AS (
  SELECT o_custkey AS id, l_orderkey AS u0, l_linenumber AS u1, l_partkey AS u2, l_suppkey AS u3,
         l_extendedprice AS u4, CAST(l_linenumber AS BIGINT) AS num,
         date_diff('day', DATE '2001-08-02', CAST(o_orderdate AS DATE)) + 60 AS due_day,
         CASE WHEN l_linenumber <> 7 THEN date_diff('day', DATE '2001-08-02', CAST(l_shipdate AS DATE)) END AS entry_day,
         l_extendedprice AS due, l_extendedprice * (1.0::DOUBLE + l_tax - l_discount) AS paid
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "monthly": """monthly AS (
  SELECT user_id AS id, event_id AS u,
         date_diff('day', DATE '2024-01-31', CAST(ts AS DATE)) AS period,
         value AS bal,
         CASE WHEN event_type = 'signup' THEN 0.0::DOUBLE ELSE 500.0::DOUBLE END AS lim,
         CASE WHEN event_type = 'purchase' THEN value ELSE 0.0::DOUBLE END AS draw,
         CASE WHEN event_type = 'click' THEN value END AS pay,
         CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS BIGINT) AS dpd
  FROM events)""",
    "scored": """scored AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         CAST(l_returnflag = 'R' AS INTEGER) AS y,
         l_extendedprice / 105000.0::DOUBLE AS s1, l_discount * 10.0::DOUBLE AS s2,
         l_quantity / 50.0::DOUBLE AS s3
  FROM lineitem)""",
}


def sql(name: str, body: str, adapters=(), rnd=(), ctes: str = "") -> str:
    """Register ``body`` with the listed adapter CTEs; ``rnd`` names its floating columns."""
    body = body.strip()
    extra = [ctes.strip()] if ctes else []
    if body[:4].upper() == "WITH" and (adapters or extra):
        head, tail = body[4:].split("\nSELECT", 1)
        extra.append(head.strip())
        body = "SELECT" + tail
    parts = [ADAPTERS[a] for a in adapters] + extra
    q = (("WITH " + ",\n".join(parts) + "\n") if parts else "") + body
    ORACLE[name] = q
    ROUNDED[name] = tuple(rnd)
    return q
