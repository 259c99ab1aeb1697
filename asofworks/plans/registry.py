"""The table of queries, and how a query reads the driver's tables and stand-ins made of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Stand-ins for the domain's tables, as SQL over the driver's tables that both engines read.
STAND_INS = {
    # filings: an order is a filing of its customer
    "filings": """select o_custkey as cik, o_orderkey as accession, cast(o_orderdate as date) as filed_date,
        case o_orderpriority when '1-URGENT' then '10-K' when '2-HIGH' then '10-K/A' when '3-MEDIUM' then '10-Q' when '4-NOT SPECIFIED' then '10-Q/A' else '8-K' end as form,
        cast(o_orderdate as date) - 45 as report_date, o_orderstatus as status, cast(o_totalprice as decimal(18,2)) as amount from orders""",
    # facts: a line is a reported fact of its order
    "facts": """select o_custkey as cik, o_orderkey as accession, l_orderkey * 10 + l_linenumber as fact_id, cast(o_orderdate as date) as filed_date,
        l_returnflag as concept, l_linestatus as member, cast(l_extendedprice as decimal(18,2)) as value, cast(l_quantity as decimal(18,2)) as quantity,
        cast(l_shipdate as date) as end_date, cast(l_shipdate as date) - case l_linenumber % 5 when 0 then 91 when 1 then 182 when 2 then 273 when 3 then 364 else 31 end as start_date,
        l_linenumber as line, l_partkey as part_key, l_suppkey as unit_key, l_discount as discount from lineitem join orders on l_orderkey = o_orderkey""",
    # cells: a customer's ordered amount of a calendar quarter
    "cells": """select o_custkey as cik, cast(year(o_orderdate) as bigint) as fiscal_year, cast(quarter(o_orderdate) as bigint) as fiscal_quarter,
        cast(year(o_orderdate) as bigint) * 4 + quarter(o_orderdate) as coordinate, sum(cast(o_totalprice as decimal(18,2))) as value, count(*) as n_sources,
        min(o_orderkey) as source_id from orders group by o_custkey, year(o_orderdate), quarter(o_orderdate)""",
    # annual: a customer's amounts of a year, by concept of the lines
    "annual": """select o_custkey as cik, cast(year(o_orderdate) as bigint) as fiscal_year, l_returnflag as metric, sum(cast(l_extendedprice as decimal(18,2))) as value,
        count(*) as n_sources from lineitem join orders on l_orderkey = o_orderkey group by o_custkey, year(o_orderdate), l_returnflag""",
    "companies": """select c_custkey as cik, c_name as name, c_mktsegment as exchange, c_nationkey as sic, cast(c_acctbal as decimal(18,2)) as balance from customer""",
    # prices: an account's last value of a day
    "prices": """select security_id, trade_date, close from (select user_id as security_id, cast(ts as date) as trade_date, cast(value as decimal(18,2)) as close,
        row_number() over (partition by user_id, cast(ts as date) order by ts desc, event_id desc) as latest from events) p where latest = 1""",
    "sessions": """select trade_date, row_number() over (order by trade_date) as session from (select distinct cast(ts as date) as trade_date from events) d""",
    # edges: region to nation to customer
    "edges": """select concat('R', r_regionkey) as parent, concat('N', n_nationkey) as child, 1 as weight, n_nationkey as ordinal from region join nation on n_regionkey = r_regionkey
        union all select concat('N', c_nationkey), concat('C', c_custkey), 1, c_custkey from customer""",
}
#: Rows of a task: lines and their orders are dealt by order, and amounts of a year by company, to so many partitions that each has about these.
ROWS_A_TASK = 250_000
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


def parts_of_lines(spark: SparkSession, sf_dir: str) -> int:
    """To how many partitions lines are dealt, by their number."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "lineitem").count() // ROWS_A_TASK))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, or a stand-in by name.

    Stand-ins of lines are in partitions of bounded size: files of 128 MB, and
    shuffle partitions joined up to 64 MB, hold millions of such narrow rows, and
    the groups that a task sums before it sends them would take gigabytes.
    """
    if name in STAND_INS:
        used = {t: table(spark, sf_dir, t) for t in TABLES if f"from {t}" in STAND_INS[name] or f"join {t}" in STAND_INS[name]}
        parts = 0
        if "lineitem" in used:
            parts = parts_of_lines(spark, sf_dir)
            used |= {"lineitem": used["lineitem"].repartition(parts, "l_orderkey"), "orders": used["orders"].repartition(parts, "o_orderkey")}
        sql = STAND_INS[name]
        for t in used:
            sql = sql.replace(f"from {t}", f"from {{{t}}}").replace(f"join {t} ", f"join {{{t}}} ")
        rows = spark.sql(sql, **used)
        return rows.repartition(parts, "cik") if name == "annual" else rows
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: Column) -> Column:
    """A double as decimal(18,2), rounded as DuckDB casts it: 100 c to the nearest whole number, where Spark would round c's shortest decimal form."""
    return (F.round(c * 100) / 100).cast("decimal(18,2)")


class Tables:
    """Tables of one directory as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def parts(self) -> int:
        return parts_of_lines(self.spark, self.sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables as a query; sql is its twin, in which stand-ins are named like tables."""

    def keep(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: function(Tables(spark, sf_dir))
        if sql:
            used = [k for k in STAND_INS if f"from {k}" in sql or f"join {k}" in sql]
            head = ", ".join(f"{k} as ({STAND_INS[k]})" for k in used)
            body = sql.strip()
            recursive = body.lower().startswith("with recursive")
            if head and body.lower().startswith("with"):
                body = f"with {'recursive ' if recursive else ''}{head}, " + body[len("with recursive" if recursive else "with") :]
            elif head:
                body = f"with {head} {body}"
            SQL[name] = body
        return function

    return keep
