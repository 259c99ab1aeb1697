"""Queries of the set operators: two states of the orders table by date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.operators import setops as U
from asofworks.plans.registry import Tables, query

RUNS_SQL = """old as (select accession, form, status, amount from filings where filed_date <= date '2000-12-31' and accession % 10 > 0),
    new as (select accession, form, case when accession % 13 = 0 then 'X' else status end as status, case when accession % 17 = 0 then amount + 1 else amount end as amount from filings where accession % 11 > 0)"""


def runs(t: Tables) -> tuple[DataFrame, DataFrame]:
    old = t.filings.where("filed_date <= '2000-12-31' and accession % 10 > 0").select("accession", "form", "status", "amount")
    status = F.when(F.col("accession") % 13 == 0, "X").otherwise(F.col("status"))
    amount = F.when(F.col("accession") % 17 == 0, F.col("amount") + 1).otherwise(F.col("amount"))
    new = t.filings.where("accession % 11 > 0").select("accession", "form", status.alias("status"), amount.cast("decimal(18,2)").alias("amount"))
    return old, new


@query(
    "u2_compare_runs",
    f"""with {RUNS_SQL}, j as (select coalesce(o.accession, n.accession) as accession, case when o.accession is null then 'ADDED' when n.accession is null then 'REMOVED' else
      case when o.form <> n.form or o.status <> n.status or o.amount <> n.amount then 'CHANGED' else 'EQUAL' end end as change,
      concat_ws(',', case when o.form <> n.form then 'form' end, case when o.status <> n.status then 'status' end, case when o.amount <> n.amount then 'amount' end) as c from old o full outer join new n on o.accession = n.accession)
    select change, case when change = 'CHANGED' then c end as changed, count(*) as n, cast(sum(accession) as bigint) as ids from j group by 1, 2""",
)
def u2(t: Tables) -> DataFrame:
    rows = U.compare_runs(*runs(t), ["accession"], ["form", "status", "amount"])
    return rows.groupBy("change", F.array_join("changed", ",").alias("changed")).agg(F.count("*").alias("n"), F.sum("accession").alias("ids"))


@query(
    "u3_append_new",
    f"with {RUNS_SQL}, a as (select * from old union all select * from new where accession not in (select accession from old)) select status, count(*) as n, cast(sum(amount) as double) as total from a group by status",
)
def u3(t: Tables) -> DataFrame:
    old, new = runs(t)
    return U.append_new(old, new, ["accession"]).groupBy("status").agg(F.count("*").alias("n"), F.sum("amount").cast("double").alias("total"))


@query("u3_prefix_breaks", f"with {RUNS_SQL} select count(*) as n, cast(sum(accession) as bigint) as ids from (select * from old except all select * from new) x")
def u3b(t: Tables) -> DataFrame:
    return U.prefix_breaks(*runs(t)).agg(F.count("*").alias("n"), F.sum("accession").alias("ids"))


@query("u4_incremental_refresh", "select cik, coordinate, cast(value as double) as value, n_sources from cells")
def u4(t: Tables) -> DataFrame:
    """An earlier result, refreshed for the keys that later orders touch, equals the full result."""
    facts = t.filings.select("cik", "accession", "filed_date", "amount", (F.year("filed_date") * 4 + F.quarter("filed_date")).cast("long").alias("coordinate"))
    build = lambda df: df.groupBy("cik", "coordinate").agg(F.sum("amount").cast("double").alias("value"), F.count("*").alias("n_sources"))
    earlier = facts.where("filed_date <= '2000-02-15'")
    dirty = U.dirty_keys(earlier, facts, ["accession"], ["cik", "coordinate"])
    return U.refresh(build(earlier), facts, dirty, ["cik", "coordinate"], build)


@query(
    "u5_overlay",
    f"with {RUNS_SQL}, o as (select * from old where accession not in (select accession from new) union all select * from new) select form, count(*) as n, cast(sum(amount) as double) as total from o group by form",
)
def u5(t: Tables) -> DataFrame:
    return U.overlay(*runs(t), ["accession"]).groupBy("form").agg(F.count("*").alias("n"), F.sum("amount").cast("double").alias("total"))


@query(
    "u6_fill_reviewed",
    """with p as (select accession, case when accession % 3 > 0 then amount end as value, case accession % 3 when 0 then case when accession % 2 = 0 then 'MISSING_INPUT' else 'UNIT' end end as reason from filings),
    r as (select accession, amount as v from filings where accession % 4 = 0)
    select case when r.v is not null and reason = 'MISSING_INPUT' then null else reason end as reason, coalesce(r.v is not null and reason = 'MISSING_INPUT', false) as filled, count(*) as n, cast(sum(case when r.v is not null and reason = 'MISSING_INPUT' then r.v else value end) as double) as total from p left join r on p.accession = r.accession group by 1, 2""",
)
def u6(t: Tables) -> DataFrame:
    a = F.col("accession")
    parent = t.filings.select("accession", F.when(a % 3 > 0, F.col("amount")).alias("value"), F.when(a % 3 == 0, F.when(a % 2 == 0, "MISSING_INPUT").otherwise("UNIT")).alias("reason"))
    reviewed = t.filings.where(a % 4 == 0).select("accession", F.col("amount").alias("value"))
    rows = U.fill_reviewed(parent, reviewed, ["accession"], "value", "reason", "MISSING_INPUT")
    return rows.groupBy("reason", "filled").agg(F.count("*").alias("n"), F.sum("value").cast("double").alias("total"))


@query("u8_common_years", "select fiscal_year, count(distinct cik) as companies from annual where cik % 100 = 7 or value > 0 group by fiscal_year having count(distinct cik) = (select count(distinct cik) from annual)")
def u8(t: Tables) -> DataFrame:
    return U.common_years(t.annual, "cik", "fiscal_year")


@query(
    "u1_cohort_union",
    """with m as (select cik, accession, 0 as k from filings where cik % 3 < 2 union all select cik, accession, 1 from filings where cik % 3 > 0), o as (select cik, count(distinct k) as c from m group by cik)
    select case when c > 1 then 'CONFLICT' else 'ONE_OWNER' end as owner_status, cast(k as bigint) as member_no, count(*) as n from m join o on m.cik = o.cik group by 1, 2""",
)
def u1(t: Tables) -> DataFrame:
    f = t.filings.select("cik", "accession")
    return U.cohort_union([f.where("cik % 3 < 2"), f.where("cik % 3 > 0")], "cik").groupBy("owner_status", F.col("member_no").cast("long").alias("member_no")).agg(F.count("*").alias("n"))


@query(
    "a25_check_integrity",
    "with r as (select case when o_orderkey % 50 = 0 then null when o_orderkey % 20 = 1 then 1 else o_orderkey end as id from orders) select count(*) filter (where id is null) as null_ids, count(id) - count(distinct id) as repeated_ids, (select count(*) from facts where accession not in (select id from r where id is not null)) as orphans from r",
)
def a25(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    rows = t.orders.select(F.when(k % 50 == 0, None).when(k % 20 == 1, 1).otherwise(k).alias("id"))
    return U.check_integrity(rows, t.facts.select(F.col("accession").alias("id")), "id")
