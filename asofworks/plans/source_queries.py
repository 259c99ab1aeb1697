"""Queries of the sources: each writes stand-ins to a new path and reads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.plans.registry import Tables, query
from asofworks.sources import tables as R


@query(
    "s1_read_raw",
    "select cast(accession as varchar) as accession, form, cast(filed_date as varchar) as filed_date, cast(cik % 7 as varchar) as cik, coalesce(k, 0) as facts from filings left join (select accession as a, count(*) as k from facts group by 1) f on f.a = accession where cik % 7 in (3, 5)",
)
def s1(t: Tables) -> DataFrame:
    path = R.scratch_path(t.spark, "raw")
    text = lambda c: F.col(c).cast("string").alias(c)
    t.filings.select(F.col("accession").cast("string").alias("filing_id"), (F.col("cik") % 7).cast("string").alias("cik"), text("accession"), "form", text("filed_date")).write.parquet(f"{path}/filing")
    t.facts.select(text("fact_id"), F.col("accession").cast("string").alias("filing_id"), (F.col("cik") % 7).cast("string").alias("cik")).repartition("cik").write.partitionBy("cik").parquet(f"{path}/fact")
    got = R.read_raw(t.spark, path, ("filing", "fact"), ["3", "5"])
    facts = got["fact"].groupBy("filing_id").agg(F.count("*").alias("facts"))
    return got["filing"].join(facts, "filing_id", "left").fillna(0, ["facts"]).select("accession", "form", "filed_date", "cik", "facts")


@query(
    "s4_read_submissions",
    """select lpad(cast(cik as varchar), 10, '0') as cik, cast(accession as varchar) as accession, form, cast(filed_date as varchar) as filed_date, cast(report_date as varchar) as report_date, accession % 2 = 1 as is_xbrl, case when cik % 10 = 0 and accession <> (select min(accession) from filings g where g.cik = f.cik) then 'UNEQUAL_LENGTHS' when cik % 10 = 0 then 'UNEQUAL_LENGTHS' else 'OK' end as status
    from filings f where form in ('10-K', '10-K/A', '10-Q', '10-Q/A')""",
)
def s4(t: Tables) -> DataFrame:
    path = R.scratch_path(t.spark, "submissions")
    day = lambda c: F.when(F.col("accession") % 2 == 0, F.date_format(c, "yyyyMMdd")).otherwise(F.col(c).cast("string"))
    rows = t.filings.select("cik", "accession", "form", day("filed_date").alias("filed"), day("report_date").alias("report"), F.when(F.col("accession") % 2 == 1, "1").otherwise("false").alias("flag"))
    each = rows.groupBy("cik").agg(F.sort_array(F.collect_list(F.struct("accession", "form", "filed", "report", "flag"))).alias("r"))
    pick = lambda c: F.transform("r", lambda x: x[c].cast("string"))
    longer = F.when(F.col("cik") % 10 == 0, F.concat(pick("flag"), F.array(F.lit("1")))).otherwise(pick("flag"))
    recent = F.struct(pick("accession").alias("accessionNumber"), pick("form").alias("form"), pick("filed").alias("filingDate"), pick("report").alias("reportDate"), pick("form").alias("primaryDocument"), pick("flag").alias("isXBRL"), longer.alias("isInlineXBRL"))
    json = F.to_json(F.struct(F.col("cik").cast("string").alias("cik"), F.struct(recent.alias("recent")).alias("filings")))
    # a file is one JSON array of companies
    files = each.select((F.col("cik") % 16).alias("part"), json.alias("json")).groupBy("part").agg(F.concat(F.lit("["), F.array_join(F.collect_list("json"), ","), F.lit("]")).alias("value"))
    files.write.partitionBy("part").text(path)
    return R.read_submissions(t.spark, path).select("cik", "accession", "form", F.col("filed_date").cast("string"), F.col("report_date").cast("string"), "is_xbrl", "status")


@query(
    "s5_read_targets",
    """with r as (select case when cik % 9 = 0 then null else lpad(cast(cik // 2 as varchar), 10, '0') end as cik, exchange as ticker, name from companies), n as (select cik, count(*) as k from r group by 1)
    select r.cik as cik, r.ticker as ticker, r.name as name, case when r.cik is null then 'INVALID' when k > 1 then 'DUPLICATE' else 'OK' end as status from r join n on r.cik is not distinct from n.cik""",
)
def s5(t: Tables) -> DataFrame:
    path = R.scratch_path(t.spark, "targets")
    half = F.floor(F.col("cik") / 2).cast("long").cast("string")
    text = F.when(F.col("cik") % 9 == 0, F.concat(F.lit("x"), half)).when(F.col("cik") % 2 == 0, F.lpad(half, 10, "0")).otherwise(half)
    t.companies.select(text.alias("cik"), F.col("exchange").alias("ticker"), "name").write.json(path)
    return R.read_targets(t.spark, path)


@query("s7_write_panel", "select cik % 10 as cik, count(*) as n_rows from filings group by 1")
def s7(t: Tables) -> DataFrame:
    return R.write_panel(t.filings.withColumn("cik", F.col("cik") % 10), R.scratch_path(t.spark, "panel")).select(F.col("cik").cast("long"), "n_rows")


@query("s9_read_company_partition", "select accession, form, cast(amount as double) as amount from filings where cik % 10 = 3")
def s9(t: Tables) -> DataFrame:
    path = R.scratch_path(t.spark, "panel")
    R.write_panel(t.filings.withColumn("cik", F.col("cik") % 10), path)
    return R.read_company_partition(t.spark, path, 3).select("accession", "form", F.col("amount").cast("double"))


@query(
    "s12_read_decisions",
    "select cast(event_id as varchar) as decision_id, cast(user_id as varchar) as accession, case when event_type = 'error' then 'BLOCK' else 'WARN' end as decision, cast(cast(ts as date) as varchar) as known_on from events where ts <= timestamp '2024-01-20 12:00:00'",
)
def s12(t: Tables) -> DataFrame:
    path = R.scratch_path(t.spark, "decisions")
    none = F.lit(None).cast("string")
    rows = t.events.select(
        F.col("event_id").cast("string").alias("decision_id"), none.alias("issue_id"), none.alias("ticker"), F.col("user_id").cast("string").alias("accession"), none.alias("concept"), none.alias("axis"), none.alias("member"),
        F.when(F.col("event_type") == "error", "BLOCK").otherwise("WARN").alias("decision"), F.col("ts").alias("known_at"), none.alias("reviewer"), none.alias("reason"), none.alias("evidence"),
    )
    rows.write.option("header", "true").csv(path)
    return R.read_decisions(t.spark, path, "2024-01-20 12:00:00").select("decision_id", "accession", "decision", F.col("known_at").cast("date").cast("string").alias("known_on"))
