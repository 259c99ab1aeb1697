"""Queries of the period and observation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.functions import scalars as S
from asofworks.operators import periods as P
from asofworks.plans.registry import Tables, query

CLASS_SQL = """case when datediff('day', start_date, end_date) between 75 and 105 then 'QTD_3M' when datediff('day', start_date, end_date) between 160 and 205 then 'YTD_6M'
    when datediff('day', start_date, end_date) between 250 and 300 then 'YTD_9M' when datediff('day', start_date, end_date) between 350 and 378 then 'FY' else 'OTHER_DURATION' end"""


@query("p1_classify_period", f"select {CLASS_SQL} as period_class, concept, count(*) as n, cast(sum(value) as double) as total from facts group by 1, 2")
def p1(t: Tables) -> DataFrame:
    rows = t.facts.withColumn("period_class", P.classify_period("start_date", "end_date"))
    return rows.groupBy("period_class", "concept").agg(F.count("*").alias("n"), F.sum("value").cast("double").alias("total"))


@query(
    "p2_classify_annual",
    """with a as (select *, make_date(cast(year(end_date) - 1 as bigint), cast(month(end_date) as bigint), cast(case when month(end_date) = 2 then least(day(end_date), 28) else day(end_date) end as bigint)) as anniversary,
          end_date - 1 as last, filed_date as focus from facts),
    b as (select *, abs(datediff('day', last, make_date(year(last) - 1, 12, 31))) <= 7 or abs(datediff('day', last, make_date(year(last), 12, 31))) <= 7 or abs(datediff('day', last, make_date(year(last) + 1, 12, 31))) <= 7 as near from a),
    c as (select case when abs(datediff('day', anniversary, start_date)) > 7 then 'ANNUAL_START_BOUNDARY_MISMATCH' when concept = 'A' and end_date in (focus, focus + 1) then 'ANNUAL_FILING_CONTEXT_BOUNDARIES'
          when near then 'DEI_FISCAL_END_AND_ANNUAL_START_ALIGNMENT' when concept = 'N' and end_date in (focus, focus + 1) then 'ROLLING_ANNUAL_DURATION_AT_INTERIM_FOCUS' else 'ANNUAL_BOUNDARY_EVIDENCE_MISSING' end as reason from b)
    select reason, case when reason in ('ANNUAL_FILING_CONTEXT_BOUNDARIES', 'DEI_FISCAL_END_AND_ANNUAL_START_ALIGNMENT') then 'FY' when reason like 'ROLLING%' then 'TTM' else 'OTHER_DURATION' end as period_class, count(*) as n from c group by 1, 2""",
)
def p2(t: Tables) -> DataFrame:
    rows = t.facts.withColumn("form", F.when(F.col("concept") == "A", "10-K").when(F.col("concept") == "N", "10-Q").otherwise("8-K"))
    rows = rows.withColumn("focus", F.lit("FY")).withColumn("m", F.lit(12)).withColumn("d", F.lit(31))
    got = rows.select(P.classify_annual("start_date", "end_date", "form", "focus", "filed_date", "m", "d").alias("a"))
    return got.groupBy("a.reason", "a.period_class").agg(F.count("*").alias("n"))


@query(
    "p3_comparative_type",
    """with a as (select case when datediff('day', filed_date, end_date) = 1 then filed_date else end_date end as o, filed_date as f, concept from facts)
    select case when o = f then 'CURRENT_FOCUS' when datediff('day', o, f) between 330 and 390 then 'PRIOR_YEAR_COMPARABLE' else 'OTHER_COMPARATIVE_CONTEXT' end as comparative, concept, count(*) as n from a group by 1, 2""",
)
def p3(t: Tables) -> DataFrame:
    rows = t.facts.withColumn("period_class", P.classify_period("start_date", "end_date"))
    return rows.groupBy(P.comparative_type("end_date", "period_class", "filed_date").alias("comparative"), "concept").agg(F.count("*").alias("n"))


@query("p4_as_of", "select concept, count(*) as n, cast(sum(value) as double) as total, cast(max(filed_date) as varchar) as newest from facts where filed_date <= date '1998-06-30' group by concept")
def p4(t: Tables) -> DataFrame:
    return P.as_of(t.facts, "1998-06-30").groupBy("concept").agg(F.count("*").alias("n"), F.sum("value").cast("double").alias("total"), F.max("filed_date").cast("string").alias("newest"))


@query(
    "p12_gate_reported",
    """with g as (select concat_ws(',', case when value > 100000 then 'QUALITY' end, case when member = 'F' then 'DIMENSIONS' end, case when discount > 0.08 then 'UNIT' end, case when end_date <= filed_date then 'PERIOD' end) as reasons from facts)
    select reasons, case when reasons = '' then null else split_part(reasons, ',', 1) end as unavailable_reason, count(*) as n from g group by 1, 2""",
)
def p12(t: Tables) -> DataFrame:
    rows = P.gate(t.facts, (F.col("value") > 100000, "QUALITY"), (F.col("member") == "F", "DIMENSIONS"), (F.col("discount") > 0.08, "UNIT"), (F.col("end_date") <= F.col("filed_date"), "PERIOD"))
    return rows.groupBy(F.array_join("reasons", ",").alias("reasons"), "unavailable_reason").agg(F.count("*").alias("n"))


@query("p13_approved_additive", "select cik, count(*) as n, cast(sum(value) as double) as total from facts where concept in ('A', 'R') and member = 'O' and datediff('day', start_date, end_date) between 75 and 378 group by cik")
def p13(t: Tables) -> DataFrame:
    allowed = F.col("concept").isin("A", "R") & (F.col("member") == "O") & F.datediff("end_date", "start_date").between(75, 378)
    return t.facts.where(allowed).groupBy("cik").agg(F.count("*").alias("n"), F.sum("value").cast("double").alias("total"))


@query("p15_assign_roles", "select case concept when 'A' then 'REVENUE' when 'N' then 'GROSS_PROFIT' end as role, count(*) as n, cast(sum(value) as double) as total from facts group by 1")
def p15(t: Tables) -> DataFrame:
    rows = P.assign_roles(t.facts, {"A": "REVENUE", "N": "GROSS_PROFIT"}, "concept")
    return rows.groupBy("role").agg(F.count("*").alias("n"), F.sum("value").cast("double").alias("total"))


@query(
    "a2_dimension_signature",
    "with s as (select accession, string_agg(concat(concept, '/', member), ';' order by concept, member) as signature from facts group by accession) select signature, count(*) as n from s group by signature",
)
def a2(t: Tables) -> DataFrame:
    rows = P.dimension_signature(t.facts, "accession", "concept", "member")
    text = F.array_join(F.transform("signature", lambda e: F.concat_ws("/", e["concept"], e["member"])), ";")
    return rows.groupBy(text.alias("signature")).agg(F.count("*").alias("n"))


@query(
    "j2_attach_mapping",
    """with m as (select p_partkey as raw_id, concat('canon-', p_brand) as canonical_id, p_size % 3 > 0 as reviewed from part where p_size % 5 > 0),
    r as (select case when canonical_id is not null and reviewed then canonical_id when canonical_id is null then concat('raw-unmapped:', part_key) else concat('raw-review:', part_key) end as canonical_id,
      case when canonical_id is not null and reviewed then 'MAPPED' else 'REVIEW_REQUIRED' end as mapping_status, value from facts left join m on part_key = raw_id)
    select canonical_id, mapping_status, count(*) as n, cast(sum(value) as double) as total from r group by 1, 2""",
)
def j2(t: Tables) -> DataFrame:
    mapping = t.part.where("p_size % 5 > 0").selectExpr("p_partkey as raw_id", "concat('canon-', p_brand) as canonical_id", "p_size % 3 > 0 as reviewed")
    rows = P.attach_mapping(t.facts, mapping, "part_key")
    return rows.groupBy("canonical_id", "mapping_status").agg(F.count("*").alias("n"), F.sum("value").cast("double").alias("total"))


@query(
    "j3_join_ledger",
    """with l as (select accession as a, count(*) as c, min(filed_date) as d from (select accession, case when accession % 7 = 0 then filed_date + 1 else filed_date end as filed_date from filings where accession % 5 > 0
      union all select accession, filed_date from filings where accession % 11 = 0 and accession % 5 > 0) x group by accession)
    select case when c is null then 'NOT_IN_LEDGER' when c > 1 then 'AMBIGUOUS_LEDGER' when d is distinct from filed_date then 'DISAGREES' else 'MATCH' end as ledger_status, count(*) as n from facts left join l on accession = a group by 1""",
)
def j3(t: Tables) -> DataFrame:
    base = t.filings.where("accession % 5 > 0")
    shifted = base.select("accession", F.when(F.col("accession") % 7 == 0, F.date_add("filed_date", 1)).otherwise(F.col("filed_date")).alias("ledger_date"))
    ledger = shifted.unionAll(base.where("accession % 11 = 0").select("accession", "filed_date"))
    return P.join_ledger(t.facts, ledger, "accession", {"filed_date": "ledger_date"}).groupBy("ledger_status").agg(F.count("*").alias("n"))


@query("j12_has_presentation", "select presented, count(*) as n from (select unit_key in (select s_suppkey from supplier where s_acctbal > 5000) as presented from facts) x group by presented")
def j12(t: Tables) -> DataFrame:
    shown = t.supplier.where("s_acctbal > 5000").select(F.col("s_suppkey").alias("unit_key"))
    return P.has_match(t.facts, shown, ["unit_key"], "presented").groupBy("presented").agg(F.count("*").alias("n"))


@query(
    "w15_filing_ledger",
    """with r as (select cik, accession, form, filed_date, case when accession % 10 <> 0 then cast(date_trunc('quarter', report_date) as date) end as report_date, regexp_replace(form, '/A$', '') as base_form, form like '%/A' as is_amendment, case when accession % 9 = 0 then cast(accession - 1 as varchar) when accession % 9 = 1 then ' ' end as named,
        case accession % 7 when 1 then concat('Amendment No. ', accession % 5, ' to ', lpad(cast(cik as varchar), 10, '0'), '-20-000007') when 2 then '0000000001-20-000001 and 0000000002-20-000002' when 3 then 'amendment 3' end as said from filings),
    l as (select r.*, row_number() over (partition by cik, base_form order by filed_date, accession) as ordinal from r),
    c as (select a.accession as accession, count(*) as n, min(o.accession) as one from l a join l o on a.cik = o.cik and a.base_form = o.form and coalesce(cast(a.report_date as varchar), '') = coalesce(cast(o.report_date as varchar), '') and o.filed_date < a.filed_date where a.is_amendment group by 1),
    s as (select l.*, c.one as one, case when not is_amendment then 'NOT_AN_AMENDMENT' when trim(named) <> '' then 'RAW_FILING_AMENDS_ACCESSION' when l.accession % 7 = 1 then 'DEI_DESCRIPTION_ACCESSION' when n = 1 then 'FORM_REPORT_DATE_COMPATIBLE_CANDIDATE' else 'UNKNOWN' end as link_method from l left join c on l.accession = c.accession)
    select cik, accession, base_form, is_amendment, cast(ordinal as bigint) as ordinal, link_method, case link_method when 'RAW_FILING_AMENDS_ACCESSION' then named when 'DEI_DESCRIPTION_ACCESSION' then substr(said, 20, 20) when 'FORM_REPORT_DATE_COMPATIBLE_CANDIDATE' then cast(one as varchar) end as amends,
      case when link_method = 'NOT_AN_AMENDMENT' then 'NOT_APPLICABLE' when link_method = 'UNKNOWN' then 'UNKNOWN' when link_method = 'FORM_REPORT_DATE_COMPATIBLE_CANDIDATE' then 'CANDIDATE' else 'LINKED' end as link_state,
      case link_method when 'FORM_REPORT_DATE_COMPATIBLE_CANDIDATE' then 'REVIEW_REQUIRED' when 'UNKNOWN' then 'UNKNOWN' else 'NOT_REQUIRED' end as review_status, case when accession % 7 = 1 then cast(accession % 5 as varchar) end as reported_ordinal from s""",
)
def w15(t: Tables) -> DataFrame:
    at = lambda k: F.col("accession") % k
    named = F.when(at(9) == 0, (F.col("accession") - 1).cast("string")).when(at(9) == 1, " ")
    said = F.when(at(7) == 1, F.concat(F.lit("Amendment No. "), at(5), F.lit(" to "), F.lpad(F.col("cik").cast("string"), 10, "0"), F.lit("-20-000007"))).when(at(7) == 2, "0000000001-20-000001 and 0000000002-20-000002").when(at(7) == 3, "amendment 3")
    filings = t.filings.withColumn("report_date", F.when(at(10) != 0, F.trunc("report_date", "quarter"))).withColumn("named", named).withColumn("said", said)
    rows = P.filing_ledger(filings, "named", "said")
    return rows.select("cik", "accession", "base_form", "is_amendment", F.col("ordinal").cast("long"), "link_state", "amends", "link_method", "review_status", "reported_ordinal")


@query(
    "p7_trailing_filings",
    """with d as (select cik, report_date, row_number() over (partition by cik order by report_date desc) as r from (select distinct cik, report_date from filings where form = '10-K') x),
    b as (select cik, report_date as bound from d where r = 3), k as (select distinct cik from d where r <= 2)
    select f.cik as cik, count(*) as n, cast(min(f.report_date) as varchar) as oldest from filings f join k on f.cik = k.cik left join b on f.cik = b.cik where bound is null or f.report_date > bound group by f.cik""",
)
def p7(t: Tables) -> DataFrame:
    return P.trailing_filings(t.filings, 2).groupBy("cik").agg(F.count("*").alias("n"), F.min("report_date").cast("string").alias("oldest"))


@query(
    "s3_select_cohort",
    """with d as (select distinct o_custkey as cik, o_orderkey + 3 as accession from orders where o_orderkey % 4 = 0), c as (select cik, accession, count(*) as k from filings group by 1, 2)
    select case when k is null then 'MISSING' when k > 1 then 'DUPLICATE' else 'FOUND' end as cohort_status, count(*) as n from d left join c on d.cik = c.cik and d.accession = c.accession group by 1""",
)
def s3(t: Tables) -> DataFrame:
    declared = t.orders.where("o_orderkey % 4 = 0").selectExpr("o_custkey as cik", "o_orderkey + 3 as accession").distinct()
    return P.select_cohort(t.filings, declared, ["cik", "accession"]).groupBy("cohort_status").agg(F.count("*").alias("n"))


@query("s2_find_filings", "select cik, accession, cast(filed_date as varchar) as filed_date from filings where form = '10-K' and status = 'F'")
def s2(t: Tables) -> DataFrame:
    return P.find_filings(t.filings, form="10-K", status="F", cik=None).select("cik", "accession", F.col("filed_date").cast("string"))


TOPICS = {"speech": ("hate", "scum"), "licence": ("apache license", "mit license"), "article": ("the ", " der ")}


@query(
    "f13_match_topics",
    """select topics, count(*) as n from (select concat_ws(',', case when contains(lower(text), 'hate') or contains(lower(text), 'scum') then 'speech' end,
    case when contains(lower(text), 'apache license') or contains(lower(text), 'mit license') then 'licence' end, case when contains(lower(text), 'the ') or contains(lower(text), ' der ') then 'article' end) as topics from documents) x group by topics""",
)
def f13(t: Tables) -> DataFrame:
    return t.documents.groupBy(F.array_join(S.match_topics("text", TOPICS), ",").alias("topics")).agg(F.count("*").alias("n"))


@query(
    "f3_f4_f5_f9_parsing",
    """select lpad(cast(o_custkey as varchar), 10, '0') as cik, cast(cast(o_orderdate as date) as varchar) as filed, cast(cast(o_orderdate as date) - 1 as varchar) as last_day, cast(cast(o_totalprice as decimal(28,8)) as double) as amount,
    cast(year(cast(o_orderdate as date) - 1) as bigint) as last_year, cast(quarter(cast(o_orderdate as date) - 1) as bigint) as last_quarter from orders""",
)
def parsing(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = t.orders.withColumn("day", S.filing_date(text))
    quarter = S.calendar_quarter("day")
    return rows.select(
        S.canonical_cik("o_custkey").alias("cik"), F.col("day").cast("string").alias("filed"), S.inclusive_end("day").cast("string").alias("last_day"), S.finite_decimal("o_totalprice").cast("double").alias("amount"),
        quarter["year"].cast("long").alias("last_year"), quarter["quarter"].cast("long").alias("last_quarter"),
    )


@query(
    "f12_f10_labels",
    """select regexp_replace(regexp_replace(c_name, '^.*:', ''), '#', ' ', 'g') as label, case when contains(c_mktsegment, 'HOUSE') then 'BS' when contains(c_mktsegment, 'MACH') then 'IS' when contains(c_mktsegment, 'AUTO') then 'EQ' end as kind,
    case when c_custkey % 3 = 0 then cast(2000 + c_custkey % 30 as varchar) end as namespace_year from customer""",
)
def labels(t: Tables) -> DataFrame:
    title = F.when(F.contains("c_mktsegment", F.lit("HOUSE")), "Consolidated Balance Sheets").when(F.contains("c_mktsegment", F.lit("MACH")), "Statements of Operations").when(F.contains("c_mktsegment", F.lit("AUTO")), "Statement of Shareholder Investment").otherwise("Notes")
    host = F.element_at(F.array(F.lit("HTTP://FASB.org"), F.lit("http://xbrl.us"), F.lit("http://example.com")), (F.col("c_custkey") % 3 + 1).cast("int"))
    uri = F.concat(host, F.lit("/us-gaap/"), (2000 + F.col("c_custkey") % 30).cast("string"), F.when(F.col("c_custkey") % 2 == 0, "-01-31").otherwise(""))
    return t.customer.select(F.regexp_replace(S.split_label("c_name"), "#", " ").alias("label"), S.statement_type(title).alias("kind"), S.gaap_namespace_year(uri).cast("string").alias("namespace_year"))


@query(
    "f14_intervals",
    """with v as (select cast(value as double) as v, 0.5 * pow(10.0, -cast(line % 3 as double)) as h, cast(quantity as double) as q from facts)
    select count(*) as n, count(*) filter (where v - h <= q * 2000 + 0.5 and q * 2000 - 0.5 <= v + h) as overlapping, max(v + h) as hi, min(v - h) as lo, max((v + h) - (q - 0.5)) as widest from v""",
)
def intervals(t: Tables) -> DataFrame:
    rows = t.facts.select(S.interval("value", F.col("line") % 3).alias("v"), S.interval("quantity", F.lit(0)).alias("q"), S.interval(F.col("quantity").cast("double") * 2000, F.lit(0)).alias("w"))
    return rows.agg(F.count("*").alias("n"), F.count_if(S.intervals_overlap("v", "w")).alias("overlapping"), F.max("v.hi").alias("hi"), F.min("v.lo").alias("lo"), F.max(S.interval_subtract("v", "q")["hi"]).alias("widest"))
