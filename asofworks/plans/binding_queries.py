"""Queries of the operators that bind rows to mappings, declarations, texts and periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.operators import bindings as B
from asofworks.plans.registry import Tables, query


@query(
    "j9_apply_cross_mapping",
    """with o as (select fact_id, case when line % 3 = 0 then 'member' else 'concept' end as entity_type, concat(cik % 200, concept) as id from facts),
    m as (select distinct case when k % 3 = 0 then 'member' else 'concept' end as entity_type, concat(k, c) as id, concat('analytical:', k % 10, c) as a, case when k % 5 = 0 then 'RELATED' else 'EQUIVALENT' end as relation from (select distinct cik % 200 as k, concept as c from facts) x where k % 7 > 0)
    select fact_id, o.entity_type as entity_type, o.id as company_canonical_id, a as analytical_id, coalesce(relation, 'UNRESOLVED') as mapping_relation, cast(case when relation is null then 0 when relation = 'RELATED' then 0.5 else 1 end as double) as mapping_confidence, relation is null or relation = 'RELATED' as mapping_review_required from o left join m on m.entity_type = o.entity_type and m.id = o.id""",
)
def j9(t: Tables) -> DataFrame:
    kind = lambda k: F.when(k % 3 == 0, "member").otherwise("concept").alias("entity_type")
    own = (F.col("cik") % 200).alias("k")
    facts = t.facts.select("fact_id", kind(F.col("line")), F.concat((F.col("cik") % 200).cast("string"), "concept").alias("company_canonical_id"))
    base = t.facts.select(own, "concept").distinct().where("k % 7 > 0")
    related = F.col("k") % 5 == 0
    maps = base.select(kind(F.col("k")), F.concat(F.col("k").cast("string"), "concept").alias("company_canonical_id"), F.concat(F.lit("analytical:"), (F.col("k") % 10).cast("string"), "concept").alias("analytical_id"), F.when(related, "RELATED").otherwise("EQUIVALENT").alias("relation"), F.when(related, 0.5).otherwise(1.0).alias("confidence"), F.lit("X").alias("method"), related.alias("review_required"))
    rows = B.apply_cross_mapping(facts, maps)
    return rows.select("fact_id", "entity_type", "company_canonical_id", "analytical_id", "mapping_relation", "mapping_confidence", "mapping_review_required")


Q4_SQL = """f as (select cik, concept, fact_id, case line % 2 when 0 then 'FY' else 'YTD_9M' end as period_class, cast(date_trunc('year', filed_date) + interval 1 month * (part_key % 2) as date) as start_date, case when part_key % 13 = 0 then null else value end as value, case when part_key % 17 = 0 then 'DERIVED' else 'REPORTED' end as source_type, part_key % 211 > 0 as safe, line, cast(filed_date as date) as d from facts where line in (1, 2)),
    x as (select *, cast(start_date + interval 1 month * case when line = 2 then 12 when cik % 19 = 0 then 12 else 9 end as date) as end_date from f)"""


@query(
    "c6_policy_q4",
    f"""with {Q4_SQL}, g as (select cik, concept, bool_and(safe) as safe, count(*) filter (where period_class = 'FY') as fy, count(*) filter (where period_class = 'YTD_9M') as ytd from x group by 1, 2),
    w as (select x.*, case when x.concept = 'R' then 'Q4_SEMANTIC_DECLARATION_REQUIRED' when not g.safe then 'Q4_REVIEWED_MONETARY_ADDITIVE_SEMANTICS_REQUIRED' when fy = 0 or ytd = 0 then 'Q4_COMPATIBLE_FY_AND_YTD9M_REQUIRED' end as why from x join g on g.cik = x.cik and g.concept = x.concept),
    p as (select a.fact_id as fy_id, b.fact_id as ytd_id, a.value - b.value as v, case when a.source_type <> 'REPORTED' or b.source_type <> 'REPORTED' then 'Q4_REPORTED_SOURCES_REQUIRED' when b.end_date >= a.end_date then 'Q4_PERIOD_BOUNDARIES_INCOMPATIBLE' when a.value is null or b.value is null then 'Q4_NON_NUMERIC_SOURCE' when (a.fact_id + b.fact_id) % 5 = 0 then 'Q4_V2_EXACT_SCOPE_POLICY_REQUIRED' end as reason
      from w a join w b on a.cik = b.cik and a.concept = b.concept and a.start_date = b.start_date where a.why is null and b.why is null and a.period_class = 'FY' and b.period_class = 'YTD_9M'),
    met as (select fy_id as id from p union select ytd_id from p)
    select fact_id, cast(null as varchar) as other_id, why as reason, cast(null as double) as value from w where why is not null union all select fact_id, null, 'Q4_FISCAL_START_MISMATCH', null from w where why is null and fact_id not in (select id from met)
    union all select fy_id, cast(ytd_id as varchar), reason, case when reason is null then cast(v as double) end from p""",
)
def c6(t: Tables) -> DataFrame:
    f = t.facts.where("line in (1, 2)").select("cik", "concept", "fact_id", F.when(F.col("line") % 2 == 0, "FY").otherwise("YTD_9M").alias("period_class"), F.add_months(F.trunc("filed_date", "year"), (F.col("part_key") % 2).cast("int")).alias("start_date"), F.when(F.col("part_key") % 13 != 0, F.col("value")).alias("value"), F.when(F.col("part_key") % 17 == 0, "DERIVED").otherwise("REPORTED").alias("source_type"), (F.col("part_key") % 211 > 0).alias("safe"), "line")
    f = f.withColumn("end_date", F.add_months("start_date", F.when((F.col("line") == 2) | (F.col("cik") % 19 == 0), 12).otherwise(9).cast("int")))
    declarations = t.spark.createDataFrame([("A", "REVIEWED_ADDITIVE_AMOUNT", "ADDITIVE_AMOUNT", True, "d1"), ("N", "REVIEWED_ADDITIVE_AMOUNT", "ADDITIVE_AMOUNT", True, "d2"), ("R", "REVIEWED_ADDITIVE_AMOUNT", "RATIO", True, "d3")], "concept string, semantic_review_state string, value_kind string, is_additive boolean, declaration_id string")
    scope = ["cik", "concept"]
    both = f.where("period_class = 'FY'").select(*scope, "start_date", F.col("fact_id").alias("fy_id")).join(f.where("period_class = 'YTD_9M'").select(*scope, "start_date", F.col("fact_id").alias("ytd_id")), [*scope, "start_date"]).where("(fy_id + ytd_id) % 5 > 0")
    found, refused = B.policy_q4(f, declarations, scope, both)
    return refused.select("fact_id", F.col("other_id").cast("string"), "reason", F.lit(None).cast("double").alias("value")).unionByName(found.select(F.col("fy_fact_id").alias("fact_id"), F.col("ytd_fact_id").cast("string").alias("other_id"), F.lit(None).cast("string").alias("reason"), F.col("value").cast("double").alias("value")))


@query(
    "j14_check_transforms",
    """with s as (select o_orderkey as k, case o_orderkey % 6 when 0 then 'durweek' when 1 then 'boolballotbox' when 2 then 'entityfilercategoryen' when 3 then 'segment' when 4 then 'unknown' end as transform,
      case o_orderkey % 6 when 0 then cast(o_custkey % 9 as varchar) when 1 then case o_custkey % 4 when 0 then '☐' when 1 then '☑' when 2 then ' ☒ ' else 'x' end when 2 then case when o_custkey % 3 = 0 then 'Large  Accelerated FILER' else 'nobody' end when 3 then case when o_custkey % 5 = 0 then 'nowhere' else 'Segment ' || (o_custkey % 3) end else 'text' end as text from orders where o_orderkey % 10 > 0),
    n as (select *, case transform when 'durweek' then 'P' || (cast(text as bigint) * 7) || 'D' when 'boolballotbox' then case trim(text) when '☐' then 'false' when 'x' then null else 'true' end when 'entityfilercategoryen' then case when text <> 'nobody' then 'Large Accelerated Filer' end when 'segment' then case when text <> 'nowhere' then 'S' || right(text, 1) end when 'unknown' then null else text end as normalized from s),
    f as (select o_orderkey as k, case when o_custkey % 8 = 0 then 'other' else coalesce(normalized, 'none') end as stored from orders left join n on n.k = o_orderkey where o_orderkey % 11 > 0)
    select coalesce(n.k, f.k) as k, normalized, stored, case when n.k is null then 'SOURCE_MISSING' when f.k is null then 'FACT_MISSING' when transform = 'unknown' then 'UNSUPPORTED_TRANSFORM' when normalized is null then 'INVALID_TEXT' when normalized = stored then 'MATCH' else 'MISMATCH' end as status from n full join f on n.k = f.k""",
)
def j14(t: Tables) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    kind = F.get(F.array(*[F.lit(x) for x in ("durweek", "boolballotbox", "entityfilercategoryen", "segment", "unknown", None)]), (k % 6).cast("int"))
    box = F.get(F.array(*[F.lit(x) for x in ("☐", "☑", " ☒ ", "x")]), (c % 4).cast("int"))
    text = (
        F.when(k % 6 == 0, (c % 9).cast("string")).when(k % 6 == 1, box).when(k % 6 == 2, F.when(c % 3 == 0, "Large  Accelerated FILER").otherwise("nobody")).when(k % 6 == 3, F.when(c % 5 == 0, "nowhere").otherwise(F.concat(F.lit("Segment "), (c % 3).cast("string")))).otherwise("text")
    )
    source = t.orders.where("o_orderkey % 10 > 0").select(k.alias("k"), kind.alias("transform"), text.alias("text"))
    lookups = t.spark.createDataFrame([("segment", f"segment {n}", f"S{n}") for n in range(3)], "transform string, text string, code string")
    made = B.normalize_lexical(source, "text", "transform", lookups).select("k", "normalized")
    facts = t.orders.where("o_orderkey % 11 > 0").select(k.alias("k"), "o_custkey").join(made, "k", "left").select("k", F.when(c % 8 == 0, "other").otherwise(F.coalesce("normalized", F.lit("none"))).alias("value"))
    return B.check_transforms(source, facts, ["k"], lookups).select("k", "normalized", "stored", "status")


EXPLORER_SQL = """inv as (select cik, bucket, case when n is null then 'NO_FILING_AS_OF_CUTOFF' when cik % 9 = 0 then 'PERIOD_CONFLICT' else 'PERIOD_AVAILABLE' end as bucket_status from (select c.cik as cik, b.bucket as bucket, x.n as n from (select distinct cik from cells) c cross join (select unnest(range(7996, 8004)) as bucket) b left join (select cik, coordinate, count(*) as n from cells group by 1, 2) x on x.cik = c.cik and x.coordinate = b.bucket) y),
    obs as (select cik, coordinate as bucket, 'amount' as metric, cast(value as double) as value, case when source_id % 6 = 0 then 'QUALITY_BLOCKED' end as reason, source_id % 10 = 0 as blocked from cells union all select cik, coordinate, 'sources', cast(n_sources as double), null, false from cells where source_id % 4 > 0)"""


def _explorer(t: Tables) -> tuple[DataFrame, DataFrame]:
    some = t.cells.select("cik", F.col("coordinate").alias("bucket"), F.lit(True).alias("has")).distinct()
    grid = t.cells.select("cik").distinct().select("cik", F.explode(F.array(*[F.lit(b).cast("long") for b in range(7996, 8004)])).alias("bucket"))
    inventory = grid.join(some, ["cik", "bucket"], "left").select("cik", "bucket", F.when(F.col("has").isNull(), "NO_FILING_AS_OF_CUTOFF").when(F.col("cik") % 9 == 0, "PERIOD_CONFLICT").otherwise("PERIOD_AVAILABLE").alias("bucket_status"))
    amount = t.cells.select("cik", F.col("coordinate").alias("bucket"), F.lit("amount").alias("metric"), F.col("value").cast("double").alias("value"), F.when(F.col("source_id") % 6 == 0, "QUALITY_BLOCKED").alias("reason"), (F.col("source_id") % 10 == 0).alias("blocked"))
    sources = t.cells.where("source_id % 4 > 0").select("cik", F.col("coordinate").alias("bucket"), F.lit("sources").alias("metric"), F.col("n_sources").cast("double").alias("value"), F.lit(None).cast("string").alias("reason"), F.lit(False).alias("blocked"))
    return amount.unionByName(sources), inventory


@query(
    "c43_quarter_explorer",
    f"""with {EXPLORER_SQL}, p as (select distinct inv.cik as cik, l.bucket as bucket, coalesce(l.bucket_status, 'NO_FILING_AS_OF_CUTOFF') as bucket_status from inv left join inv l on l.cik = inv.cik and l.bucket_status <> 'NO_FILING_AS_OF_CUTOFF' and not exists (select 1 from inv m where m.cik = l.cik and m.bucket_status <> 'NO_FILING_AS_OF_CUTOFF' and m.bucket > l.bucket)),
    r as (select p.cik as cik, p.bucket as bucket, p.bucket_status as bucket_status, m.metric as metric, case when bucket_status <> 'PERIOD_AVAILABLE' then 'PERIOD_NOT_PREPARED' when o.cik is null then 'OBSERVATION_MISSING' else o.reason end as why, o.value as v from p cross join (values ('amount'), ('sources')) m(metric) left join obs o on o.cik = p.cik and o.bucket = p.bucket and o.metric = m.metric)
    select cik, cast(bucket as varchar) as bucket, bucket_status, metric, why as reason, case when why is null then v end as value from r""",
)
def c43(t: Tables) -> DataFrame:
    rows, _ = B.quarter_explorer(*_explorer(t), ["amount", "sources"])
    return rows.select("cik", F.col("bucket").cast("string"), "bucket_status", "metric", "reason", "value")


@query(
    "c43_quarter_coverage",
    f"""with {EXPLORER_SQL} select m.metric as metric, count(*) filter (where o.value is not null and o.reason is null and not o.blocked) as companies_available, count(*) as companies_total from inv cross join (values ('amount'), ('sources')) m(metric) left join obs o on o.cik = inv.cik and o.bucket = inv.bucket and o.metric = m.metric where inv.bucket = 7999 group by 1""",
)
def c43_coverage(t: Tables) -> DataFrame:
    return B.quarter_explorer(*_explorer(t), ["amount", "sources"], 7999)[1]
