"""Queries of metric definitions that are evaluated from a table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.operators import registry as R
from asofworks.plans.registry import Tables, query
from asofworks.sources.tables import written

#: Prepared cells of 40 companies: each line number and flag of a fact is one of the 21 reported rows; what is odd about a cell follows from its company, quarter and row.
NAMES = [f"quarter_{r}" for r in (*R.FLOWS, *R.BALANCES)]
CELLS_SQL = f"""g as (select cik % 40 as company, cast(year(filed_date) * 4 + quarter(filed_date) as bigint) as bucket, case concept when 'A' then 0 when 'N' then 1 else 2 end + 3 * (line - 1) as k, sum(value) as v from facts group by 1, 2, 3),
    h as (select *, company * 7 + bucket * 3 + k * 5 as h, make_date(cast((bucket - 1) // 4 as int), cast((bucket - 1) % 4 * 3 + 1 as int), 1) as s from g),
    prepared as (select company, n.name as metric, bucket, bucket - case when company % 7 = 0 and bucket % 9 = 0 then 1 else 0 end as coordinate, s + case when h % 43 = 0 then 5 else 0 end as st, cast(s + interval 3 month as date) as en,
      concat(company, '-', bucket, case when h % 31 = 0 then 'x' else '' end) as filing, case when h % 53 = 0 then null when h % 29 = 0 then 0 when h % 11 = 0 then -v else v end as v,
      case company % 3 when 0 then 'b1' when 1 then null else case when bucket >= 7990 then 'b2' else 'b1' end end as basis, case when company % 5 = 0 and bucket >= 7988 then 'new' else 'old' end as concept, company % 2 = 0 as debt, case when h % 41 = 0 then 'DIMENSION_MISMATCH' end as gate, h % 37 = 0 as twice
      from h join (values {", ".join(f"({k}, '{n}')" for k, n in enumerate(NAMES))}) n(k, name) on h.k = n.k),
    raw as (select * from prepared union all select * from prepared where twice)"""


def _cells(t: Tables) -> DataFrame:
    k = F.when(F.col("concept") == "A", 0).when(F.col("concept") == "N", 1).otherwise(2) + 3 * (F.col("line") - 1)
    bucket = (F.year("filed_date") * 4 + F.quarter("filed_date")).cast("long")
    g = t.facts.groupBy((F.col("cik") % 40).alias("company"), bucket.alias("bucket"), k.cast("int").alias("k")).agg(F.sum("value").alias("v"))
    g = written(g, "prepared")
    h = F.col("company") * 7 + F.col("bucket") * 3 + F.col("k") * 5
    at = lambda n: F.col("h") % n == 0
    first = F.make_date(F.floor((F.col("bucket") - 1) / 4).cast("int"), ((F.col("bucket") - 1) % 4 * 3 + 1).cast("int"), F.lit(1))
    g = g.withColumn("h", h).withColumn("first", first)
    value = F.when(at(53), None).when(at(29), 0).when(at(11), -F.col("v")).otherwise(F.col("v"))
    basis = F.when(F.col("company") % 3 == 0, "b1").when((F.col("company") % 3 == 2) & (F.col("bucket") >= 7990), "b2").when(F.col("company") % 3 == 2, "b1")
    rows = g.select(
        "company", F.get(F.array(*[F.lit(n) for n in NAMES]), F.col("k")).alias("metric"), "bucket", (F.col("bucket") - F.when((F.col("company") % 7 == 0) & (F.col("bucket") % 9 == 0), 1).otherwise(0)).alias("coordinate"),
        F.when(at(43), F.date_add("first", 5)).otherwise(F.col("first")).alias("start"), F.add_months("first", 3).alias("end"), F.col("first").alias("filed"), F.concat("company", F.lit("-"), "bucket", F.when(at(31), "x").otherwise("")).alias("filing"), value.alias("value"),
        F.lit("USD").alias("unit"), F.lit("").alias("dims"), basis.alias("basis"), F.lit("s").alias("versions"), F.lit("m").alias("mapping"), F.when((F.col("company") % 5 == 0) & (F.col("bucket") >= 7988), "new").otherwise("old").alias("concept"),
        (F.col("company") % 2 == 0).alias("combined_debt"), F.array_compact(F.array(F.when(at(41), "DIMENSION_MISMATCH"))).alias("reasons"), at(37).alias("twice"),
    )
    return rows.unionByName(rows.where("twice")).drop("twice")


SPINE = list(range(7986, 7994))
_PAIR = """case when x.basis is distinct from y.basis then 'BASIS_INCOMPATIBLE' when x.st <> y.st or x.en <> y.en or x.coordinate <> y.coordinate then 'PERIOD_MISMATCH' when x.filing <> y.filing then 'SOURCE_FILING_MISMATCH' end"""
_TTM_WHY = """case when count(i.coordinate) < 4 then 'INPUTS_NOT_COMPATIBLE' when bool_or(i.back < 3 and i.st is distinct from i.before) then 'INPUTS_NOT_CONTIGUOUS'
      when count(distinct i.concept) > 1 or count(distinct coalesce(i.basis, '-')) > 1 or (max(i.basis) is null and bool_or(datediff('day', i.st, i.en) not between 75 and 105)) or bool_or(datediff('day', i.st, i.en) not between 75 and 105) then 'INPUTS_NOT_COMPATIBLE' end"""


def _two(kind: str) -> str:
    return ", ".join(f"('quarter_{m}', '{k}', 'quarter_{a}', 'quarter_{b}')" for m, k, a, b in R.MADE if k in kind.split())


C14_SQL = f"""with {CELLS_SQL},
    one as (select company, bucket, metric, count(*) as n, any_value(gate) as gate, max(v) as v, any_value(st) as st, any_value(en) as en, any_value(coordinate) as coordinate, any_value(filing) as filing, any_value(basis) as basis, any_value(concept) as concept, any_value(debt) as debt from raw group by 1, 2, 3),
    spine as (select unnest(range({SPINE[0]}, {SPINE[-1] + 1})) as bucket), firms as (select distinct company from raw),
    grid as (select company, bucket from raw union select company, bucket from firms cross join spine),
    absent as (select g.company, g.bucket, case when exists (select 1 from raw r where r.company = g.company and r.bucket = g.bucket) then 'INPUT_NOT_REPORTED' else 'NO_FILING_AS_OF_CUTOFF' end as why from grid g),
    base as (select a.company, a.bucket, m.name as metric, case when one.n is null then a.why when one.n > 1 then 'MULTIPLE_CANDIDATES' when gate is not null then gate when one.v is null then 'INPUT_NOT_REPORTED' end as why, one.v as v, st, en, coordinate, filing, basis, concept, debt
      from absent a cross join (values {", ".join(f"('{n}')" for n in NAMES)}) m(name) left join one on one.company = a.company and one.bucket = a.bucket and one.metric = m.name),
    p1 as (select x.company as company, x.bucket as bucket, d.metric as metric, d.kind as kind, coalesce(x.why, y.why, {_PAIR},
        case when d.kind = 'NET_DEBT' and not x.debt then 'DIRECT_COMBINED_DEBT_UNAVAILABLE' when d.kind = 'NET_DEBT' and (x.v < 0 or y.v < 0) then 'NEGATIVE_INPUT' when d.kind = 'DIFFERENCE' and y.v < 0 then 'CAPEX_SIGN_UNCERTAIN' when d.kind in ('DIFFERENCE', 'NET_DEBT') then null
        when y.v < 0 and d.metric = 'quarter_liabilities_to_equity' then 'NEGATIVE_EQUITY' when y.v <= 0 then 'NON_POSITIVE_DENOMINATOR' when d.kind = 'STOCK_PERCENT' and x.v < 0 then 'NEGATIVE_NUMERATOR' end) as why,
        case when d.kind in ('DIFFERENCE', 'NET_DEBT') then cast(x.v - y.v as double) when y.v <> 0 then cast(x.v as double) / cast(y.v as double) * 100 end as out, x.v - y.v as v, x.st as st, x.en as en, x.coordinate as coordinate, x.filing as filing, x.basis as basis, x.concept as concept
      from (values {_two("PERCENT STOCK_PERCENT DIFFERENCE NET_DEBT")}) d(metric, kind, a, b) join base x on x.metric = d.a join base y on y.metric = d.b and x.company = y.company and x.bucket = y.bucket where d.metric <> 'quarter_fcf_margin'),
    fcf as (select company, bucket, metric, why, v, st, en, coordinate, filing, basis, concept from p1 where metric = 'quarter_standardized_fcf'),
    p2 as (select x.company as company, x.bucket as bucket, 'quarter_fcf_margin' as metric, coalesce(x.why, y.why, {_PAIR}, case when y.v <= 0 then 'NON_POSITIVE_DENOMINATOR' end) as why, case when y.v <> 0 then cast(x.v as double) / cast(y.v as double) * 100 end as out from fcf x join base y on y.metric = 'quarter_revenue' and x.company = y.company and x.bucket = y.bucket),
    inputs as (select company, bucket, metric, why, v, st, en, coordinate, filing, basis, concept from base union all select * from fcf),
    claims as (select company, metric, coordinate, v, st, en, filing, basis, concept from raw where gate is null and v is not null union all select company, metric, coordinate, v, st, en, filing, basis, concept from fcf where why is null),
    idx as (select company, metric, coordinate, any_value(v) as v, any_value(st) as st, any_value(en) as en, any_value(filing) as filing, any_value(basis) as basis, any_value(concept) as concept from claims group by 1, 2, 3 having count(*) = 1),
    growth as (select x.company as company, x.bucket as bucket, d.metric as metric, coalesce(x.why, case when p.company is null then 'MISSING_INPUT' when x.basis is distinct from p.basis then 'BASIS_INCOMPATIBLE' when x.concept <> p.concept then 'SEMANTIC_IDENTITY_MISMATCH' when d.back = 1 and p.en <> x.st then 'PERIOD_NOT_CONTIGUOUS' when d.back = 4 and p.en > x.st then 'PERIOD_OVERLAP' when p.v <= 0 then 'NON_POSITIVE_DENOMINATOR' when x.v < 0 then 'NEGATIVE_CURRENT_VALUE' end) as why,
        case when p.v <> 0 then cast(x.v - p.v as double) / cast(p.v as double) * 100 end as out from base x cross join (values ('quarter_revenue_qoq', 1), ('quarter_revenue_yoy', 4)) d(metric, back) left join idx p on x.why is null and p.company = x.company and p.metric = x.metric and p.coordinate = x.coordinate - d.back where x.metric = 'quarter_revenue'),
    window4 as (select x.company as company, x.bucket as bucket, x.metric as metric, x.why as x_why, b.back as back, i.*, p.en as before from inputs x cross join (values (0), (1), (2), (3)) b(back) left join idx i on x.why is null and i.company = x.company and i.metric = x.metric and i.coordinate = x.coordinate - b.back left join idx p on p.company = i.company and p.metric = i.metric and p.coordinate = i.coordinate - 1
      where x.metric in ('quarter_revenue', 'quarter_gross_profit', 'quarter_operating_income', 'quarter_net_income', 'quarter_cfo', 'quarter_standardized_fcf')),
    sums as (select i.company as company, i.bucket as bucket, i.metric as metric, coalesce(case when any_value(x_why) is not null then 'INPUTS_NOT_COMPATIBLE' end, {_TTM_WHY}) as why, sum(i.v) as v from window4 i group by 1, 2, 3),
    pairs as (select a.company as company, a.bucket as bucket, a.metric as metric, arg_max(case when x.basis is distinct from y.basis then 'BASIS_INCOMPATIBLE' when x.st <> y.st or x.en <> y.en or x.coordinate <> y.coordinate then 'PERIOD_MISMATCH' when x.filing <> y.filing then 'SOURCE_FILING_MISMATCH' end, x.back) as why
      from sums a join window4 x on x.company = a.company and x.bucket = a.bucket and x.metric = a.metric join window4 y on y.company = a.company and y.bucket = a.bucket and y.metric = 'quarter_revenue' and y.back = x.back where a.why is null and a.metric <> 'quarter_revenue' group by 1, 2, 3),
    margins as (select a.company as company, a.bucket as bucket, concat('ttm_', d.m) as metric, coalesce(a.why, b.why, p.why, case when b.v <= 0 then 'NON_POSITIVE_DENOMINATOR' end) as why, case when b.v <> 0 then cast(a.v as double) / cast(b.v as double) * 100 end as out
      from (values {", ".join(f"('{m}', 'quarter_{a}')" for m, a in R.MARGINS)}) d(m, a) join sums a on a.metric = d.a join sums b on b.metric = 'quarter_revenue' and b.company = a.company and b.bucket = a.bucket left join pairs p on p.company = a.company and p.bucket = a.bucket and p.metric = a.metric),
    every as (select company, bucket, metric, why, cast(v as double) as out from base union all select company, bucket, metric, why, out from p1 union all select * from p2 union all select * from growth union all select * from margins
      union all select company, bucket, replace(metric, 'quarter_', 'ttm_'), why, cast(v as double) from sums where metric <> 'quarter_gross_profit')
    select company, bucket, metric, why as reason, case when why is null then out end as value from every where bucket in (select bucket from spine)"""


@query("c14_quarter_catalog", C14_SQL)
def c14_catalog(t: Tables) -> DataFrame:
    catalog = R.quarter_catalog(t.spark, dt.date(2020, 1, 1), dt.date(2021, 1, 1))
    return R.evaluate(_cells(t), SPINE, R.active(catalog, "2022-01-01")).select("company", "bucket", "metric", "reason", "value")
