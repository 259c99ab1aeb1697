"""Queries of the quarterly pivot's metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from asofworks.operators import pivot_metrics as M
from asofworks.plans.registry import Tables, query
from asofworks.sources.tables import written

#: Companies, rows and quarters from the facts; what is odd about a cell follows from their numbers.
GROUPS = "select cik % 30 as company, year(filed_date) * 4 + quarter(filed_date) as coordinate, case concept when 'A' then 0 when 'N' then 1 else 2 end + 3 * (line - 1) as k, sum(value) as v from {facts} group by 1, 2, 3"
ROWS = """select company, cast(coordinate as bigint) as coordinate, concat('row', k) as row_id, case when h % 53 = 0 then null when h % 37 = 0 then 0 else v end as value, h % 29 > 0 as reported, h % 31 = 0 as review, case when h % 41 = 0 then 'EUR' else 'USD' end as unit, case when h % 43 = 0 then 'x' else '' end as dims, 'AS_FILED' as view, date '2002-01-01' as as_of,
    case when company % 9 = 0 then '' when h % 47 = 0 then 'b2' else 'b1' end as basis, case when h % 23 = 0 then 'm2' else 'm1' end as mapping, h % 59 > 0 as context, case when k = 0 or (k = 3 and company % 6 = 0) then 'REVENUE' when k = 1 then 'GROSS_PROFIT' when k = 2 then 'OPERATING_INCOME' end as role, concat('line', case when k = 12 then 10 else k end) as line_id,
    case when k between 4 and 9 then 'line0' when k = 11 then 'line10' end as parent_line_id, k % 2 = 0 or k = 11 as linked from (select *, company * 7 + coordinate * 3 + k * 5 as h from {groups}) h"""
COLUMNS = "select distinct company, coordinate from {rows} where (company + coordinate) % 13 > 0"
_CODE = """case when a.row_id is null or b.row_id is null then 'REQUIRED_INPUT_NOT_AVAILABLE' when not a.reported or not b.reported then 'INPUT_NOT_REPORTED' when a.review or b.review then 'MAPPING_REVIEW_REQUIRED' when a.basis = '' or b.basis = '' then 'INCOMPLETE_GOVERNED_SCOPE' when a.unit <> b.unit then 'INCOMPATIBLE_UNIT'
    when a.dims <> b.dims then 'INCOMPATIBLE_DIMENSIONS' when a.basis <> b.basis then 'INCOMPATIBLE_SELECTION_SCOPE' when a.mapping <> b.mapping then 'INCOMPATIBLE_MAPPING' when not a.context or not b.context then 'INCOMPLETE_CONTEXT' when a.value is null or b.value is null then 'NON_DECIMAL_INPUT' when b.value = 0 then 'ZERO_DENOMINATOR' end"""


@query(
    "c12_quarterly_metrics",
    f"""with g as ({GROUPS.format(facts="facts")}), r as ({ROWS.format(groups="g")}), cols as ({COLUMNS.format(rows="r")}), x as (select r.* from r join cols on cols.company = r.company and cols.coordinate = r.coordinate),
    growth as (select c.company as company, q.row_id as row_id, c.coordinate as coordinate, d.metric as metric, case when e.company is null then 'PREDECESSOR_PERIOD_NOT_DECLARED' else {_CODE} end as code, case when b.value <> 0 then cast(a.value - b.value as double) / cast(b.value as double) * 100 end as v
      from (select distinct company, row_id from x) q join cols c on c.company = q.company cross join (values ('QOQ_GROWTH', 1), ('YOY_GROWTH', 4)) d(metric, back) left join x a on a.company = c.company and a.row_id = q.row_id and a.coordinate = c.coordinate
      left join cols e on e.company = c.company and e.coordinate = c.coordinate - d.back left join x b on b.company = c.company and b.row_id = q.row_id and b.coordinate = c.coordinate - d.back),
    shares as (select a.company as company, a.row_id as row_id, a.coordinate as coordinate, {_CODE} as code, case when b.value <> 0 then cast(a.value as double) / cast(b.value as double) * 100 end as v from x a join x b on a.linked and b.company = a.company and b.coordinate = a.coordinate and b.line_id = a.parent_line_id
      where not exists (select 1 from x o where o.company = b.company and o.coordinate = b.coordinate and o.line_id = b.line_id and o.row_id <> b.row_id)),
    one as (select company, coordinate, role, count(*) as n, min(row_id) as row_id from x where role is not null group by 1, 2, 3),
    margins as (select c.company as company, c.coordinate as coordinate, d.metric as metric, case when coalesce(p.n, 0) > 1 or coalesce(q.n, 0) > 1 then 'MULTIPLE_CANDIDATES' else {_CODE} end as code, case when b.value <> 0 then cast(a.value as double) / cast(b.value as double) * 100 end as v
      from cols c cross join (values ('GROSS_MARGIN', 'GROSS_PROFIT'), ('OPERATING_MARGIN', 'OPERATING_INCOME')) d(metric, role) left join one p on p.company = c.company and p.coordinate = c.coordinate and p.role = d.role left join one q on q.company = c.company and q.coordinate = c.coordinate and q.role = 'REVENUE'
      left join x a on a.company = c.company and a.coordinate = c.coordinate and a.row_id = p.row_id left join x b on b.company = c.company and b.coordinate = c.coordinate and b.row_id = q.row_id)
    select company, row_id, coordinate, metric, code, case when code is null then v end as value from growth union all select company, row_id, coordinate, 'COMPONENT_SHARE', code, case when code is null then v end from shares union all select company, null, coordinate, metric, code, case when code is null then v end from margins""",
)
def c12(t: Tables) -> DataFrame:
    groups = written(t.spark.sql(GROUPS, facts=t.facts), "pivot")
    rows = t.spark.sql(ROWS, groups=groups)
    columns = t.spark.sql(COLUMNS, rows=rows)
    return M.quarterly_metrics(rows, columns).select("company", "row_id", "coordinate", "metric", "code", "value")
