"""Company-stable ids of concepts, axes and members over filings, each with the evidence that it continues an earlier one."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asofworks.functions.scalars import gaap_namespace_year, reasons

#: Columns of a row: one for each filing and raw id; position is the filing's place in the company's order.
CONCEPTS = "cik, kind, filing_id, position, raw_id, local_name, qname, namespace_uri, is_standard, taxonomy_family, label, period_type, data_type, balance, abstract, signature"
#: Documented relations that break continuity; arc roles that are no structure, and those that are, by network.
BREAKS = ("RECAST", "SPLIT", "MERGED")
RESOURCES = ("http://www.xbrl.org/2003/arcrole/concept-label", "http://www.xbrl.org/2003/arcrole/concept-reference", "http://xbrl.org/arcrole/2008/element-label", "http://xbrl.org/arcrole/2008/element-reference")
STRUCTURES = {
    "PRE": ("http://www.xbrl.org/2003/arcrole/parent-child",),
    "CAL": ("http://www.xbrl.org/2003/arcrole/summation-item", "https://xbrl.org/2023/arcrole/summation-item"),
    "DEF": (*[f"http://xbrl.org/int/dim/arcrole/{n}" for n in ("all", "notAll", "hypercube-dimension", "dimension-domain", "domain-member", "dimension-default")], *[f"http://www.xbrl.org/2003/arcrole/{n}" for n in ("general-special", "essence-alias", "similar-tuples", "requires-element")]),
}


def _given(c: str | Column) -> Column:
    """c, with blank text as null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c != "", c)


def namespace_family(uri: Column) -> Column:
    """A namespace less the year or day at its end, if that is one."""
    version = F.regexp_extract(uri, r"/((?:19|20)\d{2}(?:\d{4})?)$", 1)
    dated = (F.length(version) == 4) | F.try_to_date(version, "yyyyMMdd").isNotNull()
    return F.when((version != "") & dated, F.concat(F.substring(uri, F.lit(1), F.length(uri) - F.length(version)), F.lit("{version}"))).otherwise(uri)


def network_signatures(concepts: DataFrame, arcs: DataFrame) -> DataFrame:
    """(filing_id, raw_id, signature): the arcs that touch a concept, without order, roles and names freed of years.

    arcs has filing_id, network_type, role_uri, arcrole, link_qname, arc_qname,
    from_raw_id, to_raw_id, target_role_uri, weight, usable, closed,
    context_element.  Links to labels and references are left out.  A concept
    with any other arc of an unknown kind, or with one that lacks a field or
    whose ends lack names or semantics, has no signature (null): it proves nothing.
    """
    whole = F.col("_namespace").isNotNull() & F.col("_name").isNotNull() & _given("period_type").isNotNull() & _given("data_type").isNotNull()
    ends = concepts.select("filing_id", F.col("raw_id").alias("_id"), _given("namespace_uri").alias("_namespace"), _given("local_name").alias("_name"), "period_type", "data_type", "balance", "abstract")
    ends = ends.select("filing_id", "_id", F.when(whole, F.to_json(F.struct(namespace_family(F.col("_namespace")).alias("n"), "_name", "period_type", "data_type", "balance", "abstract"))).alias("_identity"))
    rows = arcs.where(~F.coalesce(F.col("arcrole").isin(*RESOURCES), F.lit(False)))
    for side in ("from", "to"):
        rows = rows.join(ends.select("filing_id", F.col("_id").alias(f"{side}_raw_id"), F.col("_identity").alias(f"_{side}")), ["filing_id", f"{side}_raw_id"], "left")
    known = reduce(lambda a, b: a | b, [(F.col("network_type") == n) & F.col("arcrole").isin(*roles) for n, roles in STRUCTURES.items()])
    fine = F.coalesce(known, F.lit(False))
    for c in ("role_uri", "link_qname", "arc_qname", "_from", "_to"):
        fine = fine & F.coalesce(F.col(c) != "", F.lit(False))
    rows = rows.withColumn("_fine", fine).select("*", F.explode(F.array_distinct(F.array("from_raw_id", "to_raw_id"))).alias("raw_id")).where("raw_id is not null")
    own = concepts.select("filing_id", "raw_id", F.col("namespace_uri").alias("_own"))
    rows = rows.join(own, ["filing_id", "raw_id"])
    freed = lambda c: F.when(F.startswith(F.col(c), F.concat("_own", F.lit("/"))), F.concat(namespace_family(F.col("_own")), F.substring(F.col(c), F.length("_own") + 1, F.length(c)))).otherwise(F.col(c))
    one = F.to_json(F.struct("network_type", freed("role_uri").alias("role"), "arcrole", "link_qname", "arc_qname", "_from", "_to", freed("target_role_uri").alias("target"), "weight", "usable", "closed", "context_element"))
    out = rows.groupBy("filing_id", "raw_id").agg(F.bool_and("_fine").alias("_fine"), F.array_sort(F.collect_set(F.when(F.col("_fine"), one))).alias("_all"))
    return out.select("filing_id", "raw_id", F.when(F.col("_fine"), F.sha2(F.array_join("_all", "\n"), 256)).alias("signature"))


def _named(rows: DataFrame) -> DataFrame:
    """rows with d: of the earlier rows that documented names the newest, and its relation."""
    own = F.array(F.struct(*[F.lit(None).cast("string").alias(c) for c in ("prior_raw_id", "relation")]))
    # a row stands there once as itself, and once for each row that it names
    rows = rows.select("*", F.posexplode(F.coalesce(F.concat(own, "documented"), own)).alias("_n", "_asked"))
    rows = rows.withColumn("_key", F.when(F.col("_n") == 0, F.col("raw_id")).otherwise(F.col("_asked.prior_raw_id")))
    rows = rows.withColumn("_then", F.max(F.when(F.col("_n") == 0, F.col("position"))).over(Window.partitionBy("cik", "kind", "_key")))
    earlier = F.expr("_n > 0 and cik is not null and kind is not null and _key is not null and (_then < position or (_then = position and _key < raw_id))")
    found = F.struct("_then", F.col("_key").alias("prior"), F.upper(F.coalesce("_asked.relation", F.lit("RECAST"))).alias("relation"))
    rows = rows.withColumn("d", F.max(F.when(earlier, found)).over(Window.partitionBy("cik", "kind", "raw_id")))
    return rows.where("_n = 0").drop("documented", "_n", "_asked", "_key", "_then")


def canonical_ids(concepts: DataFrame, changes: DataFrame) -> DataFrame:
    """One row for each row of concepts (see CONCEPTS) with its canonical_id and why it has it.

    A row continues the newest row that stands before it, by filing and raw id,
    under the first rule that fits:
    1. a documented change (cik, raw_id, prior_raw_ids, relation) names it:
       DOCUMENTED_, confidence 1; RECAST, SPLIT and MERGED break continuity.
    2. both are standard, of one name, and equal in period type, data type,
       balance and abstractness, the first two given: of one namespace
       (EXACT_STANDARD_TAXONOMY), or both in official yearly namespaces
       (STANDARD_US_GAAP_NAMESPACE_CONTINUITY), confidence 1.
    3. both are custom and of one name; only the newest such row counts, never an
       older one of a shape that has come back.  With equal label, semantics,
       namespace family and network signature, all given and neither repeated in
       its filing, SAME or (other namespace) RENAMED, confidence 0.9; else
       UNCERTAIN, 0.35, with the reasons against it.
    4. it has the same label or name: UNCERTAIN, 0.35.
    Otherwise a row is new: SAME, confidence 1; a custom name repeated within its
    filing is UNCERTAIN, 0.  Only confirmed continuations take over the id of the
    row that they continue, through any number of filings; all others keep one of
    their own.  raw_id is unique within a company and kind.

    Rows and changes are dealt by company, once; see dealt_ids().
    """
    asked = changes.select("cik", "raw_id", "relation", F.explode("prior_raw_ids").alias("prior_raw_id")).repartition("cik")
    asked = asked.groupBy("cik", "raw_id").agg(F.collect_list(F.struct("prior_raw_id", "relation")).alias("documented"))
    return _ids(concepts.repartition("cik").join(asked, ["cik", "raw_id"], "left"), _rounds(concepts))


def dealt_ids(rows: DataFrame) -> DataFrame:
    """canonical_ids() of rows that have been dealt by cik, each with its own changes: documented, an array of (prior_raw_id, relation).

    Nothing is dealt again or written: the evidence, the rows that changes name
    and each round along the chains are windows within a company.
    """
    return _ids(rows, _rounds(rows))


def _rounds(rows: DataFrame) -> int:
    """Rounds of doubling that reach the end of any chain: a chain has at most the rows of its company."""
    most = rows.groupBy("cik").count().agg(F.max("count")).first()[0] or 1
    return math.ceil(math.log2(most))


def _ids(rows: DataFrame, rounds: int) -> DataFrame:
    text = lambda c: F.coalesce(_given(c), F.lit(""))
    label = F.lower(F.trim(F.regexp_replace(F.coalesce(_given("label"), text("local_name")), r"\s+", " ")))
    name = F.when(F.col("is_standard"), F.coalesce(_given("local_name"), F.when(F.contains("qname", F.lit(":")), F.regexp_extract("qname", r"([^:]*)$", 1)), F.lit(""))).otherwise(text("local_name"))
    yearly = gaap_namespace_year("namespace_uri").isNotNull() & (F.lower(text("taxonomy_family")) == "us-gaap")
    meant = F.when(_given("period_type").isNotNull() & _given("data_type").isNotNull(), F.to_json(F.struct("period_type", "data_type", "balance", "abstract"), {"ignoreNullFields": "false"}))
    rows = _named(rows).withColumn("is_standard", F.coalesce("is_standard", F.lit(False))).withColumns({"_label": label, "_name": name, "_group": F.when(yearly, "us-gaap").otherwise(text("namespace_uri")), "_meant": meant})
    by = lambda *keys: Window.partitionBy("cik", "kind", *keys)
    newest = lambda fields, *keys: F.lag(F.struct(*fields)).over(by(*keys).orderBy("position", "raw_id"))
    place, evidence = ("position", "raw_id", "namespace_uri"), ("raw_id", "namespace_uri", "filing_id", "label", "_label", "_meant", "signature", "_ambiguous")
    rows = rows.withColumn("_ambiguous", ~F.col("is_standard") & (F.count("*").over(by("filing_id", "is_standard", "_name")) > 1))
    rows = rows.withColumn("_by_group", newest(place, "is_standard", "_name", "_meant", "_group")).withColumn("_by_uri", newest(place, "is_standard", "_name", "_meant", "namespace_uri")).withColumn("_custom", newest(evidence, "is_standard", "_name")).withColumn("_alike", newest(("raw_id",), "_label"))
    standard = F.col("is_standard") & (F.col("_name") != "") & F.col("_meant").isNotNull()
    later = F.coalesce(F.when(F.col("_by_uri.position").isNull() | (F.struct("_by_group.position", "_by_group.raw_id") >= F.struct("_by_uri.position", "_by_uri.raw_id")), F.col("_by_group")), F.col("_by_uri"))
    rows = rows.withColumn("_std", F.when(standard, later)).withColumn("_own", F.when(~F.col("is_standard"), F.col("_custom"))).withColumn("_text", F.when(F.col("_label") != "", F.col("_alike")))
    own, family = F.col("_own"), namespace_family(F.col("namespace_uri"))
    unlike = lambda c: ~F.col(c).eqNullSafe(own[c])
    missing = lambda c: _given(c).isNull() | _given(own[c]).isNull()
    against = reasons(
        (F.col("_ambiguous") | own["_ambiguous"], "AMBIGUOUS_CUSTOM_LOCAL_IDENTITY"), (missing("label"), "EXPLICIT_LABEL_MISSING"), (~missing("label") & unlike("_label"), "EXPLICIT_LABEL_CHANGED"),
        (F.col("_meant").isNull() | unlike("_meant"), "SEMANTIC_FINGERPRINT_INCOMPATIBLE"), (~family.eqNullSafe(namespace_family(own["namespace_uri"])), "CUSTOM_NAMESPACE_OWNER_OR_FAMILY_CHANGED"),
        (missing("signature"), "COMPLETE_QUALIFIED_NETWORK_EVIDENCE_MISSING"), (~missing("signature") & unlike("signature"), "QUALIFIED_NETWORK_STRUCTURE_CHANGED"),
    )
    rows = rows.withColumn("_against", F.when(own.isNotNull(), F.when(F.size(against) == 0, F.when((F.col("filing_id") == own["filing_id"]) | (F.col("_name") == "") | missing("namespace_uri"), F.array(F.lit("LATEST_PRIOR_CUSTOM_IDENTITY_REQUIRES_REVIEW"))).otherwise(against)).otherwise(against)))
    fits = F.size("_against") == 0
    found = lambda prior, relation, method, confidence, confirmed: F.struct(prior.alias("prior"), relation.alias("relation"), method.alias("method"), F.lit(confidence).alias("confidence"), F.lit(confirmed).alias("confirmed"))
    lit = F.lit
    same_uri = F.col("namespace_uri").eqNullSafe(F.col("_std.namespace_uri"))
    decision = F.coalesce(
        F.when(F.col("d").isNotNull(), found(F.col("d.prior"), F.col("d.relation"), F.concat(lit("DOCUMENTED_"), "d.relation"), 1.0, True)),
        F.when(F.col("_std").isNotNull(), found(F.col("_std.raw_id"), lit("SAME"), F.when(same_uri, "EXACT_STANDARD_TAXONOMY").otherwise("STANDARD_US_GAAP_NAMESPACE_CONTINUITY"), 1.0, True)),
        F.when(own.isNotNull() & fits, found(own["raw_id"], F.when(F.col("namespace_uri") == own["namespace_uri"], "SAME").otherwise("RENAMED"), lit("CUSTOM_SEMANTIC_NETWORK_CONTINUITY"), 0.9, True)),
        F.when(own.isNotNull(), found(own["raw_id"], lit("UNCERTAIN"), F.when((F.col("_label") != "") & (F.col("_label") == own["_label"]), "STRING_SIMILARITY_ONLY").otherwise("CUSTOM_EVIDENCE_CHANGED"), 0.35, False)),
        F.when(F.col("_text").isNotNull(), found(F.col("_text.raw_id"), lit("UNCERTAIN"), lit("STRING_SIMILARITY_ONLY"), 0.35, False)),
        F.when(F.col("_ambiguous"), found(lit(None).cast("string"), lit("UNCERTAIN"), lit("AMBIGUOUS_CUSTOM_LOCAL_IDENTITY"), 0.0, False)),
        found(lit(None).cast("string"), lit("SAME"), lit("RAW_IDENTITY_BASELINE"), 1.0, True),
    )
    rows = rows.withColumn("_x", decision).withColumn("_break", F.col("_x.relation").isin(*BREAKS) & F.col("_x.prior").isNotNull())
    key = F.concat_ws(":", F.col("cik").cast("string"), "kind", "raw_id")
    rows = rows.withColumn("_id", F.when(F.col("_break"), F.concat_ws(":", key, lit("recast"), F.col("filing_id").cast("string"))).otherwise(key))
    event = (
        F.when(F.col("_x.prior").isNull(), F.concat(lit("NEW_"), F.upper("kind"))).when(F.col("_break") & (F.col("_x.relation") == "SPLIT"), "SPLIT").when(F.col("_break") & (F.col("_x.relation") == "MERGED"), "MERGE").when(F.col("_break") & (F.col("kind") == "member"), "SEGMENT_RECAST")
        .when(F.col("_break"), "UNKNOWN_CHANGE").when((F.col("_x.relation") == "RENAMED") & (F.col("kind") == "member"), "MEMBER_RENAME").when(F.col("_x.relation") == "UNCERTAIN", "UNKNOWN_CHANGE")
    )
    review = F.when(F.col("_x.prior").isNull(), F.col("_ambiguous")).otherwise(~F.col("_x.confirmed"))
    rows = rows.select("cik", "kind", "filing_id", "raw_id", F.col("_x.prior").alias("prior_raw_id"), F.col("_x.relation").alias("relation"), F.col("_x.method").alias("method"), F.col("_x.confidence").alias("confidence"), F.col("_break").alias("continuity_break"), review.alias("review_required"), F.when(F.col("_x.method").isin("STRING_SIMILARITY_ONLY", "CUSTOM_EVIDENCE_CHANGED"), F.col("_against")).alias("rejections"), event.alias("event"), F.col("_id").alias("own_id"))
    return _followed(rows, rounds)


def _followed(rows: DataFrame, rounds: int) -> DataFrame:
    """rows with canonical_id: the own id of the row at the end of the chain of confirmed continuations.

    Each round doubles the steps taken.  A row that goes on stands there twice,
    as itself and for the row that it has come to, of which it takes the id and
    the next step.
    """
    goes_on = F.col("prior_raw_id").isNotNull() & ~F.col("continuity_break") & ~F.col("review_required") & F.col("cik").isNotNull() & F.col("kind").isNotNull()
    rows = rows.withColumnRenamed("own_id", "canonical_id").withColumn("_to", F.when(goes_on, F.col("prior_raw_id")))
    for _ in range(rounds):
        rows = rows.withColumn("_asks", F.explode(F.when(F.col("_to").isNull(), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))))
        rows = rows.withColumn("_key", F.when(F.col("_asks"), F.col("_to")).otherwise(F.col("raw_id")))
        there = F.max(F.when(~F.col("_asks"), F.struct("canonical_id", "_to"))).over(Window.partitionBy("cik", "kind", "_key"))
        rows = rows.withColumn("_there", there).where("_asks or _to is null")
        rows = rows.withColumns({"canonical_id": F.when(F.col("_asks"), F.coalesce("_there.canonical_id", "canonical_id")).otherwise(F.col("canonical_id")), "_to": F.when(F.col("_asks"), F.col("_there._to"))})
        rows = rows.drop("_asks", "_key", "_there")
    return rows.drop("_to")
