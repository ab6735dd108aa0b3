"""From rules and a source catalogue to the list of tables and queries to archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from coldkeep.functions.naming import archive_db, archive_path, archive_segment, archive_table
from coldkeep.operators.rules import (
    match_rules,
    query_rules,
    refusals,
    rule_sources,
    rule_violations,
    target_collisions,
)
from coldkeep.sources.documents import parse_rules

PLAN_COLUMNS = (
    "source_name",
    "connection",
    "source_schema",
    "source_table",
    "query",
    "condition",
    "target_path",
    "target_db",
    "target_table",
    "segment",
    "retention_policy_value",
    "legal_hold",
)


#: Where in which document a row comes from.
PLACE = ("document_id", "source_idx", "schema", "entry")


def plan(rules: DataFrame, catalogue: DataFrame, violations: DataFrame | None = None) -> DataFrame:
    """One row per table or query to archive, with everything `archive` needs.

    `refused` has the reasons why a row must not be carried out, NULL without any: rules that its
    document breaks at its place (`violations`, as found by `rule_violations`), something it needs
    and that isn't known, or another row that writes the same table. A broken entry refuses its own
    rows and leaves the other rows of the document alone.
    """
    sources = rule_sources(rules)
    matched = match_rules(sources, catalogue).withColumns(
        {"query": F.lit(None).cast("string"), "target_table": F.lit(None).cast("string")}
    )
    queries = query_rules(sources).withColumns(
        {"table": F.lit(None).cast("string"), "condition": F.lit(None).cast("string")}
    )
    items = enrich(matched.unionByName(queries))
    return gated(items, violations).select(*PLAN_COLUMNS, "refused")


def plan_documents(documents: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The plan of rules documents given as JSON text in `document`, checked against their own rules."""
    texts = documents.withColumn("document_id", F.sha2("document", 256))
    parsed = texts.select("document_id", "document")
    rules = parse_rules(parsed, keep=("document_id",))
    return plan(rules, catalogue, rule_violations(parsed, ("document_id",)))


def gated(items: DataFrame, violations: DataFrame | None = None) -> DataFrame:
    """Add `refused` to enriched rows, see `plan`."""
    taken = target_collisions(items).select(
        F.col("target_db").alias("_db"), F.col("target_table").alias("_table"), F.col("rule").alias("_taken")
    )
    lower = F.lower("target_table")
    same = F.col("target_db").eqNullSafe(F.col("_db")) & lower.eqNullSafe(F.col("_table"))
    if violations is None:
        checked = items.withColumn("broken", F.array().cast("array<string>"))
    else:
        if "document_id" not in violations.columns:
            violations = violations.withColumn("document_id", F.lit(""))
        checked = refusals(items, violations)
    reasons = [F.col("_taken")]
    for needed in ("connection", "target_path", "retention_policy_value", "legal_hold"):
        reasons.append(F.when(F.col(needed).isNull(), F.lit(f"unknown_{needed}")))
    text = F.concat_ws(", ", *reasons, "broken")
    joined = checked.join(taken, same, "left").withColumn("refused", F.when(text != "", text))
    return joined.select(*items.columns, "refused")


def enrich(items: DataFrame) -> DataFrame:
    """Look up connection, warehouse and retention value, and name the target."""
    name = F.coalesce("target_table", archive_table(F.col("schema"), F.col("table")))
    folder = F.coalesce("target_table", "table")
    warehouse = F.element_at("warehouses", F.col("warehouse"))
    connection = F.element_at("connections", F.col("connection"))
    return items.select(
        F.col("name").alias("source_name"),
        connection.alias("connection"),
        F.col("schema").alias("source_schema"),
        F.col("table").alias("source_table"),
        "query",
        "condition",
        archive_path(warehouse, F.col("connection"), F.col("schema"), folder).alias("target_path"),
        archive_db(connection).alias("target_db"),
        name.alias("target_table"),
        archive_segment(F.col("table"), F.col("query")).alias("segment"),
        F.element_at("retention_policies", F.col("retention_policy")).alias(
            "retention_policy_value"
        ),
        "legal_hold",
        *PLACE,
    ).select(*PLAN_COLUMNS, *PLACE)
