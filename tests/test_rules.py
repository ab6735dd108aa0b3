import json
import random
import re

import pytest
from pyspark.sql import functions as F

from coldkeep.operators.rules import (
    exclude,
    literal_prefix,
    match_rules,
    matching,
    purge_target_violations,
    rule_sources,
    rule_violations,
    target_collisions,
)
from coldkeep.plans.archive import archive_many
from coldkeep.plans.plan import plan, plan_documents
from coldkeep.sources.connections import Connection
from coldkeep.sources.documents import parse_rules


def document(tables, schema="OWN", exclude_tables=None, **source):
    return {
        "env": "dev",
        "connections": {"c": "prod_c"},
        "warehouses": {"w": "s3://vault/"},
        "retention_policies": {"half": "6m"},
        "sources": [
            {
                "name": "s", "connection": "c", "warehouse": "w", "retention_policy": "half",
                "legal_hold": False,
                "include": {"schemas": [{"name": schema, "tables": tables}]},
                "exclude": {"tables": exclude_tables} if exclude_tables else {},
                **source,
            }
        ],
    }


def docs(spark, *documents):
    rows = [(d if isinstance(d, str) else json.dumps(d),) for d in documents]
    return spark.createDataFrame(rows, "document string")


CATALOGUE = [("OWN", t) for t in ("FEED", "FEED_BATCH", "feed", "FEED_B", "XFEED")] + [("OTHER", "FEED")]


def matched(spark, tables, **kw):
    cat = spark.createDataFrame(CATALOGUE, "schema string, table string")
    rules = parse_rules(docs(spark, document(tables, **kw)))
    return sorted((r.table, r.condition) for r in match_rules(rule_sources(rules), cat).collect())


def test_pattern_matches_from_the_start(spark):
    got = matched(spark, [{"name": "FEED", "regex": True}])
    assert got == [("FEED", None), ("FEED_B", None), ("FEED_BATCH", None)]


def test_name_is_exact_and_case_sensitive(spark):
    assert matched(spark, [{"name": "feed", "condition": "x < 1"}]) == [("feed", "x < 1")]


def test_alternation_stays_anchored(spark):
    assert [t for t, _ in matched(spark, [{"name": "FEED_|EED", "regex": True}])] == ["FEED_B", "FEED_BATCH"]


def test_first_rule_wins(spark):
    tables = [{"name": "FEED_B", "condition": "one"}, {"name": "FEED", "regex": True, "condition": "two"}]
    assert matched(spark, tables) == [("FEED", "two"), ("FEED_B", "one"), ("FEED_BATCH", "two")]


def test_first_rule_wins_over_schemas_listed_twice(spark):
    d = document([{"name": "FEED", "condition": "one"}])
    d["sources"][0]["include"]["schemas"].append(
        {"name": "OWN", "tables": [{"name": "FEED", "condition": "two"}, {"name": "XFEED"}]}
    )
    cat = spark.createDataFrame(CATALOGUE, "schema string, table string")
    got = match_rules(rule_sources(parse_rules(docs(spark, d))), cat)
    assert sorted((r.table, r.condition) for r in got.collect()) == [("FEED", "one"), ("XFEED", None)]


def test_exclude(spark):
    got = matched(spark, [{"name": "FEED", "regex": True}], exclude_tables=["FEED_B"])
    assert got == [("FEED", None)]
    cat = spark.createDataFrame(CATALOGUE, "schema string, table string")
    assert sorted(r.table for r in exclude(cat, ["FEED"]).collect()) == ["XFEED", "feed"]
    assert exclude(cat, []).count() == len(CATALOGUE)


def test_plan(spark):
    sql = "SELECT * FROM OWN.H WHERE T = 'x'"
    tables = [{"name": "FEED", "condition": "ID < 1"}, {"query": sql, "target_table": "OWN_H"}]
    cat = spark.createDataFrame(CATALOGUE, "schema string, table string")
    rows = plan(parse_rules(docs(spark, document(tables))), cat).orderBy("target_table").collect()
    assert [(r.source_table, r.query, r.condition, r.target_table) for r in rows] == [
        ("FEED", None, "ID < 1", "OWN_FEED"),
        (None, sql, None, "OWN_H"),
    ]
    assert rows[0].target_path == "s3://vault/c/OWN/FEED/" and rows[1].target_path.endswith("/OWN_H/")
    assert {r.target_db for r in rows} == {"archive_prod_c"}
    assert rows[0].segment == "feed" and rows[1].segment.startswith("query_")
    assert {(r.retention_policy_value, r.legal_hold) for r in rows} == {("6m", False)}


def test_collisions(spark):
    df = spark.createDataFrame([("d", "S_Feed"), ("d", "S_FEED"), ("e", "s_feed")], "target_db string, target_table string")
    assert [tuple(r) for r in target_collisions(df).collect()] == [("d", "s_feed", 2, "duplicate_target")]


def broken(spark, *documents):
    return sorted(r.rule for r in rule_violations(docs(spark, *documents)).collect())


def test_good_document(spark):
    tables = [{"name": "A", "condition": "x"}, {"query": "q", "target_table": "t"}]
    assert broken(spark, document(tables, consumer_roles=["r"])) == []


@pytest.mark.parametrize("key", ["env", "warehouses", "connections", "sources", "retention_policies"])
def test_missing_keys(spark, key):
    d = document([])
    del d[key]
    assert f"missing_{key}" in broken(spark, d)


@pytest.mark.parametrize(
    "change,rule",
    [
        ({"warehouse": "v"}, "unknown_warehouse"),
        ({"warehouse": None}, "unknown_warehouse"),
        ({"connection": 1}, "unknown_connection"),
        ({"retention_policy": "x"}, "unknown_retention_policy"),
        ({"legal_hold": "true"}, "legal_hold_not_boolean"),
        ({"legal_hold": None}, "legal_hold_not_boolean"),
        ({"consumer_roles": []}, "consumer_roles_not_a_filled_list"),
        ({"consumer_roles": "r"}, "consumer_roles_not_a_filled_list"),
        ({"consumer_roles": ["r", " "]}, "consumer_roles_blank_entry"),
        ({"consumer_roles": ["r", 7]}, "consumer_roles_blank_entry"),
        ({"include": {}}, "schemas_not_a_filled_list"),
        ({"include": {"schemas": {"name": "x"}}}, "schemas_not_a_filled_list"),
        ({"include": {"schemas": [{"tables": []}]}}, "schema_without_name"),
        ({"include": {"schemas": [{"name": "s", "tables": "A"}]}}, "tables_not_a_list"),
    ],
)
def test_source_rules(spark, change, rule):
    assert broken(spark, document([], **change)) == [rule]


@pytest.mark.parametrize(
    "entry,rules",
    [
        ({"name": "A", "query": "q", "target_table": "t"}, ["not_exactly_one_of_name_and_query"]),
        ({}, ["not_exactly_one_of_name_and_query"]),
        ({"name": " "}, ["not_exactly_one_of_name_and_query"]),
        ({"query": "q"}, ["query_without_target_table"]),
        ({"query": "q", "target_table": 7}, ["query_without_target_table"]),
        ({"query": "q", "target_table": "t", "condition": "c"}, ["query_with_condition"]),
        ({"name": "A", "condition": ""}, []),
    ],
)
def test_entry_rules(spark, entry, rules):
    assert broken(spark, document([{"name": "OK"}, entry])) == rules


def test_null_roles_are_absent(spark):
    assert broken(spark, document([], consumer_roles=None)) == []


def test_unreadable(spark):
    assert "unreadable" in broken(spark, "{oops")


def test_violation_names_its_place(spark):
    row = rule_violations(docs(spark, document([{"name": "A"}, {"query": "q"}]))).head()
    assert (row.source_idx, row.schema, row.entry) == (0, "OWN", 1)


@pytest.mark.parametrize(
    "doc,rules",
    [
        ({"targets": [{"source_name": "s", "connection": "c"}]}, []),
        ({"targets": []}, ["no_targets"]),
        ({}, ["no_targets"]),
        ({"targets": [{}]}, ["missing_connection", "missing_source_name"]),
        ("{", ["unreadable"]),
    ],
)
def test_purge_targets(spark, doc, rules):
    assert sorted(r.rule for r in purge_target_violations(docs(spark, doc)).collect()) == rules


@pytest.mark.parametrize(
    "pattern,prefix",
    [
        ("FEED", "FEED"), ("FEED_[0-9]+", "FEED_"), ("FEED*", "FEE"), ("F?", ""), ("AB{2}", "A"), ("AB+C", "AB"),
        ("FEED_|EED", ""), ("(A|B)C", ""), ("(?i)feed", ""), (".*X", ""), ("^FEED", ""), ("A\\.B", "A"), ("", ""),
    ],
)
def test_literal_prefix(spark, pattern, prefix):
    df = spark.createDataFrame([(pattern,)], "p string")
    assert df.select(literal_prefix(F.col("p"))).head()[0] == prefix


def test_many_rules_and_tables(spark):
    """A thousand rules of every kind, a hundred thousand tables: the same as trying each in turn."""
    rng = random.Random(1)
    rules = []
    for i in range(1000):
        name = f"T{rng.randint(0, 9999):04d}"
        kind = i % 10
        if kind < 4:
            rules.append({"name": f"{name}_{rng.randint(0, 9)}", "condition": f"c{i}"})
        elif kind < 9:
            tail = rng.choice(("", "_[0-4]$", "*", "+_", "_(1|3)"))
            rules.append({"name": name + tail, "regex": True, "condition": f"c{i}"})
        else:
            rules.append({"name": f".*{rng.randint(100, 999)}_{rng.randint(0, 9)}$", "regex": True, "condition": f"c{i}"})
    bans = ["T00", "T1.*_7$", "T2345_1"]
    tables = [f"T{i // 10:04d}_{i % 10}" for i in range(100_000)]
    cat = spark.createDataFrame([("OWN", t) for t in tables], "schema string, table string")
    found = match_rules(rule_sources(parse_rules(docs(spark, document(rules, exclude_tables=bans)))), cat)
    got = {r.table: (r.condition, r.entry) for r in found.select("table", "condition", "entry").collect()}
    literal = {}
    for i, r in enumerate(rules):
        if not r.get("regex"):
            literal.setdefault(r["name"], i)
    tried = [(i, re.compile(r["name"])) for i, r in enumerate(rules) if r.get("regex")]
    ban = re.compile("|".join(f"(?:{b})" for b in bans))
    for t in rng.sample(tables, 2000):
        first = next((i for i, p in tried if p.match(t)), None)
        hits = [i for i in (first, literal.get(t)) if i is not None]
        want = (f"c{min(hits)}", min(hits)) if hits and not ban.match(t) else None
        assert got.get(t) == want
    assert len(got) == found.count()


def test_tables_meet_only_rules_that_can_match(spark):
    """The index leaves a table few patterns to try."""
    texts = spark.createDataFrame([(f"T{i:04d}",) for i in range(500)], "t string").withColumn("g", F.lit(1))
    patterns = spark.createDataFrame([(f"T{i:04d}.*",) for i in range(500)], "pattern string").withColumn("g", F.lit(1))
    found = matching(texts, "t", patterns, ["g"])
    assert found.count() == 500
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_prefix" in [line for line in plan.splitlines() if "Join Inner" in line][0]


def planned(spark, *documents):
    cat = spark.createDataFrame(CATALOGUE, "schema string, table string")
    return plan_documents(docs(spark, *documents), cat).collect()


def test_a_broken_entry_refuses_its_rows_only(spark):
    tables = [
        {"name": "FEED", "condition": "x"},
        {"query": "SELECT 1", "target_table": "A", "condition": "y"},
        {"query": "SELECT 2"},
        {"query": "SELECT 3", "target_table": "C"},
        {"name": "XFEED", "query": "SELECT 4", "target_table": "D"},
    ]
    got = {(r.source_table or r.query): r.refused for r in planned(spark, document(tables))}
    assert got == {
        "FEED": None,
        "SELECT 1": "query_with_condition",
        "SELECT 2": "unknown_target_path, query_without_target_table",
        "SELECT 3": None,
        "SELECT 4": "not_exactly_one_of_name_and_query",
    }


def test_a_broken_source_refuses_its_rows_only(spark):
    good, bad = document([{"name": "FEED"}]), document([{"name": "FEED_B"}], legal_hold="no", consumer_roles=[])
    both = good | {"sources": good["sources"] + bad["sources"]}
    got = {r.source_table: r.refused for r in planned(spark, both)}
    assert got == {"FEED": None, "FEED_B": "unknown_legal_hold, consumer_roles_not_a_filled_list, legal_hold_not_boolean"}


def test_a_broken_document_refuses_all_its_rows(spark):
    good = document([{"name": "FEED"}])
    bad = document([{"name": "FEED_B"}, {"name": "XFEED"}])
    del bad["env"]
    got = {r.source_table: r.refused for r in planned(spark, good, bad)}
    assert got == {"FEED": None, "FEED_B": "missing_env", "XFEED": "missing_env"}


def test_a_schema_without_name_refuses_only_itself(spark):
    d = document([{"name": "FEED"}])
    d["sources"][0]["include"]["schemas"].append({"tables": [{"query": "SELECT 1", "target_table": "T"}]})
    d["sources"][0]["include"]["schemas"].append({"name": "OTHER", "tables": {"name": "FEED"}})
    got = {(r.source_schema, r.source_table or r.query): r.refused for r in planned(spark, d)}
    assert got[("OWN", "FEED")] is None
    assert "schema_without_name" in got[(None, "SELECT 1")]
    assert not any(schema == "OTHER" for schema, _ in got)


def test_unreadable_documents_plan_nothing(spark):
    assert planned(spark, "{oops") == []


def test_two_rows_of_one_target_are_refused(spark):
    tables = [{"query": "SELECT 1", "target_table": "A"}, {"query": "SELECT 2", "target_table": "a"}, {"name": "FEED"}]
    got = {(r.source_table or r.query): r.refused for r in planned(spark, document(tables))}
    assert got == {"SELECT 1": "duplicate_target", "SELECT 2": "duplicate_target", "FEED": None}


def test_plan_without_violations_checks_what_is_known(spark):
    cat = spark.createDataFrame(CATALOGUE, "schema string, table string")
    rules = parse_rules(docs(spark, document([{"name": "FEED"}], connection="nowhere", retention_policy="never")))
    (row,) = plan(rules, cat).collect()
    assert row.refused == "unknown_connection, unknown_retention_policy_value"


def test_refused_rows_are_not_archived(spark, database):
    spark.range(3).write.saveAsTable(f"{database}.feed")
    tables = [{"name": "feed"}, {"query": f"SELECT * FROM {database}.feed", "target_table": "q", "condition": "z"}]
    cat = spark.createDataFrame([(database, "feed")], "schema string, table string")
    todo = plan_documents(docs(spark, document(tables, schema=database)), cat)
    todo = todo.withColumn("target_db", F.lit(database))
    runs = {r.script_args.get("--query"): r for r in archive_many(spark, todo, Connection("prod_c"), "2024-01-01").collect()}
    assert runs[None].status == "SUCCEEDED" and runs[None].rows == 3
    (refused,) = [r for q, r in runs.items() if q]
    assert (refused.status, refused.error) == ("FAILED", "refused by the plan: query_with_condition")
    assert not spark.catalog.tableExists(f"{database}.q")


def test_catalogue_with_connections(spark):
    """Schemas of one name in two databases are not mixed up."""
    cat = spark.createDataFrame([("OWN", "FEED", "c"), ("OWN", "FEED_B", "d")], "schema string, table string, connection string")
    rules = parse_rules(docs(spark, document([{"name": "FEED", "regex": True}])))
    assert [r.source_table for r in plan(rules, cat).collect()] == ["FEED"]
