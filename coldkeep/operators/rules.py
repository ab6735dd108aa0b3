"""Rules that choose what to archive, matched against a catalogue, and checks of the rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def rule_sources(rules: DataFrame) -> DataFrame:
    """One row per source of a rules document, with the document's lookup maps beside it.

    `document_id` tells documents apart; without this column there is one document.
    """
    given = "document_id" in rules.columns
    document = F.col("document_id") if given else F.lit("").alias("document_id")
    return rules.select(
        document, "warehouses", "connections", "retention_policies", F.posexplode("sources")
    ).select(
        "document_id",
        F.col("pos").alias("source_idx"),
        "col.*",
        "warehouses",
        "connections",
        "retention_policies",
    )


def starts_like(text: Column, pattern: Column) -> Column:
    """True where the regular expression matches from the first character on."""
    return F.rlike(text, F.concat(F.lit("^(?:"), pattern, F.lit(")")))


def exclude(catalogue: DataFrame, patterns: list[str]) -> DataFrame:
    """Catalogue entries whose table name starts with none of the patterns."""
    banned = F.lit(False)
    for pattern in patterns:
        banned = banned | starts_like(F.col("table"), F.lit(pattern))
    return catalogue.filter(~banned)


def literal_prefix(pattern: Column) -> Column:
    """Letters, digits and underscores that every match of a pattern begins with; maybe none.

    A quantifier may do without the letter before it, and an alternation without all of them.
    """
    begin = F.regexp_extract(pattern, r"^([A-Za-z0-9_]*)(?![*?{])", 1)
    return F.when(F.contains(pattern, F.lit("|")), F.lit("")).otherwise(begin)


def matching(texts: DataFrame, text: str, patterns: DataFrame, on: list[str]) -> DataFrame:
    """Pairs of a text and a `pattern` of the same `on` that matches it from its beginning.

    The literal prefix of the patterns is an index: per group of `on` the lengths of its prefixes are
    known, and a text is looked up by its own prefixes of these lengths. It is tried against the
    patterns found that way only, not against all of its group.
    """
    indexed = patterns.withColumn("_prefix", literal_prefix(F.col("pattern")))
    indexed = indexed.withColumn("_length", F.length("_prefix"))
    # One row for each group, of as many numbers as prefixes have lengths.
    lengths = indexed.groupBy(*on).agg(F.collect_set("_length").alias("_lengths"))
    keyed = (
        texts.join(lengths, on)
        .select(*texts.columns, F.explode("_lengths").alias("_length"))
        .filter(F.length(text) >= F.col("_length"))
        .withColumn("_prefix", F.expr(f"substring(`{text}`, 1, _length)"))
    )
    found = keyed.join(indexed, [*on, "_length", "_prefix"])
    return found.filter(starts_like(F.col(text), F.col("pattern"))).drop("_length", "_prefix")


def schema_entries(sources: DataFrame) -> DataFrame:
    """One row per table entry: its source, the schema, the `place` among all entries that the source
    has for this schema name, and `entry`, its position in its own list of the document."""
    schemas = sources.select("document_id", "source_idx", F.posexplode("include.schemas").alias("list", "s"))
    entries = schemas.select(
        "document_id", "source_idx", F.col("s.name").alias("schema"), "list",
        F.posexplode("s.tables").alias("entry", "rule"),
    )
    return entries.withColumn("place", F.struct("list", "entry")).drop("list")


def match_rules(sources: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Catalogue tables that a rule selects: source, schema, table, the condition if the rule has one,
    and the `entry` that the rule is. A table that is listed twice is one table.

    The first rule that names a table, or is a pattern that its name begins with, wins. Names are
    joined, patterns looked up by `matching`, the exclusions of a source alike. A `connection` column
    in the catalogue must be that of the source.
    """
    by_schema = ["schema"] + (["connection"] if "connection" in catalogue.columns else [])
    tables = catalogue.select(*by_schema, "table").distinct()
    of_source = ["document_id", "source_idx"]
    head = sources.drop("include", "exclude")
    rules = schema_entries(sources).filter("rule.name IS NOT NULL AND rule.query IS NULL")
    rules = rules.join(head.select(*of_source, "connection"), of_source)
    if len(by_schema) == 1:
        rules = rules.drop("connection")
    pattern = F.coalesce(F.col("rule.regex"), F.lit(False))
    named = tables.join(rules.filter(~pattern).withColumn("table", F.col("rule.name")), [*by_schema, "table"])
    patterns = rules.filter(pattern).withColumn("pattern", F.col("rule.name"))
    like = matching(tables, "table", patterns, by_schema).drop("pattern")
    hits = named.unionByName(like)
    key = [*of_source, *by_schema, "table"]
    first = hits.groupBy(*key).agg(F.min_by(F.struct("rule.condition", "entry"), "place").alias("first"))
    bans = sources.select(*of_source, F.explode("exclude.tables").alias("pattern"))
    banned = matching(first.select(*key), "table", bans, of_source).select(*key)
    condition = F.col("first.condition")
    return (
        first.join(banned, key, "left_anti")
        .withColumns({"condition": F.when(condition != "", condition), "entry": F.col("first.entry")})
        .drop("first")
        .join(head, of_source + by_schema[1:])
    )


def query_rules(sources: DataFrame) -> DataFrame:
    """Entries that archive a query: they need no catalogue."""
    asked = schema_entries(sources).filter("rule.query IS NOT NULL").select(
        "document_id", "source_idx", "schema", "entry", "rule.query", "rule.target_table"
    )
    return asked.join(sources.drop("include", "exclude"), ["document_id", "source_idx"])


# ---- checks of a rules document, on what was really written in it ----


def _kind(value: Column) -> Column:
    """Type of a JSON value: BOOLEAN, STRING, ARRAY, OBJECT, VOID for null; NULL if absent."""
    return F.regexp_extract(F.schema_of_variant(value), r"^([A-Z]+)", 1)


def _get(value: Column, path: str, data_type: str = "variant") -> Column:
    return F.try_variant_get(value, path, data_type)


def _text(value: Column, path: str) -> Column:
    """A string member, NULL if absent or of another type."""
    member = _get(value, path)
    return F.when(_kind(member) == "STRING", _get(value, path, "string"))


def _filled(text: Column) -> Column:
    return F.coalesce(F.trim(text) != "", F.lit(False))


def _found(name: str, condition: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(name))


def _violations(df: DataFrame, rules: dict[str, Column], *keep: Column) -> DataFrame:
    """One row per broken rule; rows that break none vanish."""
    broken = F.array_compact(F.array(*[_found(name, broken) for name, broken in rules.items()]))
    return df.select(*keep, F.explode(broken).alias("rule"))


#: Rules about a schema as a whole; those about the document or a source leave `schema` NULL as well.
SCHEMA_RULES = ("schema_without_name", "tables_not_a_list")
REQUIRED_KEYS = ("env", "warehouses", "connections", "sources", "retention_policies")


def rule_violations(documents: DataFrame, id_cols: tuple[str, ...] = ()) -> DataFrame:
    """Every broken rule of every document: (ids, source_idx, schema, entry, rule).

    `documents` has the JSON text in `document`. The checks run on the parsed value, so a text
    "true" is not a boolean and an object is not a list.
    """
    ids = [F.col(c) for c in id_cols]
    docs = documents.select(*ids, F.try_parse_json("document").alias("doc"))
    nothing = F.lit(None)
    place = (
        nothing.cast("int").alias("source_idx"),
        nothing.cast("string").alias("schema"),
        nothing.cast("int").alias("entry"),
    )
    missing = {f"missing_{key}": _get(F.col("doc"), f"$.{key}").isNull() for key in REQUIRED_KEYS}
    document_level = _violations(
        docs, {"unreadable": F.col("doc").isNull(), **missing}, *ids, *place
    )

    sources = docs.select(
        *ids, "doc", F.posexplode(_get(F.col("doc"), "$.sources", "array<variant>"))
    ).select(*ids, "doc", F.col("pos").alias("source_idx"), F.col("col").alias("src"))
    src, doc = F.col("src"), F.col("doc")

    def unknown(member: str, section: str) -> Column:
        known = F.map_keys(_get(doc, f"$.{section}", "map<string,variant>"))
        name = _text(src, f"$.{member}")
        return ~(_filled(name) & F.coalesce(F.array_contains(known, name), F.lit(False)))

    roles = _get(src, "$.consumer_roles")
    role_list = _get(src, "$.consumer_roles", "array<variant>")
    bad_role = F.exists(role_list, lambda r: ~_filled(F.when(_kind(r) == "STRING", r.cast("string"))))
    schema_list = _get(src, "$.include.schemas", "array<variant>")
    given = roles.isNotNull() & (_kind(roles) != "VOID")
    source_level = _violations(
        sources,
        {
            "unknown_warehouse": unknown("warehouse", "warehouses"),
            "unknown_connection": unknown("connection", "connections"),
            "unknown_retention_policy": unknown("retention_policy", "retention_policies"),
            "legal_hold_not_boolean": F.coalesce(_kind(_get(src, "$.legal_hold")), F.lit(""))
            != "BOOLEAN",
            "consumer_roles_not_a_filled_list": given
            & ((_kind(roles) != "ARRAY") | (F.size(role_list) == 0)),
            "consumer_roles_blank_entry": given & (_kind(roles) == "ARRAY") & bad_role,
            "schemas_not_a_filled_list": F.coalesce(F.size(schema_list), F.lit(0)) <= 0,
        },
        *ids,
        "source_idx",
        *place[1:],
    )

    schemas = sources.select(*ids, "source_idx", F.explode(schema_list).alias("sch"))
    sch = F.col("sch")
    schemas = schemas.select(
        "*",
        _get(sch, "$.name", "string").alias("schema"),
        _get(sch, "$.name").alias("name"),
        _get(sch, "$.tables").alias("tables"),
    )
    schema_level = _violations(
        schemas,
        {
            "schema_without_name": F.col("name").isNull(),
            "tables_not_a_list": F.col("tables").isNotNull() & (_kind(F.col("tables")) != "ARRAY"),
        },
        *ids,
        "source_idx",
        "schema",
        place[2],
    )

    entries = schemas.select(
        *ids, "source_idx", "schema", F.posexplode(_get(sch, "$.tables", "array<variant>"))
    ).withColumnsRenamed({"pos": "entry", "col": "t"})
    t = F.col("t")
    has_name, has_query = _filled(_text(t, "$.name")), _filled(_text(t, "$.query"))
    entry_level = _violations(
        entries,
        {
            "not_exactly_one_of_name_and_query": has_name == has_query,
            "query_without_target_table": has_query
            & ~has_name
            & (F.coalesce(_text(t, "$.target_table"), F.lit("")) == ""),
            "query_with_condition": has_query & ~has_name & _get(t, "$.condition").isNotNull(),
        },
        *ids,
        "source_idx",
        "schema",
        "entry",
    )
    return document_level.unionByName(source_level).unionByName(schema_level).unionByName(entry_level)


def purge_target_violations(documents: DataFrame, id_cols: tuple[str, ...] = ()) -> DataFrame:
    """Broken rules of purge documents: (ids, target_idx, rule)."""
    ids = [F.col(c) for c in id_cols]
    docs = documents.select(*ids, F.try_parse_json("document").alias("doc"))
    targets = _get(F.col("doc"), "$.targets", "array<variant>")
    document_level = _violations(
        docs,
        {
            "unreadable": F.col("doc").isNull(),
            "no_targets": F.col("doc").isNotNull() & (F.coalesce(F.size(targets), F.lit(0)) <= 0),
        },
        *ids,
        F.lit(None).cast("int").alias("target_idx"),
    )
    each = docs.select(*ids, F.posexplode(targets)).withColumnsRenamed(
        {"pos": "target_idx", "col": "t"}
    )
    target_level = _violations(
        each,
        {
            f"missing_{key}": _get(F.col("t"), f"$.{key}").isNull()
            for key in ("source_name", "connection")
        },
        *ids,
        "target_idx",
    )
    return document_level.unionByName(target_level)


def refusals(items: DataFrame, violations: DataFrame) -> DataFrame:
    """Add `broken`, the sorted rules that concern a row's place, to rows with the columns document_id,
    source_idx, schema and entry.

    A rule of the document concerns all of its rows, one of a source the rows of that source, and so
    on down to the single entry; a schema without a name is one whose name is NULL.
    """
    of_schema = F.col("rule").isin(*SCHEMA_RULES)
    levels = [
        ([], F.col("source_idx").isNull()),
        (["source_idx"], F.col("source_idx").isNotNull() & F.col("schema").isNull() & F.col("entry").isNull() & ~of_schema),
        (["source_idx", "schema"], of_schema),
        (["source_idx", "schema", "entry"], F.col("entry").isNotNull()),
    ]
    out = items
    for n, (place, condition) in enumerate(levels):
        on = ["document_id", *place]
        broken = violations.filter(condition).groupBy(*on).agg(F.collect_set("rule").alias(f"_rules{n}"))
        keys = broken.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(on)], f"_rules{n}")
        same = F.lit(True)
        for i, c in enumerate(on):
            same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
        out = out.join(keys, same, "left").drop(*[f"_k{i}" for i in range(len(on))])
    nothing = F.array().cast("array<string>")
    found = [F.coalesce(F.col(f"_rules{n}"), nothing) for n in range(len(levels))]
    rules = F.array_sort(F.array_distinct(F.concat(*found)))
    return out.withColumn("broken", rules).drop(*[f"_rules{n}" for n in range(len(levels))])


def target_collisions(plan: DataFrame) -> DataFrame:
    """Archive tables that more than one plan row would write, since names are lower-cased."""
    target = [F.col("target_db"), F.lower("target_table").alias("target_table")]
    counted = plan.groupBy(*target).agg(F.count(F.lit(1)).alias("n_plans"))
    return counted.filter("n_plans > 1").withColumn("rule", F.lit("duplicate_target"))
