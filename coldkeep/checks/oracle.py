"""The results of `queries.py` in plain SQL over the same tables."""

from __future__ import annotations

from coldkeep.checks import fixtures as fx

SRC = fx.ORDERS_SRC.format(orders="orders")
TGT = fx.ORDERS_TGT.format(src="SELECT * FROM src")
PAIR = f"src AS ({SRC}), tgt AS ({TGT})"

COLUMNS = fx.ORDER_COLUMNS
LIST = ", ".join(COLUMNS)

# Normalised text of the columns of orders.
TEXT = {
    "o_orderkey": "o_orderkey::varchar",
    "o_custkey": "o_custkey::varchar",
    "o_orderstatus": "trim(lower(o_orderstatus))",
    "o_totalprice": "format('{:,.5f}', o_totalprice)",
    "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
    "o_orderpriority": "trim(lower(o_orderpriority))",
}
TEXTS = ", ".join(f"coalesce({e}, 'null') AS {c}" for c, e in TEXT.items())
STRICT = {
    **TEXT,
    "o_orderstatus": "'''' || o_orderstatus || ''''",
    "o_totalprice": "o_totalprice::varchar",
    "o_orderdate": "o_orderdate::varchar",
    "o_orderpriority": "'''' || o_orderpriority || ''''",
}
STRICTS = ", ".join(f"coalesce({e}, 'null') AS {c}" for c, e in STRICT.items())


def with_texts(texts: str = TEXTS) -> str:
    return f"{PAIR}, s AS (SELECT {texts} FROM src), t AS (SELECT {texts} FROM tgt)"


def diff(cols: str = LIST) -> str:
    return f"""diff AS (
        SELECT {cols}, sum(a)::bigint AS n_src, sum(b)::bigint AS n_tgt
        FROM (SELECT {cols}, 1 AS a, 0 AS b FROM s UNION ALL SELECT {cols}, 0, 1 FROM t)
        GROUP BY {cols} HAVING sum(a) <> sum(b))"""


WITH_DIFF = f"WITH {with_texts()}, {diff()}"
DIGEST = "md5(" + " || '|' || ".join(COLUMNS) + ")"


def value_sum(column: str) -> str:
    return f"sum(('0x' || substr(md5({column}), 1, 15))::bigint::hugeint)::decimal(38,0)"


def checksums(relation: str, cols, name: str = "checksum") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n_rows, {value_sum(c)} AS {name} FROM {relation}"
        for c in cols
    )


LINE_TEXT = {
    **{c: f"{c}::varchar" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")},
    **{
        c: f"format('{{:,.5f}}', {c})"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    },
    **{c: f"trim(lower({c}))" for c in ("l_returnflag", "l_linestatus")},
    "l_shipdate": "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')",
}
LINE_TEXTS = ", ".join(f"{e} AS {c}" for c, e in LINE_TEXT.items())


def pairs(key: tuple[str, ...]) -> str:
    rest = [c for c in COLUMNS if c not in key] + ["copies", "row_checksum"]
    by = f"PARTITION BY {', '.join(key)} " if key else ""

    def side(condition: str) -> str:
        return f"""(SELECT {LIST}, abs(n_src - n_tgt) AS copies, {DIGEST} AS row_checksum,
            row_number() OVER ({by}ORDER BY {DIGEST}) AS rank FROM diff WHERE {condition})"""

    columns = ", ".join(f"a.{c} AS source_{c}, b.{c} AS target_{c}" for c in rest)
    keys = "".join(f"coalesce(a.{k}, b.{k}) AS {k}, " for k in key)
    on = " AND ".join(f"a.{k} = b.{k}" for k in (*key, "rank"))
    return f"""{WITH_DIFF}
        SELECT {keys}coalesce(a.rank, b.rank) AS rank, {columns}
        FROM {side('n_src > n_tgt')} a FULL JOIN {side('n_tgt > n_src')} b ON {on}"""


SUMMARY = f"""WITH {PAIR}, cut AS (SELECT * EXCLUDE (o_orderstatus) FROM tgt),
    s AS (SELECT {', '.join(f"coalesce({e}, 'null') AS {c}" for c, e in TEXT.items() if c != 'o_orderstatus')} FROM src),
    t AS (SELECT {', '.join(f"coalesce({e}, 'null') AS {c}" for c, e in TEXT.items() if c != 'o_orderstatus')} FROM cut),
    {diff(', '.join(c for c in COLUMNS if c != 'o_orderstatus'))},
    counts AS (SELECT (SELECT count(*) FROM s) AS n, (SELECT count(*) FROM t) AS m),
    gaps AS (SELECT greatest(sum(greatest(n_src - n_tgt, 0)), sum(greatest(n_tgt - n_src, 0)))::bigint
             AS k FROM diff),
    bad AS (SELECT string_agg("column", ',' ORDER BY "column") AS names FROM (
        {' UNION ALL '.join(
            f"SELECT '{c}' AS \"column\" WHERE EXISTS ((SELECT {c} FROM s EXCEPT ALL SELECT {c} FROM t) "
            f"UNION ALL (SELECT {c} FROM t EXCEPT ALL SELECT {c} FROM s))"
            for c in COLUMNS if c != 'o_orderstatus')}))"""

# ---- archives with a per-row expiry ----

ARCHIVES = f"""arc_orders AS (
        SELECT o_orderkey, o_orderdate + INTERVAL 180 DAY AS retention_expires_at,
               {fx.HOLD_ORDERS} AS legal_hold FROM orders),
    arc_lineitem AS (
        SELECT l_shipdate + INTERVAL 365 DAY AS retention_expires_at,
               {fx.HOLD_LINES} AS legal_hold FROM lineitem),
    arc_events AS (
        SELECT ts + INTERVAL 30 DAY AS retention_expires_at, {fx.HOLD_EVENTS} AS legal_hold
        FROM events)"""
EXPIRED = f"retention_expires_at < TIMESTAMP '{fx.AS_OF}' AND legal_hold = false"
KEPT = f"NOT coalesce({EXPIRED}, false)"
FOUND = f"""WITH {ARCHIVES}, found AS (
        SELECT 'src_orders' AS table_name, count(*) FILTER ({EXPIRED}) AS n FROM arc_orders
        UNION ALL SELECT 'src_lineitem', count(*) FILTER ({EXPIRED}) FROM arc_lineitem
        UNION ALL SELECT 'src_events', count(*) FILTER ({EXPIRED}) FROM arc_events)"""

# ---- blobs ----

BLOBS = """WITH cells AS (
        SELECT 'p' || page_id AS id, encode(html) AS body, html AS txt FROM pages
        UNION ALL SELECT 'd' || doc_id, encode(text), text FROM documents
        UNION ALL SELECT 'p' || page_id || '-empty', encode(''), '' FROM pages
        UNION ALL SELECT 'd' || doc_id || '-null', NULL, NULL FROM documents),
    kept AS (SELECT id, CASE WHEN octet_length(body) > 0 THEN sha256(txt) END AS digest, body,
             CASE WHEN regexp_matches(txt, '^[ \\t\\n\\r\\x0B\\f]*<') THEN '.xml'
                  WHEN starts_with(txt, '%PDF-') THEN '.pdf'
                  WHEN starts_with(txt, 'GIF87a') OR starts_with(txt, 'GIF89a') THEN '.gif'
                  ELSE '.bin' END AS ext FROM cells)"""
FOLDER = "blobs/archive_x/owner/pages/body/"

# ---- rules ----

CATALOGUE = "cat AS (" + fx.CATALOGUE.format(customer="customer", nation="nation").replace(
    "STRING", "VARCHAR"
).replace("AS table", 'AS "table"') + ")"
MATCHED = f"""{CATALOGUE}, matched AS (
    SELECT lower(r_name) AS source_name, schema, "table",
        CASE WHEN regexp_matches("table", '^(?:BUILDING_1)') THEN 1
             WHEN regexp_matches("table", '^(?:(BUILDING|AUTOMOBILE))') THEN 2
             WHEN "table" = 'MACHINERY_7' THEN 3
             WHEN regexp_matches("table", '^(?:MACHINERY_[0-9]*[05]$)') THEN 4 END AS rule
    FROM cat JOIN nation ON schema = n_name JOIN region ON n_regionkey = r_regionkey
    WHERE NOT regexp_matches("table", '^(?:AUTOMOBILE_2)')
      AND NOT regexp_matches("table", '^(?:.*99$)')),
  chosen AS (SELECT source_name, schema, "table",
        CASE rule WHEN 1 THEN 'FEED_ID < 10000' WHEN 3 THEN 'A = 1' END AS condition
    FROM matched WHERE rule IS NOT NULL)"""
RETENTION = "CASE source_name WHEN 'asia' THEN '7y' ELSE '6m' END"

DOCS = "docs AS (SELECT c_custkey AS doc_id, {text} AS document FROM customer)"
RULE_DOCS = DOCS.format(text=fx.DOCUMENT_TEXT.replace("{text}", "VARCHAR"))
PURGE_DOCS = DOCS.format(text=fx.PURGE_TEXT.replace("{text}", "VARCHAR"))


def string_at(path: str) -> str:
    return f"CASE WHEN json_type(j, '{path}') = 'VARCHAR' THEN json_extract_string(j, '{path}') END"


def violation(relation: str, rule: str, where: str, idx="NULL", schema="NULL", entry="NULL") -> str:
    return (
        f"SELECT doc_id, {idx}::int AS source_idx, {schema}::varchar AS schema, "
        f"{entry}::int AS entry, '{rule}' AS rule FROM {relation} WHERE {where}"
    )


def unknown(member: str, section: str) -> str:
    return (
        f"NOT coalesce(trim({string_at('$.' + member)}) <> '' AND "
        f"list_contains(json_keys(d, '$.{section}'), {string_at('$.' + member)}), false)"
    )


NAMED = f"coalesce(trim({string_at('$.name')}) <> '', false)"
QUERIED = f"coalesce(trim({string_at('$.query')}) <> '', false)"
VIOLATIONS = " UNION ALL ".join(
    [
        violation("parsed", "missing_" + key, f"NOT json_exists(j, '$.{key}')")
        for key in ("env", "warehouses", "connections", "sources", "retention_policies")
    ]
    + [
        violation("sources", rule, where, "source_idx")
        for rule, where in {
            "unknown_warehouse": unknown("warehouse", "warehouses"),
            "unknown_connection": unknown("connection", "connections"),
            "unknown_retention_policy": unknown("retention_policy", "retention_policies"),
            "legal_hold_not_boolean": "coalesce(json_type(j, '$.legal_hold'), '') <> 'BOOLEAN'",
            "consumer_roles_not_a_filled_list": "json_exists(j, '$.consumer_roles') AND "
            "(json_type(j, '$.consumer_roles') <> 'ARRAY' OR json_array_length(j, '$.consumer_roles') = 0)",
            "consumer_roles_blank_entry": "json_type(j, '$.consumer_roles') = 'ARRAY' AND "
            "len(list_filter(json_extract_string(j, '$.consumer_roles[*]'), lambda r: trim(r) = '')) > 0",
            "schemas_not_a_filled_list": "coalesce(json_array_length(j, '$.include.schemas'), 0) = 0",
        }.items()
    ]
    + [
        violation("schemas", rule, where, "source_idx", "schema")
        for rule, where in {
            "schema_without_name": "NOT json_exists(j, '$.name')",
            "tables_not_a_list": "json_exists(j, '$.tables') AND json_type(j, '$.tables') <> 'ARRAY'",
        }.items()
    ]
    + [
        violation("entries", rule, where, "source_idx", "schema", "entry")
        for rule, where in {
            "not_exactly_one_of_name_and_query": f"({NAMED}) = ({QUERIED})",
            "query_without_target_table": f"{QUERIED} AND NOT {NAMED} AND "
            f"coalesce({string_at('$.target_table')}, '') = ''",
            "query_with_condition": f"{QUERIED} AND NOT {NAMED} AND json_exists(j, '$.condition')",
        }.items()
    ]
)

# ---- jobs ----

JOBS = """jobs AS (
    SELECT 'archive' AS job_kind, 'archive-job' AS job_name, 'ar-' || o_orderkey AS job_run_id,
        CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN 'Failed' ELSE 'RUNNING' END AS status,
        floor(o_totalprice / 100)::bigint AS duration_seconds, 'archive_x.T_' || o_custkey AS target_table,
        'OWNER.Q' || o_custkey AS source_table FROM orders
    UNION ALL
    SELECT 'validate', 'validate-job', 'va-' || c_custkey, 'SUCCEEDED', (c_nationkey * 61)::bigint,
        'archive_x.T_' || c_custkey, 'OWNER.Q' || c_custkey FROM customer)"""
SEVERITY = (
    "CASE WHEN upper({0}) IN ('PASSED', 'SUCCEEDED') THEN 'good' "
    "WHEN upper({0}) IN ('FAILED', 'ERROR') THEN 'bad' ELSE 'neutral' END"
)
SUMMARIES = """summaries AS (
    SELECT 'row_count_validation' AS validation_report, 'archive_x.T_' || o_custkey AS target_table,
        CASE o_orderstatus WHEN 'O' THEN 'failed' ELSE 'passed' END AS result,
        'source_table_count: ' || o_orderkey || ', target_table_count: '
            || (o_orderkey + length(o_orderpriority)) AS value,
        CASE o_orderstatus WHEN 'O' THEN 'Mismatched checksums: ' || o_orderkey || ' rows ('
            || length(o_orderpriority) || '.25%). Records: []' ELSE '' END AS remarks,
        o_orderkey AS seq FROM orders),
  latest AS (SELECT target_table, validation_report, unnest(arg_max(struct_pack(
        result := result, value := value, remarks := remarks, seq := seq), seq)) FROM summaries
    GROUP BY target_table, validation_report)"""

ORACLE: dict[str, str] = {
    "conditional_scan": "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 150000",
    "query_scan": "SELECT c_custkey, c_name, n_name FROM customer JOIN nation "
    "ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'",
    "query_over_table": "SELECT l_returnflag, l_linestatus, count(*) AS n, "
    "max(l_shipdate) AS last_ship FROM lineitem WHERE l_quantity > 10 "
    "GROUP BY l_returnflag, l_linestatus",
    "retention_stamp": """SELECT o_orderkey, TIMESTAMP '1997-01-01 10:30:00' AS archived_at,
        TIMESTAMP '1997-01-01 10:30:00' + INTERVAL 180 DAY AS retention_expires_at,
        true AS legal_hold FROM orders""",
    "retention_stamp_by_row": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        l_shipdate + INTERVAL 365 DAY AS retention_expires_at, l_returnflag = 'R' AS legal_hold
        FROM lineitem""",
    "retention_literals": """SELECT o_orderkey, length(o_orderpriority)
        || CASE o_orderstatus WHEN 'F' THEN 'd' WHEN 'O' THEN 'M' ELSE 'y' END AS period,
        (length(o_orderpriority) * CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 30 ELSE 365 END)::int
        AS days FROM orders""",
    "row_checksum": "SELECT l_orderkey, l_linenumber, md5("
    + " || '||' || ".join(f"{c}::varchar" for c in LINE_TEXT)
    + ") AS checksum FROM lineitem",
    "row_checksum_with_nulls": f"WITH {PAIR} SELECT o_orderkey, md5("
    + " || '||' || ".join(f"coalesce({c}::varchar, 'NULL')" for c in COLUMNS)
    + ") AS checksum FROM src",
    "archived_rows": f"""SELECT {LIST}, TIMESTAMP '{fx.AS_OF}' AS archived_at,
        o_orderdate + INTERVAL 180 DAY AS retention_expires_at, {fx.HOLD_ORDERS} AS legal_hold,
        md5({" || '||' || ".join(f"{c}::varchar" for c in COLUMNS)}) AS checksum,
        CAST(year(o_orderdate + INTERVAL 180 DAY) * 12 + month(o_orderdate + INTERVAL 180 DAY) - 1 AS INTEGER) AS expiry_month FROM orders""",
    "normalize_lenient": """SELECT event_id::varchar AS event_id,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id::varchar AS user_id,
        trim(lower(event_type)) AS event_type, format('{:,.5f}', value) AS value,
        trim(lower(props)) AS props FROM events""",
    "normalize_with_nulls": f"WITH {PAIR} SELECT "
    + TEXTS.replace("coalesce(o_custkey::varchar, 'null') AS o_custkey", "o_custkey")
    + " FROM src",
    "normalize_strict": f"WITH {PAIR} SELECT {STRICTS} FROM src",
    "row_count_check": f"""WITH {PAIR}, c AS (
        SELECT (SELECT count(*) FROM src) AS source_count, (SELECT count(*) FROM tgt) AS target_count)
        SELECT *, abs(source_count - target_count) AS difference,
        CASE WHEN source_count = target_count THEN 'passed' ELSE 'failed' END AS result FROM c""",
    "column_checksum": f"WITH x AS (SELECT {LINE_TEXTS} FROM lineitem) " + checksums("x", LINE_TEXT),
    "column_checksum_diff": f"""WITH {with_texts()},
        a AS ({checksums('s', COLUMNS)}),
        b AS ({checksums('t', [c for c in COLUMNS if c != 'o_orderstatus'])})
        SELECT "column", a.n_rows || '-' || a.checksum AS source,
        coalesce(b.n_rows || '-' || b.checksum, 'N/A') AS target,
        CASE WHEN a.n_rows = b.n_rows AND a.checksum = b.checksum THEN 'passed' ELSE 'failed' END
        AS result FROM a FULL JOIN b USING ("column")""",
    "mismatched_columns": f"WITH {with_texts()} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CASE WHEN EXISTS ((SELECT {c} FROM s EXCEPT ALL SELECT {c} "
        f"FROM t) UNION ALL (SELECT {c} FROM t EXCEPT ALL SELECT {c} FROM s)) "
        "THEN 'failed' ELSE 'passed' END AS result"
        for c in COLUMNS
    ),
    "rows_only_in_source": f"WITH {with_texts()} SELECT {LIST}, count(*) AS copies FROM s "
    f"ANTI JOIN t USING ({LIST}) GROUP BY {LIST}",
    "rows_only_in_target": f"WITH {with_texts()} SELECT {LIST}, count(*) AS copies FROM t "
    f"ANTI JOIN s USING ({LIST}) GROUP BY {LIST}",
    "row_diff": f"{WITH_DIFF} SELECT * FROM diff",
    "row_diff_by_bucket": f"WITH {with_texts(STRICTS)}, {diff()} SELECT * FROM diff",
    "row_diff_by_bucket_lenient": f"{WITH_DIFF} SELECT * FROM diff",
    "row_diff_copies": """WITH x AS (SELECT lower(l_returnflag) AS l_returnflag,
        lower(l_linestatus) AS l_linestatus, l_linenumber::varchar AS l_linenumber,
        count(*) AS n_src, count(*) FILTER (l_quantity < 50) AS n_tgt FROM lineitem
        GROUP BY ALL) SELECT * FROM x WHERE n_src <> n_tgt""",
    "row_check": f"""{WITH_DIFF}, sums AS (SELECT
        sum(greatest(n_src - n_tgt, 0))::bigint AS source_only,
        sum(greatest(n_tgt - n_src, 0))::bigint AS target_only,
        (SELECT count(*) FROM src) AS source_count FROM diff)
        SELECT source_only, target_only, source_count,
        greatest(source_only, target_only) AS mismatch_count,
        round(100.0::double * greatest(source_only, target_only) / source_count, 2) AS mismatch_percent,
        CASE WHEN source_only + target_only = 0 THEN 'passed' ELSE 'failed' END AS result FROM sums""",
    "mismatch_records": f"""{WITH_DIFF} SELECT CASE WHEN n_src > n_tgt THEN 'source' ELSE 'target' END
        AS side, abs(n_src - n_tgt) AS copies, {LIST}, md5(o_totalprice) AS row_checksum FROM diff""",
    "mismatch_pairs": pairs(("o_orderkey",)),
    "mismatch_pairs_by_customer": pairs(("o_custkey",)),
    "mismatch_pairs_without_key": pairs(()),
    "mismatch_values": f"WITH p AS ({pairs(('o_orderkey',))}) "
    + " UNION ALL ".join(
        f"SELECT o_orderkey, rank, '{c}' AS \"column\", source_{c} AS source_value, "
        f"target_{c} AS target_value FROM p"
        for c in COLUMNS
        if c != "o_orderkey"
    ),
    "checksum_sample": f"WITH {with_texts()} SELECT {DIGEST} AS row_checksum FROM s "
    "ORDER BY row_checksum LIMIT 100",
    "validation_summary": f"""{SUMMARY}
        SELECT 'schema_validation' AS validation_report, 'orders' AS source_table,
            'a.orders' AS target_table, 'failed' AS result, NULL::bigint AS source_count,
            NULL::bigint AS target_count, NULL::bigint AS difference, NULL::bigint AS mismatch_count,
            NULL::double AS mismatch_percent, 'o_note,o_orderstatus' AS mismatched_columns
        UNION ALL SELECT 'row_count_validation', 'orders', 'a.orders',
            CASE WHEN n = m THEN 'passed' ELSE 'failed' END, n, m, abs(n - m), NULL, NULL, ''
            FROM counts
        UNION ALL SELECT 'row_checksum_validation', 'orders', 'a.orders',
            CASE WHEN k = 0 THEN 'passed' ELSE 'failed' END, n, NULL, NULL, k,
            round(100.0::double * k / n, 2), '' FROM counts, gaps
        UNION ALL SELECT 'column_checksum_validation', 'orders', 'a.orders',
            CASE WHEN names IS NULL THEN 'passed' ELSE 'failed' END, NULL, NULL, NULL, NULL, NULL,
            coalesce(names, '') FROM bad""",
    "schema_diff": """SELECT "column", a.c IS NOT NULL AS in_source, b.c IS NOT NULL AS in_target,
        CASE WHEN a.c IS NOT NULL AND b.c IS NOT NULL THEN 'passed' ELSE 'failed' END AS result
        FROM (SELECT column_name AS "column", 1 AS c FROM (DESCRIBE orders)) a
        FULL JOIN (SELECT column_name AS "column", 1 AS c FROM (DESCRIBE orders)
            WHERE column_name <> 'o_orderstatus' UNION ALL SELECT 'o_note', 1) b USING ("column")""",
    "validation_text": f"""{SUMMARY}, names AS (
            SELECT string_agg('''' || column_name || '''', ', ' ORDER BY column_name) AS l,
                string_agg('''' || column_name || '''', ', ' ORDER BY column_name)
                    FILTER (column_name <> 'o_orderstatus') AS r FROM (DESCRIBE orders))
        SELECT 'schema_validation' AS validation_report, 'source_columns: [' || l
            || '], target_columns: [' || replace(r, '''o_orderdate''', '''o_note'', ''o_orderdate''')
            || ']' AS value, 'Mismatched columns: o_note, o_orderstatus' AS remarks FROM names
        UNION ALL SELECT 'row_count_validation', 'source_table_count: ' || n
            || ', target_table_count: ' || m, CASE WHEN n = m THEN '' ELSE
            'Mismatched row count. Difference: ' || abs(n - m) END FROM counts
        UNION ALL SELECT 'row_checksum_validation', 'row checksums validated: ' || n,
            CASE WHEN k = 0 THEN '' ELSE 'Mismatched checksums: ' || k || ' rows ('
            || round(100.0::double * k / n, 2) || '%). Records: Validation.rows' END FROM counts, gaps
        UNION ALL SELECT 'column_checksum_validation',
            'source_column_checksum: [' || sums || '], target_column_checksum: [' || sums || ']',
            coalesce('Mismatched columns: ' || replace(names, ',', ', '), 'Passed') FROM bad, (
                SELECT string_agg(column_name || ': n', ', ' ORDER BY column_name) AS sums FROM (DESCRIBE orders)
                WHERE column_name <> 'o_orderstatus' AND column_name IN ({', '.join(f"'{c}'" for c in COLUMNS)}))""",
    "summary_files": f"""{SUMMARY}, lines AS (
        SELECT 'schema_validation' AS validation_report, 'failed' AS result,
            'Mismatched columns: o_note, o_orderstatus' AS remarks
        UNION ALL SELECT 'row_count_validation', CASE WHEN n = m THEN 'passed' ELSE 'failed' END,
            CASE WHEN n = m THEN '' ELSE 'Mismatched row count. Difference: ' || abs(n - m) END FROM counts
        UNION ALL SELECT 'row_checksum_validation', CASE WHEN k = 0 THEN 'passed' ELSE 'failed' END,
            CASE WHEN k = 0 THEN '' ELSE 'Mismatched checksums: ' || k || ' rows ('
            || round(100.0::double * k / n, 2) || '%). Records: Validation.rows' END FROM counts, gaps
        UNION ALL SELECT 'column_checksum_validation', CASE WHEN names IS NULL THEN 'passed' ELSE 'failed' END,
            coalesce('Mismatched columns: ' || replace(names, ',', ', '), 'Passed') FROM bad)
        SELECT kind, validation_report, 'orders' AS source_table, 'a.orders' AS target_table, result, remarks
        FROM lines, (SELECT unnest(['csv', 'json']) AS kind)""",
    "validation_verdict": f"""WITH {with_texts()} SELECT 'lineitem' AS source_table,
        'a.lineitem' AS target_table,
        NOT EXISTS ((SELECT * FROM lineitem EXCEPT ALL SELECT * EXCLUDE (archived_at, hold)
            FROM (SELECT *, TIMESTAMP '{fx.AS_OF}' AS archived_at, false AS hold FROM lineitem))) AS passed,
        4::bigint AS n_checks
        UNION ALL SELECT 'orders', 'a.orders', NOT EXISTS (SELECT * FROM s EXCEPT ALL SELECT * FROM t),
        4""",
    "blob_links": f"{BLOBS} SELECT id, 's3://vault/{FOLDER}' || digest || ext AS body_s3_path FROM kept",
    "blob_table": f"""{BLOBS} SELECT digest AS sha256, ext, octet_length(any_value(body))::bigint
        AS length FROM kept WHERE digest IS NOT NULL GROUP BY digest, ext""",
    "blob_readback": f"""{BLOBS}, served AS (SELECT '{FOLDER}' || digest || ext AS key, ext,
            any_value(body) AS body, octet_length(any_value(body))::bigint AS length,
            digest || ext AS name FROM kept WHERE digest IS NOT NULL GROUP BY digest, ext)
        SELECT key, key AS path, length, 200 AS status,
            CASE WHEN true THEN CASE ext WHEN '.xml' THEN 'text/xml'
                WHEN '.pdf' THEN 'application/pdf' WHEN '.gif' THEN 'image/gif'
                ELSE 'application/octet-stream' END END AS content_type,
            name AS file_name,
            base64(body) AS body FROM served
        UNION ALL SELECT 'blobs/none/' || sha256(id) || '%2Bx.png', 'blobs/none/' || sha256(id)
            || '+x.png', NULL, 404, NULL, NULL, NULL FROM cells""",
    "object_addresses": """WITH x AS (SELECT page_id,
            regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS bucket,
            ltrim(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/') AS key FROM pages)
        SELECT page_id, bucket, key, key || '+é x' AS unquoted FROM x""",
    "archive_names": """SELECT c_custkey, 'archive_' || lower(c_mktsegment) AS db,
        'OWNER_' || c_name AS name, 's3://vault/c/OWNER/' || c_name || '/' AS path,
        CASE WHEN c_acctbal > 0 THEN lower(c_mktsegment) ELSE 'query_' || substr(sha1(
            'select * \n  From Owner.' || c_mktsegment || ' t where 1=1'), 1, 8) END AS segment,
        'Owner.' || c_mktsegment AS first_table FROM customer""",
    "plan_match": f"WITH {MATCHED} SELECT * FROM chosen",
    "plan_exclude": f"""WITH {CATALOGUE} SELECT * FROM cat WHERE NOT regexp_matches("table",
        '^(?:BUILDING_1)') AND NOT regexp_matches("table", '^(?:.*_[0-9]*4$)')
        AND NOT regexp_matches("table", '^(?:ACHINERY)')""",
    "plan_enriched": f"""WITH {MATCHED}, items AS (
            SELECT source_name, schema, "table", NULL AS query, condition,
                schema || '_' || "table" AS target, "table" AS folder, lower("table") AS segment FROM chosen
            UNION ALL SELECT lower(r_name), n_name, NULL, 'SELECT * FROM ' || n_name || '.HOLIDAYS', NULL,
                n_name || '_HOLIDAYS', n_name || '_HOLIDAYS',
                'query_' || substr(sha1('SELECT * FROM ' || n_name || '.HOLIDAYS'), 1, 8)
            FROM nation JOIN region ON n_regionkey = r_regionkey)
        SELECT source_name, 'conn_' || source_name || '_prod' AS connection, schema AS source_schema,
            "table" AS source_table, query, condition,
            's3://vault/conn_' || source_name || '/' || schema || '/' || folder || '/' AS target_path,
            'archive_conn_' || source_name || '_prod' AS target_db, target AS target_table, segment,
            {RETENTION} AS retention_policy_value, source_name = 'europe' AS legal_hold,
            NULL::varchar AS refused FROM items""",
    "plan_collisions": f"""WITH {CATALOGUE} SELECT 'archive_x' AS target_db,
        lower(schema || '_' || "table") AS target_table, 2::bigint AS n_plans,
        'duplicate_target' AS rule FROM cat WHERE "table" LIKE 'BUILDING_1%'""",
    "rule_violations": f"""WITH {RULE_DOCS}, parsed AS (SELECT doc_id, document::json AS j FROM docs),
        sources AS (SELECT doc_id, j AS d, i AS source_idx, json_extract(j, '$.sources[' || i || ']') AS j
            FROM (SELECT doc_id, j, unnest(range(json_array_length(j, '$.sources')::bigint)) AS i FROM parsed)),
        schemas AS (SELECT doc_id, source_idx, json_extract_string(j, '$.name') AS schema, j FROM (
            SELECT doc_id, source_idx, unnest(json_extract(j, '$.include.schemas[*]')) AS j FROM sources)),
        entries AS (SELECT doc_id, source_idx, schema, i AS entry,
            json_extract(j, '$.tables[' || i || ']') AS j FROM (SELECT doc_id, source_idx, schema, j,
            unnest(range(json_array_length(j, '$.tables')::bigint)) AS i FROM schemas
            WHERE json_type(j, '$.tables') = 'ARRAY'))
        {VIOLATIONS}""",
    "purge_target_violations": f"""WITH {PURGE_DOCS}, parsed AS (
            SELECT doc_id, try_cast(document AS json) AS j FROM docs),
        targets AS (SELECT doc_id, i AS target_idx, json_extract(j, '$.targets[' || i || ']') AS j
            FROM (SELECT doc_id, j, unnest(range(json_array_length(j, '$.targets')::bigint)) AS i
            FROM parsed WHERE j IS NOT NULL))
        SELECT doc_id, NULL::int AS target_idx, 'unreadable' AS rule FROM parsed WHERE j IS NULL
        UNION ALL SELECT doc_id, NULL, 'no_targets' FROM parsed
            WHERE j IS NOT NULL AND coalesce(json_array_length(j, '$.targets'), 0) = 0
        UNION ALL SELECT doc_id, target_idx::int, 'missing_source_name' FROM targets
            WHERE NOT json_exists(j, '$.source_name')
        UNION ALL SELECT doc_id, target_idx::int, 'missing_connection' FROM targets
            WHERE NOT json_exists(j, '$.connection')""",
    "archive_condition": f"""SELECT {LIST}, TIMESTAMP '{fx.AS_OF}' AS archived_at,
        o_orderdate + INTERVAL 180 DAY AS retention_expires_at, false AS legal_hold,
        md5({" || '||' || ".join(f"{c}::varchar" for c in COLUMNS)}) AS checksum,
        CAST(year(o_orderdate + INTERVAL 180 DAY) * 12 + month(o_orderdate + INTERVAL 180 DAY) - 1 AS INTEGER) AS expiry_month FROM orders
        WHERE o_orderstatus = 'F' AND o_totalprice > 1000""",
    "archive_validate_report": """WITH t AS (
            SELECT 'SRC_Orders' AS name, count(*) AS n FROM orders WHERE o_orderstatus = 'F'
            UNION ALL SELECT 'SRC_Lineitem', count(*) FROM lineitem
            UNION ALL SELECT 'SRC_Customers', count(*) FROM customer JOIN nation
                ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'),
        k AS (SELECT unnest(['schema_validation', 'row_count_validation', 'row_checksum_validation',
            'column_checksum_validation']) AS validation_report)
        SELECT name, n AS rows_archived, 1::bigint AS archive_runs, 1::bigint AS validate_runs,
            validation_report, 'passed' AS result, 'good' AS severity FROM t, k""",
    "expired_rows": f"WITH {ARCHIVES} SELECT * FROM arc_orders WHERE {EXPIRED}",
    "discover_expired": f"""{FOUND} SELECT table_name, CASE WHEN n > 0 THEN 'found' ELSE 'clean' END
        AS status, NULL AS reason, n AS estimated_rows_to_delete, DATE '{fx.AS_OF}' AS as_of FROM found
        UNION ALL SELECT 'src_nation', 'skipped', 'no retention columns', NULL, DATE '{fx.AS_OF}'""",
    "discovery_summary": f"""{FOUND} SELECT count(*) + 1 AS tables_scanned,
        count(*) FILTER (n > 0) AS tables_with_expired_rows,
        sum(n)::bigint AS total_estimated_deletes FROM found""",
    "purge_results": f"""{FOUND} SELECT table_name AS "table", 'success' AS status,
        n AS estimated_rows_deleted, n AS rows_deleted, 0::bigint AS remaining_expired_rows,
        NULL::varchar AS error FROM found WHERE n > 0""",
    "purge_summary": f"""{FOUND} SELECT count(*) AS tables_processed, count(*) AS successful_deletions,
        0::bigint AS failed_deletions, coalesce(sum(n), 0)::bigint AS rows_deleted,
        'completed' AS status FROM found WHERE n > 0""",
    "purge_survivors": f"WITH {ARCHIVES} SELECT * FROM arc_orders WHERE {KEPT}",
    "purge_survivors_unpartitioned": f"WITH {ARCHIVES} SELECT * FROM arc_orders WHERE {KEPT}",
    "purge_survivors_lineitem": f"""WITH {ARCHIVES}
        SELECT CAST(year(retention_expires_at) * 12 + month(retention_expires_at) - 1 AS INTEGER) AS expiry_month, legal_hold, count(*) AS n,
        min(retention_expires_at) AS first_expiry FROM arc_lineitem WHERE {KEPT} GROUP BY ALL""",
    "purge_far_dates": f"""WITH x AS (
            SELECT o_orderkey, {fx.HOLD_ORDERS} AS legal_hold, CASE WHEN o_orderkey % 3 = 0
                THEN TIMESTAMP '9999-12-31' ELSE o_orderdate END + INTERVAL 365 DAY AS t FROM orders
            UNION ALL SELECT o_orderkey, false, o_orderdate + INTERVAL (8100 * 365) DAY FROM orders),
        gone AS (SELECT count(*) AS deleted FROM x WHERE t < TIMESTAMP '{fx.AS_OF}' AND NOT legal_hold)
        SELECT legal_hold, CAST(year(t) AS INTEGER) AS "year", count(*) AS n,
            sum(o_orderkey)::bigint AS keys, any_value(deleted) AS deleted FROM x, gone
        WHERE coalesce(NOT (t < TIMESTAMP '{fx.AS_OF}' AND NOT legal_hold), true) GROUP BY 1, 2""",
    "purge_appended": f"""WITH {ARCHIVES}, x AS (
            SELECT a.* FROM arc_orders a WHERE {KEPT}
            UNION ALL SELECT a.* FROM arc_orders a JOIN orders USING (o_orderkey)
            WHERE o_orderstatus = 'F')
        SELECT CAST(year(retention_expires_at) * 12 + month(retention_expires_at) - 1 AS INTEGER) AS expiry_month, legal_hold, count(*) AS n,
            sum(o_orderkey)::bigint AS keys FROM x GROUP BY ALL""",
    "saved_purge_plan": f"""{FOUND} SELECT 'a' AS source_name, table_name,
        n AS estimated_rows_to_delete, DATE '{fx.AS_OF}' AS as_of FROM found WHERE n > 0""",
    "config_registry": """SELECT lower(r_name) AS source_name, 'dev' AS env, 'run-2' AS dag_run_id,
        TIMESTAMP '2024-02-01' AS archival_date, n_name AS schema, count(*) AS tables
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY r_name, n_name""",
    "latest_config": """SELECT source_name, unnest(arg_max(r, (archival_date, dag_run_id))) FROM (
        SELECT 'source_' || o_custkey AS source_name, o_orderdate AS archival_date,
            'run-' || lpad(o_orderkey::varchar, 12, '0') AS dag_run_id,
            struct_pack(env := lower(o_orderstatus), dag_run_id := 'run-' || lpad(o_orderkey::varchar, 12, '0'),
                archival_date := o_orderdate, config := o_orderpriority) AS r FROM orders)
        GROUP BY source_name""",
    "latest_summary": f"WITH {SUMMARIES} SELECT target_table, validation_report, result, value, seq FROM latest",
    "job_durations": f"""WITH {JOBS} SELECT target_table, job_kind, job_name, job_run_id,
        duration_seconds, (duration_seconds // 60) || 'm ' || (duration_seconds % 60) || 's' AS duration,
        status, {SEVERITY.format('status')} AS severity FROM jobs""",
    "report_rows": f"""WITH {JOBS}, {SUMMARIES}, tables AS (SELECT target_table,
            max(source_table) AS source_table, count(*) FILTER (job_kind = 'archive') AS archive_runs,
            count(*) FILTER (job_kind = 'validate') AS validate_runs,
            sum(duration_seconds)::bigint AS total_seconds FROM jobs GROUP BY target_table
            HAVING count(*) FILTER (job_kind = 'validate') > 0)
        SELECT target_table, source_table, archive_runs, validate_runs, total_seconds,
            coalesce(validation_report, 'no_data') AS validation_report, result, value, remarks,
            {SEVERITY.format('result')} AS severity
        FROM tables LEFT JOIN latest USING (target_table)""",
    "legacy_counts": """SELECT o_orderkey AS seq, o_orderkey AS source_count,
        o_orderkey + length(o_orderpriority) AS target_count, NULL::bigint AS validated_count,
        CASE o_orderstatus WHEN 'O' THEN o_orderkey END AS mismatch_count,
        CASE o_orderstatus WHEN 'O' THEN (length(o_orderpriority) || '.25')::double END
        AS mismatch_percent FROM orders""",
    "report_schema_rows": """WITH x AS (SELECT c_name AS target_table, ['id', c_mktsegment] AS a,
            ['id', CASE WHEN c_acctbal < 0 THEN 'legal' ELSE c_mktsegment END] AS b FROM customer),
        y AS (SELECT target_table, a, b, unnest(list_distinct(a || b)) AS "column" FROM x)
        SELECT target_table, "column", list_contains(a, "column") AS in_source,
            list_contains(b, "column") AS in_target, CASE WHEN list_contains(a, "column")
            AND list_contains(b, "column") THEN 'PASSED' ELSE 'FAILED' END AS result FROM y""",
    "report_checksum_rows": """SELECT c_name AS target_table, 'id' AS "column",
            md5(c_name) AS source_checksum, md5(c_name) AS target_checksum, 'PASSED' AS result FROM customer
        UNION ALL SELECT c_name, 'seg', md5(c_mktsegment),
            CASE WHEN c_acctbal < 0 THEN 'N/A' ELSE md5(lower(c_mktsegment)) END, 'FAILED' FROM customer""",
    "archive_expired_by_hold": f"""WITH {ARCHIVES} SELECT legal_hold, count(*) AS n_rows,
        count(*) FILTER ({EXPIRED}) AS n_expired FROM arc_orders GROUP BY legal_hold""",
    "plan_from_file": f"""WITH {MATCHED}, items AS (
            SELECT source_name, NULL AS query, condition FROM chosen
            UNION ALL SELECT lower(r_name), 'q', NULL FROM nation JOIN region ON n_regionkey = r_regionkey)
        SELECT source_name, {RETENTION} AS retention_policy_value, source_name = 'europe' AS legal_hold,
            count(*) AS n_rows, count(query) AS n_queries, count(condition) AS n_conditions
        FROM items GROUP BY source_name""",
    "archive_empty_source": """SELECT 'SRC_None' AS name, 'SUCCEEDED' AS status,
            (SELECT count(*) FROM orders WHERE o_orderkey < 0) AS rows, false AS has_table
        UNION ALL SELECT 'SRC_Some', 'SUCCEEDED', (SELECT count(*) FROM orders WHERE o_orderstatus = 'F'), true
        UNION ALL SELECT 'SRC_Missing', 'FAILED', NULL, false""",
    "drop_database": """SELECT 'src_orders' AS name, count(*) AS n_rows, false AS db_exists FROM orders
        UNION ALL SELECT 'src_lineitem', count(*), false FROM lineitem
        UNION ALL SELECT 'src_events', count(*), false FROM events
        UNION ALL SELECT 'src_nation', count(*), false FROM nation""",
    "purge_by_targets": f"""{FOUND} SELECT source_name, table_name AS "table", 'success' AS status,
        n AS estimated_rows_deleted, n AS rows_deleted, 0::bigint AS remaining_expired_rows
        FROM found, (SELECT unnest(['src0', 'src1']) AS source_name) WHERE n > 0""",
    "plan_refusals": f"""WITH {CATALOGUE}, place AS (
            SELECT lower(r_name) AS source_name, n_name AS schema, r_name, n_name NOT IN ('BRAZIL', 'KENYA') AS listed
            FROM nation JOIN region ON n_regionkey = r_regionkey),
        items AS (
            SELECT source_name, schema, r_name, "table", NULL AS query, schema || '_' || "table" AS target, '' AS own
            FROM place JOIN cat USING (schema)
            WHERE listed AND ("table" LIKE 'BUILDING_1%' OR "table" LIKE 'MACHINERY%')
            UNION ALL SELECT source_name, schema, r_name, NULL, 'SELECT 1', schema || '_ONE',
                CASE WHEN schema IN ('CANADA', 'PERU') THEN 'query_with_condition' ELSE '' END FROM place WHERE listed
            UNION ALL SELECT source_name, schema, r_name, NULL, 'SELECT 2', schema || '_TWO',
                'not_exactly_one_of_name_and_query' FROM place WHERE listed),
        reasons AS (SELECT *, [CASE r_name WHEN 'ASIA' THEN 'unknown_connection' END,
            CASE r_name WHEN 'AFRICA' THEN 'unknown_retention_policy_value' END,
            CASE r_name WHEN 'EUROPE' THEN 'unknown_legal_hold' END] AS parts,
            [nullif(own, ''), CASE r_name WHEN 'ASIA' THEN 'unknown_connection'
                WHEN 'AFRICA' THEN 'unknown_retention_policy' WHEN 'EUROPE' THEN 'legal_hold_not_boolean' END] AS rules
            FROM items)
        SELECT source_name, schema AS source_schema, "table" AS source_table, query, target AS target_table,
            nullif(array_to_string(list_filter(parts, lambda x: x IS NOT NULL)
                || list_sort(list_filter(rules, lambda x: x IS NOT NULL)), ', '), '') AS refused FROM reasons""",
    "report_odd_columns": f"""{SUMMARY}, names AS (SELECT unnest([
            ['o_orderkey', 'o_orderkey'], ['o_custkey', 'cust: key'], ['o_orderstatus', 'o_orderstatus'],
            ['o_totalprice', 'total, price'], ['o_orderdate', 'o_orderdate'], ['o_orderpriority', '[prio]']]) AS n)
        SELECT 'a.orders' AS target_table, n[2] AS "column", true AS in_source, n[1] <> 'o_orderstatus' AS in_target,
            CASE WHEN n[1] <> 'o_orderstatus' THEN 'PASSED' ELSE 'FAILED' END AS result,
            CASE WHEN n[1] = 'o_orderstatus' THEN NULL
                WHEN list_contains(string_split(coalesce(bad.names, ''), ','), n[1]) THEN 'FAILED' ELSE 'PASSED' END
            AS checksum_result FROM names, bad""",
    "report_mismatch_rows": f"WITH p AS ({pairs(('o_orderkey',))}), lines AS ("
    + " UNION ALL ".join(
        f"SELECT 'SRC_orders' AS target_table, o_orderkey::varchar AS key, rank, '{c}' AS \"column\", "
        f"source_{c}::varchar AS source_value, target_{c}::varchar AS target_value FROM p"
        for c in COLUMNS
        if c != "o_orderkey"
    )
    + """ UNION ALL SELECT 'SRC_nation', n_nationkey::varchar, 1, 'n_name', lower(n_name), lower(n_name) || 'x'
            FROM nation WHERE n_nationkey < 9
        UNION ALL SELECT 'SRC_nation', n_nationkey::varchar, 1, 'n_regionkey', n_regionkey::varchar,
            n_regionkey::varchar FROM nation WHERE n_nationkey < 9)
        SELECT *, CASE WHEN source_value IS NOT DISTINCT FROM target_value THEN 'PASSED' ELSE 'FAILED' END AS result
        FROM lines""",
    "report_legacy_mismatches": """WITH x AS (SELECT 't' || o_orderkey AS target_table, o_custkey::varchar AS k,
            o_orderpriority AS p, md5(o_orderpriority) AS c, o_orderstatus <> 'F' AS pair
            FROM orders WHERE o_orderstatus <> 'P'),
        y AS (SELECT target_table, c, pair, 'k' AS "column", k AS s, CASE WHEN pair THEN k END AS t FROM x
            UNION ALL SELECT target_table, c, pair, 'p', p, NULL FROM x
            UNION ALL SELECT target_table, c, pair, 's', NULL, 'it, is]' FROM x WHERE pair)
        SELECT target_table, 1::bigint AS rank, "column", s AS source_value, t AS target_value,
            c AS source_checksum, CASE WHEN pair THEN 'c' END AS target_checksum,
            CASE WHEN s IS NOT DISTINCT FROM t THEN 'PASSED' ELSE 'FAILED' END AS result FROM y""",
}
