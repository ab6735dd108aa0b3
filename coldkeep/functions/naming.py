"""Names and paths of archive databases, tables and objects."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Name parts and the pattern that finds a query's first table.
DATABASE_PREFIX = "archive_"
QUERY_PREFIX = "query_"
ADDRESS_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)/*([^?#]*)"
FIRST_FROM_PATTERN = r"(?i)\bfrom\s+([a-zA-Z0-9_.]+)"


def archive_db(connection: Column) -> Column:
    return F.concat(F.lit(DATABASE_PREFIX), connection)


def archive_table(schema: Column, table: Column) -> Column:
    return F.concat(schema, F.lit("_"), table)


def archive_path(warehouse: Column, connection: Column, schema: Column, table: Column) -> Column:
    """NULL when a part is unknown: a folder without a root would be a relative one."""
    slash = F.lit("/")
    root = F.regexp_replace(warehouse, "/+$", "")
    return F.concat(root, slash, connection, slash, schema, slash, table, slash)


def archive_segment(table: Column, query: Column) -> Column:
    """Path segment that stays the same between runs: the table, or a digest of the query."""
    digest = F.concat(F.lit(QUERY_PREFIX), F.substring(F.sha1(query), 1, 8))
    return F.when(F.length(table) > 0, F.lower(table)).otherwise(digest)


def first_from_table(sql: Column) -> Column:
    """Label of a query's lineage; NULL when the text has no FROM."""
    flat = F.regexp_replace(F.trim(sql), r"\s+", " ")
    name = F.regexp_extract(flat, FIRST_FROM_PATTERN, 1)
    return F.when(name != "", name)


def uri_parts(uri: Column) -> Column:
    """struct(bucket, key) of an object address; a `?` or `#` ends the key."""
    pattern = F.lit(ADDRESS_PATTERN)
    part = lambda n: F.when(F.rlike(uri, pattern), F.regexp_extract(uri, ADDRESS_PATTERN, n))
    return F.struct(part(1).alias("bucket"), part(2).alias("key"))


def unquote(key: Column) -> Column:
    """Decode %XX; a plus sign stays a plus sign, and so does a percent sign without two digits."""
    plain = F.replace(key, F.lit("+"), F.lit("%2B"))
    escaped = F.regexp_replace(plain, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(escaped), key)
