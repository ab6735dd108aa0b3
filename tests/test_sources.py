import datetime as dt
import decimal
import json

import pytest
from pyspark.sql import functions as F

from coldkeep.sources.connections import Connection, db_kind, jdbc_options, tls_url
from coldkeep.sources.documents import (
    parse_rules,
    read_documents,
    read_purge_targets,
    read_rules,
    read_summaries,
    yaml_to_json,
)
from coldkeep.sources.tables import (
    columns_of,
    jdbc_table,
    list_tables,
    query_over,
    read_archive,
    read_source,
    sample_query,
    source_catalogue,
    split_points,
    split_predicates,
)

ORACLE = "jdbc:oracle:thin:@//db.example.org:2484/SVC"
POSTGRES = "jdbc:postgresql://db.example.org:5432/app"


def test_kinds():
    assert [db_kind(u) for u in (ORACLE, POSTGRES.upper(), "jdbc:h2:x")] == ["oracle", "postgres", "unknown"]
    assert Connection("c").kind == "catalog" and Connection("c", url=ORACLE).kind == "oracle"


def test_oracle_tls():
    plain = tls_url(ORACLE)
    assert plain == (
        "jdbc:oracle:thin:@(DESCRIPTION=(ADDRESS=(PROTOCOL=TCPS)(HOST=db.example.org)(PORT=2484))"
        "(CONNECT_DATA=(SERVICE_NAME=SVC)))"
    )
    assert tls_url(ORACLE, "CN=x", enforce_ssl=True).endswith(
        '(SERVICE_NAME=SVC))(SECURITY=(ssl_server_cert_dn="CN=x")))'
    )
    assert tls_url(ORACLE, "CN=x") == plain
    assert tls_url(plain, "CN=x", True) == plain


@pytest.mark.parametrize(
    "url,want",
    [
        (POSTGRES, POSTGRES + "?ssl=true&sslmode=require"),
        (POSTGRES + "?a=b", POSTGRES + "?a=b&ssl=true&sslmode=require"),
        (POSTGRES + "?SSLMODE=disable", POSTGRES + "?SSLMODE=disable"),
    ],
)
def test_postgres_tls(url, want):
    assert tls_url(url, enforce_ssl=True) == want
    assert tls_url(url) == url


def test_jdbc_options():
    oracle = jdbc_options(ORACLE)
    assert oracle["driver"] == "oracle.jdbc.OracleDriver" and oracle["fetchsize"] == "10000"
    assert oracle["oracle.jdbc.defaultLobPrefetchSize"] == "104857600"
    postgres = jdbc_options(POSTGRES)
    assert postgres["driver"] == "org.postgresql.Driver" and postgres["stringtype"] == "unspecified"
    assert jdbc_options("jdbc:h2:x") == {"url": "jdbc:h2:x", "fetchsize": "10000"}
    assert jdbc_options(POSTGRES, driver="my.Driver")["driver"] == "my.Driver"


def test_jdbc_table():
    assert jdbc_table("S.T") == "S.T"
    assert jdbc_table("S.T", condition="A < 1") == "(SELECT * FROM S.T WHERE A < 1) t"
    assert jdbc_table(query="  SELECT 1 ") == "(SELECT 1) t"
    for both in ({"table": "T", "query": "Q"}, {}, {"table": "", "query": ""}):
        with pytest.raises(ValueError):
            jdbc_table(**both)


@pytest.fixture
def landing(spark, database):
    spark.sql("SELECT id, id % 2 AS odd FROM range(10)").write.saveAsTable(f"{database}.Feed")
    return Connection("c"), database


def test_catalog_source(spark, landing):
    conn, db = landing
    assert read_source(spark, conn, table=f"{db}.feed", condition="odd = 1").count() == 5
    assert read_source(spark, conn, query=f"SELECT max(id) m FROM {db}.feed").head().m == 9
    with pytest.raises(ValueError):
        read_source(spark, conn)
    cat = source_catalogue(spark, conn, [db])
    assert [tuple(r) for r in cat.collect()] == [(db, "feed")]
    assert list_tables(spark, db) == ["feed"] and columns_of(spark, f"{db}.feed") == ["id", "odd"]
    assert read_archive(spark, db, "FEED", "odd = 0").count() == 5


def test_query_over_needs_no_text_surgery(spark):
    df = spark.range(4)
    assert query_over(df, "SELECT count(*) n FROM {feed} WHERE id > 0", view="feed").head().n == 3


def test_broken_summary_lines_are_skipped(spark, tmp_path):
    folder = tmp_path / "a" / "b"
    folder.mkdir(parents=True)
    good = {"validation_report": "r", "source_table": "s", "target_table": "t", "result": "passed"}
    (folder / "x.json").write_text(json.dumps(good) + "\n{broken\n")
    (folder / "y.csv").write_text("ignored\n")
    assert [r.result for r in read_summaries(spark, str(tmp_path)).collect()] == ["passed"]


def test_documents(spark, tmp_path):
    (tmp_path / "rules.json").write_text(
        json.dumps({"env": "dev", "warehouses": {"w": "x"}, "sources": [{"name": "s", "legal_hold": True}]}, indent=2)
    )
    row = read_rules(spark, str(tmp_path / "rules.json")).head()
    assert row.env == "dev" and row.sources[0].legal_hold is True and row.connections is None
    (tmp_path / "purge.json").write_text(json.dumps({"targets": [{"source_name": "s", "connection": "c"}]}))
    assert read_purge_targets(spark, str(tmp_path / "purge.json")).head().targets[0].connection == "c"


def test_yaml_rules(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "r.yaml").write_text(
        "env: dev\nwarehouses:\n  w: s3://x\nsources:\n  - name: s\n    legal_hold: true  # held\n"
        "    include:\n      schemas:\n        - name: OWN\n          tables:\n"
        "            - name: FEED\n              condition: \"ID < 1\"\n"
    )
    row = parse_rules(yaml_to_json(read_documents(spark, str(tmp_path / "r.yaml")))).head()
    assert row.env == "dev" and row.sources[0].legal_hold is True
    assert row.sources[0].include.schemas[0].tables[0].condition == "ID < 1"


def test_password_is_not_shown():
    assert "hunter2" not in repr(Connection("c", url=POSTGRES, user="u", password="hunter2"))


@pytest.mark.parametrize(
    "values,kind",
    [
        ([5, 1, 1, 1, 9, -3, None, 7, 7, 2**40], "bigint"),
        ([1.5, -2.25, None, 0.0, 1e9], "double"),
        ([decimal.Decimal("1.10"), decimal.Decimal("-7.25"), None], "decimal(12,2)"),
        (["b", "ab", "", None, "zz z", "É"], "string"),
        ([dt.date(2020, 1, 1), dt.date(1969, 5, 1), None, dt.date(9999, 12, 31)], "date"),
        ([dt.datetime(2020, 1, 1, 12, 30, 1, 500000), None, dt.datetime(1999, 1, 1)], "timestamp"),
        ([None, None], "int"),
        ([], "int"),
    ],
)
def test_split_predicates_cover_every_row_once(spark, values, kind):
    """Each row, also one beyond the sample or without a key, meets exactly one predicate."""
    df = spark.createDataFrame([(v,) for v in values], f"k {kind}")
    sample = [v for v in values if v is not None]
    for parts in (1, 2, 3, 10):
        for drawn in (sample, sample[: len(sample) // 2]):
            predicates = split_predicates("k", split_points(drawn, parts))
            assert len(predicates) <= parts + 1
            met = F.expr(" + ".join(f"int(coalesce({p}, false))" for p in predicates))
            assert df.filter(met != 1).count() == 0


def test_split_points_are_even():
    points = split_points([i * i for i in range(1000)], 4)
    assert points == [250**2, 500**2, 750**2]
    assert split_points([7] * 90 + [8] * 10, 5) == [7]
    assert split_points([1.0, float("nan"), 2.0], 2) == [2.0]
    with pytest.raises(ValueError):
        split_predicates("k", [True])


def test_sample_queries():
    assert sample_query("S.T", "ID", "RANDOM()", 0.01) == "(SELECT ID FROM S.T t WHERE ID IS NOT NULL AND RANDOM() < 0.01) s"
    query = jdbc_table(query="SELECT * FROM A JOIN B USING (K)")
    assert sample_query(query, "K", "DBMS_RANDOM.VALUE", 0.5).startswith("(SELECT K FROM (SELECT * FROM A JOIN B USING (K)) t WHERE")
    with pytest.raises(ValueError, match="predicates"):
        sample_query("T", "K", "", 0.1)


class Reader:
    """Stands in for Spark's JDBC reader, which needs a database: it keeps what it is asked for."""

    def __init__(self, spark, keys):
        self.spark, self.keys, self.asked, self.given = spark, keys, [], {}

    read = property(lambda self: self)

    def format(self, kind):
        return self

    def options(self, **options):
        self.given |= options
        return self

    def option(self, name, value):
        self.asked.append(value)
        return self

    def load(self):
        return self.spark.createDataFrame([(k,) for k in self.keys], "k int")

    def jdbc(self, url, table, predicates, properties):
        self.asked.append((table, predicates))
        return self.load()


def test_queries_are_split(spark, caplog):
    query = "SELECT k FROM a"
    conn = Connection("c", url=POSTGRES, partitioning={query: {"split_column": "k", "num_partitions": 3}})
    reader = Reader(spark, range(9))
    read_source(reader, conn, query=f" {query} ")
    assert reader.asked[0] == "(SELECT k FROM (SELECT k FROM a) t WHERE k IS NOT NULL AND RANDOM() < 0.01) s"
    assert reader.asked[1] == ("(SELECT k FROM a) t", ["k < 3", "k >= 3 AND k < 6", "k >= 6", "k IS NULL"])
    assert "url" in reader.given and not caplog.records
    read_source(Reader(spark, [1]), conn, table="S.T")
    assert "S.T is read through a single connection" in caplog.text
