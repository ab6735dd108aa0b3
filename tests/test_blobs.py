import base64

import pytest
from pyspark.sql import functions as F

from plan_columns import exchanged

from coldkeep.functions.blobs import binary_columns, sniff_extension
from coldkeep.functions.naming import uri_parts, unquote
from coldkeep.operators import blob_store
from coldkeep.operators.blob_store import (
    blob_cells,
    blob_digests,
    distinct_blobs,
    extract_blobs,
    read_blobs,
    stored_blobs,
    write_blobs,
)


def cells(spark, values):
    rows = [(i, bytearray(v) if v is not None else None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, Body binary")


@pytest.mark.parametrize(
    "content,ext",
    [
        (b"\xff\xd8\xff\xe0", ".jpg"),
        (b"\x89PNG\r\n\x1a\n..", ".png"),
        (b"%PDF-1.7", ".pdf"),
        (b"GIF87a", ".gif"),
        (b"GIF89a", ".gif"),
        (b"  <html>", ".xml"),
        (b"\x0b\x0c\r\n\t<?xml", ".xml"),
        (b"abc", ".bin"),
        (b"\n\nabc<", ".bin"),
        (b" %PDF-1.7", ".bin"),
        (b"\xff\xfe\x00<", ".bin"),
        (b" " * 64 + b"<a>", ".xml"),
        (b"\n" * 200 + b"<a>", ".xml"),
        (b" " * 200, ".bin"),
        (b" " * 63 + b"x<", ".bin"),
        (b" " * 64 + b"x<", ".bin"),
    ],
)
def test_sniff(spark, content, ext):
    df = cells(spark, [content])
    assert df.select(sniff_extension(F.col("Body"))).head()[0] == ext


def test_links(spark):
    df = extract_blobs(cells(spark, [b"abc", b"", None]), "s3://v/", "Arc", "OWN", "Feed")
    assert df.columns == ["id", "Body", "Body_s3_path"] and binary_columns(df) == ["Body"]
    links = [r.Body_s3_path for r in df.orderBy("id").collect()]
    assert links[0].startswith("s3://v/blobs/arc/own/feed/body/ba7816bf") and links[0].endswith(".bin")
    assert links[1:] == [None, None]


def test_store_twice_adds_nothing(spark, database):
    linked = extract_blobs(cells(spark, [b"a", b"b", b"a", b"", None]), "s3://v", "d", "s", "t")
    assert write_blobs(linked, database) == 2
    assert write_blobs(linked.repartition(3), database) == 0
    more = extract_blobs(cells(spark, [b"b", b"<c>"]), "s3://v", "d", "s", "t")
    assert write_blobs(more, database) == 1
    rows = {r.sha256: (r.ext, bytes(r.content)) for r in stored_blobs(spark, database).collect()}
    assert sorted(rows.values()) == [(".bin", b"a"), (".bin", b"b"), (".xml", b"<c>")]


def of(spark, values):
    return extract_blobs(cells(spark, values), "s3://v", "d", "s", "t")


def contents(spark, database):
    return sorted(bytes(r.content) for r in stored_blobs(spark, database).collect())


def test_a_store_grows_by_levels(spark, database, monkeypatch):
    """Begun with one blob, it spreads over more buckets once a large table comes."""
    monkeypatch.setattr(blob_store, "BUCKET_BYTES", 50)
    assert write_blobs(of(spark, [b"first"]), database) == 1
    assert [v.buckets for v in blob_store.blob_levels(spark, database)] == [4]
    many = [b"content %04d" % i for i in range(200)]
    assert write_blobs(of(spark, many + [b"first"]), database) == 200
    assert [v.buckets for v in blob_store.blob_levels(spark, database)] == [4, 64]
    # A small table still fits the first level; the second is not touched.
    assert write_blobs(of(spark, [b"small", many[7]]), database) == 1
    small, large = [spark.table(v.name) for v in blob_store.blob_levels(spark, database)]
    assert (small.count(), large.count()) == (2, 200)
    assert large.select(F.input_file_name()).distinct().count() > 32
    assert contents(spark, database) == sorted([b"first", b"small", *many])
    keys = of(spark, [many[3], b"first", b"small", b"absent"]).selectExpr("Body_s3_path AS key")
    served = read_blobs(spark, database, keys).collect()
    assert sorted(r.status for r in served) == [200, 200, 200, 404]
    bodies = {base64.b64decode(r.body) for r in served if r.status == 200}
    assert bodies == {many[3], b"first", b"small"}


def test_two_drivers_add_the_same_content(spark, database, monkeypatch):
    """Each sees the store without what the other is adding: readers still get one row."""
    monkeypatch.setattr(blob_store, "BUCKET_BYTES", 40)
    linked = of(spark, [b"x%d" % i for i in range(10)])
    assert write_blobs(linked, database) == 10
    (level,) = blob_store.blob_levels(spark, database)
    spark.table(level.name).write.mode("append").bucketBy(level.buckets, "sha256").sortBy("sha256").saveAsTable(level.name)
    twin = blob_store.Level(f"{database}.{blob_store.BLOB_TABLE}_64", 64)
    spark.table(level.name).limit(15).write.bucketBy(64, "sha256").sortBy("sha256").saveAsTable(twin.name)
    assert blob_store.blob_levels(spark, database) == [level, twin]
    assert contents(spark, database) == sorted(b"x%d" % i for i in range(10))
    assert write_blobs(linked, database) == 0
    keys = linked.selectExpr("Body_s3_path AS key")
    got = read_blobs(spark, database, keys).collect()
    assert len(got) == 10 and {r.status for r in got} == {200}


def test_held_bytes_are_not_exchanged(spark, database):
    linked = of(spark, [b"x%d" % i for i in range(10)])
    write_blobs(linked, database)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        levels = [spark.table(v.name) for v in blob_store.blob_levels(spark, database)]
        lacking = blob_store.lacking_digests(of(spark, [b"x1", b"new"]), levels)
        assert lacking.count() == 1 and exchanged(lacking) == [{"sha256"}] * len(exchanged(lacking))
        for shuffle in exchanged(blob_store.lacking_cells(linked, lacking, 1)):
            assert "content" not in shuffle and "Body" not in shuffle
        asked = blob_store.blob_status(spark, database, linked.selectExpr("Body_s3_path AS key"))
        for df in (stored_blobs(spark, database), asked):
            # Only contents that very many keys ask for are dealt out in pieces.
            assert all("salt" in shuffle for shuffle in exchanged(df) if "content" in shuffle)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_more_new_contents_than_a_broadcast_takes(spark, database, monkeypatch):
    monkeypatch.setattr(blob_store, "MOST_BROADCAST", 1)
    assert write_blobs(of(spark, [b"a", b"b", b"b", b"c"]), database) == 3
    assert contents(spark, database) == [b"a", b"b", b"c"]


def test_reading_before_any_write(spark, database):
    keys = of(spark, [b"a"]).selectExpr("Body_s3_path AS key")
    (row,) = read_blobs(spark, database, keys).collect()
    assert (row.status, row.body, row.length) == (404, None, None)
    assert stored_blobs(spark, database).count() == 0


def test_export_from_several_levels(spark, database, monkeypatch, tmp_path):
    monkeypatch.setattr(blob_store, "BUCKET_BYTES", 10)
    linked = extract_blobs(cells(spark, [b"one", b"<two>"]), f"file://{tmp_path}", "d", "s", "t")
    more = extract_blobs(cells(spark, [b"%d" % i * 9 for i in range(9)] + [b"one"]), f"file://{tmp_path}", "d", "s", "t")
    write_blobs(linked, database)
    write_blobs(more, database)
    assert len(blob_store.blob_levels(spark, database)) == 2
    assert blob_store.export_blobs(linked.unionByName(more), database) == 11
    files = [p for p in tmp_path.rglob("blobs/**/*") if p.is_file()]
    assert len(files) == 11 and b"<two>" in {p.read_bytes() for p in files}


def test_no_blobs(spark, database):
    linked = extract_blobs(cells(spark, [b"", None]), "s3://v", "d", "s", "t")
    assert write_blobs(linked, database) == 0


def test_hot_contents_take_the_salted_way(spark, monkeypatch):
    monkeypatch.setattr(blob_store, "HOT_COPIES", 5)
    linked = extract_blobs(
        cells(spark, [b"hot"] * 200 + [b"x%d" % i for i in range(50)]).repartition(6),
        "s3://v", "d", "s", "t",
    )
    hot = blob_store.hot_digests(blob_digests(linked))
    assert hot.count() == 1
    got = distinct_blobs(blob_cells(linked), hot, 3)
    assert sorted(bytes(r.content) for r in got.collect()) == sorted(
        {b"hot"} | {b"x%d" % i for i in range(50)}
    )


def test_content_asked_for_under_many_keys(spark, database, monkeypatch):
    monkeypatch.setattr(blob_store, "HOT_COPIES", 20)
    linked = extract_blobs(cells(spark, [b"hot", b"cold"]), "s3://v", "d", "s", "t")
    write_blobs(linked, database)
    names = [r.Body_s3_path.rsplit("/", 1)[1] for r in linked.orderBy("id").collect()]
    keys = [(f"k{i}/{names[0]}",) for i in range(100)] + [(f"k/{names[1]}",)]
    keys += [(f"bad{i}",) for i in range(30)]
    got = read_blobs(spark, database, spark.createDataFrame(keys, "key string")).collect()
    bodies = [r.body for r in got if r.status == 200]
    assert sorted(r.key for r in got) == sorted(k for k, in keys)
    assert bodies.count(base64.b64encode(b"hot").decode()) == 100 and len(bodies) == 101


def test_read_back(spark, database):
    linked = extract_blobs(cells(spark, [b"abc" * 40, b"<x/>"]), "s3://v", "d", "s", "t")
    write_blobs(linked, database)
    keys = linked.select(uri_parts(F.col("Body_s3_path"))["key"].alias("key"))
    wrong = spark.createDataFrame([("no/such.pdf",), ("x/" + "0" * 64 + ".bin",)], "key string")
    got = {r.key: r for r in read_blobs(spark, database, keys.union(keys).union(wrong), 100).collect()}
    assert len(got) == 4
    by_status = {}
    for r in got.values():
        by_status.setdefault(r.status, []).append(r)
    assert len(by_status[404]) == 2 and all(r.body is None for r in by_status[404])
    (large,), (served,) = by_status[413], by_status[200]
    assert large.length == 120 and large.body is None
    assert served.body == base64.b64encode(b"<x/>").decode()
    assert served.content_type == "text/xml"
    assert served.content_disposition == f'attachment; filename="{served.file_name}"'


def test_long_base64_has_no_line_breaks(spark):
    from coldkeep.functions.blobs import base64_text

    data = bytes(range(256)) * 3
    df = spark.createDataFrame([(bytearray(data),)], "c binary")
    assert df.select(base64_text(F.col("c"))).head()[0] == base64.b64encode(data).decode()


def test_content_types(spark):
    from coldkeep.functions.blobs import content_type

    df = spark.createDataFrame([("a.JPG",), ("a/b.pdf",), ("c.bin",), ("none",), ("x.zzz",)], "k string")
    assert [r[0] for r in df.select(content_type(F.col("k"))).collect()] == [
        "image/jpeg", "application/pdf", "application/octet-stream",
        "application/octet-stream", "application/octet-stream",
    ]


def test_unquote_keeps_plus(spark):
    df = spark.createDataFrame([("a+b%20c%2Bd",)], "k string")
    assert df.select(unquote(F.col("k"))).head()[0] == "a+b c+d"


def test_uri_parts(spark):
    df = spark.createDataFrame([("s3://bucket/a/b.txt",)], "u string")
    assert tuple(df.select(uri_parts(F.col("u")).alias("p")).head().p) == ("bucket", "a/b.txt")
