"""File formats, keyed appends, stored layouts, the session catalog."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SMALL, rows
from tidemark.operators import catalog as C
from tidemark.operators import cdc, tables
from tidemark.sources import files

# Rows of the documented sample.
CAR = """Time,Seconds,Latitude / Y Position (Degrees),Longitude / X Position (Degrees),Distance (Miles),Speed (MPH),Steering Angle,Throttle Position,Engine RPM,Lateral Gs,Acceleration Gs
2018-04-08 10:31:37.690665,694.9933530000001,30.327191,-97.755971,7.48,61.136,-0.4,8,2140,-0.01,-0.03
2018-04-08 10:31:42.890666,700.193354,30.325965000000004,-97.755992,7.57,56.645,-0.8,0,1967,-0.01,-0.07
2018-04-08 10:32:55.222043,772.52473,30.3213,-97.755847,7.96,30.857,-0.6,3,1703,-0.02,-0.05
"""


def put(folder, name, data):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return path


def test_csv_binds_by_position(spark, folder):
    df = files.read_csv(spark, put(folder, "car.csv", CAR), files.CAR_SCHEMA)
    assert df.count() == 3 and len(df.columns) == 11
    first = df.orderBy("time").first()
    assert first["speed"] == pytest.approx(61.136) and first["rpm"] == 2140.0
    files.write_csv(df, f"{folder}/out")
    assert rows(files.read_csv(spark, f"{folder}/out", files.CAR_SCHEMA)) == rows(df)


def test_json_lines(spark, folder):
    path = put(folder, "colors.json", '{"color":"teal","category":"paint","type":"mixed","code":{"rgba":[0,128,128,7],"hex":"#088"},"other":{"type":"matt"}}\n'
               '{"color":"sand","category":"paint","code":{"rgba":[194,178,128,7],"hex":"#CB8"},"other":{"type":"gloss"}}\n')
    for schema in (None, "color STRING, category STRING, type STRING, code STRUCT<rgba: ARRAY<BIGINT>, hex: STRING>, other STRUCT<type: STRING>"):
        df = files.read_json_lines(spark, path, schema)
        assert rows(df, "color", "type", "code.hex", F.element_at("code.rgba", 4), "other.type") == [
            ("sand", None, "#CB8", 7, "gloss"), ("teal", "mixed", "#088", 7, "matt")]


def test_json_result_folders(spark, folder):
    df = spark.createDataFrame([("US", 4, "a"), ("US", 24, "b"), ("BE", 4, "c")], "geo STRING, hours INT, name STRING")
    files.write_json(df, f"{folder}/t", ["geo", "hours"])
    assert os.path.isdir(f"{folder}/t/geo=US/hours=24")
    assert rows(spark.read.json(f"{folder}/t"), "geo", "hours", "name") == rows(df)


def test_trend_document(spark, folder):
    path = put(folder, "trends.json", '{"trends":[{"name":"a","volume":"2K+","volume_over_time":[-10,0,128]},{"name":"b","volume":"100+","volume_over_time":[]}]}')
    trends = files.read_json_lines(spark, path).select(F.inline("trends"))
    assert rows(trends, "name", "volume", F.size("volume_over_time")) == [("a", "2K+", 3), ("b", "100+", 0)]


def test_xml(spark, folder):
    path = put(folder, "menu.xml", """<menu id="file" value="File"><popup>
      <menuitem value="New" onclick="CreateNewDoc()" /><menuitem value="Open" onclick="OpenDoc()" />
      <menuitem value="Close" onclick="CloseDoc()" /></popup></menu>""")
    df = files.read_xml(spark, path, "menu")
    assert rows(df.select("_id", "_value", F.explode("popup.menuitem").alias("m")), "_id", "_value", "m._value", "m._onclick") == [
        ("file", "File", "Close", "CloseDoc()"), ("file", "File", "New", "CreateNewDoc()"), ("file", "File", "Open", "OpenDoc()")]


def test_text(spark, folder):
    path = put(folder, "in.txt", "one\r\ntwo\nthree")
    assert [r["value"] for r in files.read_text(spark, path).collect()] == ["one", "two", "three"]
    assert files.read_text(spark, path, whole=True).first()["value"] == "one\r\ntwo\nthree"
    assert [tuple(r)[1:] for r in files.read_text_lines(spark, path).collect()] == [(0, "one"), (1, "two"), (2, "three")]


def test_binary(spark, folder):
    data = bytes(range(256))
    put(folder, "img/a.bin", data)
    df = files.read_binary(spark, f"{folder}/img", "*.bin")
    r = df.select(F.unhex(F.hex("content")).alias("b"), "length").first()
    assert (bytes(r["b"]), r["length"]) == (data, 256)


def test_pages(spark, folder):
    put(folder, "pages/2025-02-18-US-24.html", "<table>1</table>")
    put(folder, "pages/2025-02-18-BE-4.html", "<table>2\n</table>")
    assert rows(files.read_pages(spark, f"{folder}/pages")) == [
        ("2025-02-18", "BE", 4, "<table>2\n</table>"), ("2025-02-18", "US", 24, "<table>1</table>")]


def test_messages(spark):
    df = spark.createDataFrame([(1, "u")], "id INT, image_url STRING")
    assert files.to_message(df, ["id", "image_url"]).first()["body"] == '{"id":1,"image_url":"u"}'
    assert files.to_message(df, ["id"], envelope=True).first()["body"] == '{"data":{"id":1},"operation":"create"}'


def test_append_keyed(spark, folder):
    asked = spark.createDataFrame([("q", "b"), (None, "b2"), ("", "b3")], "query_email STRING, body_email STRING")
    files.append_keyed(asked, f"{folder}/k", "landing")
    files.append_keyed(asked, f"{folder}/k", "landing")
    got = spark.read.parquet(f"{folder}/k")
    assert got.count() == 6 == got.select("row_key").distinct().count()
    assert {r["email"] for r in got.collect()} == {"q", "b2", "b3"}


def test_one_table_per_source(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, name STRING")
    name = cdc.target_table(F.lit("main"), F.lit("dbo"), F.col("name"))
    files.route_to_tables(df, f"{folder}/r", name)
    assert os.path.isdir(f"{folder}/r/target_table=main_dbo_a")
    assert spark.read.parquet(f"{folder}/r").filter("target_table = 'main_dbo_b'").count() == 1


def test_partition_pruning(spark, folder, capsys):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    files.write_parquet(orders, f"{folder}/o", ["o_orderstatus"])
    files.read_parquet(spark, f"{folder}/o").filter("o_orderstatus = 'O'").select("o_orderkey").explain()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in capsys.readouterr().out


def test_write_order(spark, folder):
    df = spark.createDataFrame([(i % 5 if i % 7 else None, i if i % 3 else None) for i in range(100)], "y BIGINT, z BIGINT").repartition(3)
    tables.write_ordered(df, f"{folder}/w", "y", "z")
    stored = spark.read.parquet(f"{folder}/w").select(
        "y", F.when(F.col("z").isNotNull(), F.pmod(F.hash("z"), F.lit(4))).alias("b"), F.input_file_name().alias("f"))
    per_file = {}
    for r in stored.collect():
        per_file.setdefault(r["f"], []).append((r["y"] is not None, r["y"] or 0, r["b"] is None, -(r["b"] or 0)))
    assert per_file and all(v == sorted(v) for v in per_file.values())


def test_all_types_round_trip(spark, folder):
    df = spark.sql("""SELECT true AS b, 1 AS i, 2L AS l, CAST(1.5 AS FLOAT) AS f, 2.5D AS d, CAST(1.125 AS DECIMAL(32,3)) AS dec,
      DATE '2024-02-29' AS dt, 45296000000L AS time_us, TIMESTAMP_NTZ '2024-01-01 01:02:03' AS ntz, TIMESTAMP '2024-01-01 01:02:03' AS tz,
      's' AS s, '00000000-0000-4000-8000-0000000000aa' AS uuid, CAST('abcdefghijklmnopqrstuvwxy' AS BINARY) AS fixed,
      array('a') AS arr, map('k', map('x', 1)) AS mm, array(named_struct('latitude', 1.0D, 'longitude', 2.0D)) AS loc,
      map(named_struct('a', 1), 'v') AS sk""")
    nulls = df.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    both = df.unionByName(nulls)
    files.write_parquet(both, f"{folder}/t")
    back = files.read_parquet(spark, f"{folder}/t")
    assert [f.dataType.simpleString() for f in back.schema] == [f.dataType.simpleString() for f in both.schema]
    key = str
    assert sorted(map(key, back.collect())) == sorted(map(key, both.collect()))


# --- catalog -----------------------------------------------------------------------------

X_Y_Z = T.StructType([T.StructField("x", T.LongType(), False), T.StructField("y", T.LongType(), False, {"comment": "comment"}),
                      T.StructField("z", T.LongType(), False)])


@pytest.fixture
def schema(spark, folder):
    name = "s_" + uuid.uuid4().hex[:8]
    C.create_schema(spark, name, {"key1": "value1", "key2": "value2"}, location=f"{folder}/db")
    return name


def test_schemas(spark, schema):
    assert schema in C.list_schemas(spark)
    with pytest.raises(C.AlreadyExists):
        C.create_schema(spark, schema)
    assert C.schema_properties(spark, schema) == {"key1": "value1", "key2": "value2"}
    C.create_table(spark, f"{schema}.t", X_Y_Z)
    with pytest.raises(C.NotEmpty):
        C.drop_schema(spark, schema)
    C.drop_table(spark, f"{schema}.t")
    C.drop_schema(spark, schema)
    assert schema not in C.list_schemas(spark)
    for call in (lambda: C.drop_schema(spark, schema), lambda: C.schema_properties(spark, schema),
                 lambda: C.list_tables(spark, schema), lambda: C.update_properties(spark, schema, updates={"a": "b"}),
                 lambda: C.create_table(spark, f"{schema}.t", X_Y_Z)):
        with pytest.raises(C.NotFound):
            call()


def test_schema_properties(spark, schema):
    got = C.update_properties(spark, schema, ["key1", "nope"], {"key4": "it's", "key3": "value3"})
    assert got == C.PropertyChanges(["key3", "key4"], ["key1"], ["nope"])
    assert C.schema_properties(spark, schema) == {"key2": "value2", "key3": "value3", "key4": "it's"}
    with pytest.raises(ValueError, match="both set and removed"):
        C.update_properties(spark, schema, ["a"], {"a": "1"})


def test_tables(spark, schema, folder):
    name = f"{schema}.orders"
    C.create_table(spark, name, X_Y_Z, ["x"], {"key1": "v1"}, location=f"{folder}/loc/")
    assert C.table_exists(spark, name) and C.list_tables(spark, schema) == ["orders"]
    with pytest.raises(C.AlreadyExists):
        C.create_table(spark, name, X_Y_Z)
    loaded = C.load_table(spark, name)
    assert sorted(loaded.columns) == ["x", "y", "z"] and loaded.schema["y"].metadata.get("comment") == "comment"
    assert C.table_properties(spark, name)["key1"] == "v1"
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert detail["Location"].endswith(f"{folder}/loc")
    C.rename_table(spark, name, f"{schema}.renamed")
    assert C.list_tables(spark, schema) == ["renamed"]
    for call in (lambda: C.load_table(spark, name), lambda: C.drop_table(spark, name), lambda: C.truncate(spark, name),
                 lambda: C.rename_table(spark, name, f"{schema}.other")):
        with pytest.raises(C.NotFound):
            call()
    C.create_table(spark, name, X_Y_Z)
    with pytest.raises(C.AlreadyExists):
        C.rename_table(spark, name, f"{schema}.renamed")
    with pytest.raises(ValueError, match="stays in its schema"):
        C.rename_table(spark, name, "default.orders")
    C.drop_table(spark, name)
    C.drop_table(spark, f"{schema}.renamed")


def test_create_table_as(spark, schema):
    name = f"{schema}.t"
    customer = spark.read.parquet(f"{SMALL}/customer.parquet")
    C.create_table_as(customer, name)
    assert C.load_table(spark, name).count() == customer.count()
    with pytest.raises(C.AlreadyExists):
        C.create_table_as(customer, name)
    C.create_table_as(customer.filter("c_acctbal > 0").select("c_custkey"), name, replace=True, partition_by=())
    assert C.load_table(spark, name).columns == ["c_custkey"]
    C.truncate(spark, name)
    assert C.load_table(spark, name).count() == 0


def test_recreate(spark, schema):
    name = f"{schema}.t"
    C.create_table_as(spark.range(5).withColumn("x", F.lit(1)), name, partition_by=["x"])
    C.recreate(spark, name)
    assert C.load_table(spark, name).count() == 0 and C.load_table(spark, name).columns == ["id", "x"]


def test_add_column(spark, schema):
    name = f"{schema}.t"
    C.create_table_as(spark.range(3), name)
    C.add_column(spark, name, "added_width", "int", "doc's")
    with pytest.raises(C.AlreadyExists):
        C.add_column(spark, name, "added_width", "int")
    spark.sql(f"INSERT INTO {name} VALUES (9, 5)")
    assert rows(C.load_table(spark, name), "id", "added_width") == [(0, None), (1, None), (2, None), (9, 5)]
    assert C.load_table(spark, name).schema["added_width"].metadata["comment"] == "doc's"
    assert C.with_column_added(spark.range(1), "y", "bigint").first()["y"] is None


def test_fixed_length_rows(spark, schema):
    name = f"{schema}.u"
    spark.sql(f"CREATE TABLE {name} (uuid_col STRING, fixed_col BINARY) USING parquet")
    spark.sql(f"""INSERT INTO {name} VALUES ('00000000-0000-4000-8000-0000000000aa', CAST('abcdefghijklmnopqrstuvwxy' AS BINARY)),
      ('00000000-0000-4000-8000-0000000000bb', CAST('zyxwvutsrqponmlkjihgfedcb' AS BINARY))""")
    got = C.load_table(spark, name)
    assert got.count() == 2 and b"abcdefghijklmnopqrstuvwxy" in {bytes(r["fixed_col"]) for r in got.collect()}


def test_sample_query_streams_the_whole_table(spark, folder, monkeypatch):
    from types import SimpleNamespace

    from tests.conftest import SMALL
    from tidemark.plans import storage
    monkeypatch.setattr(storage, "scratch", lambda *_: folder)
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    got = storage.s14(SimpleNamespace(spark=spark, events=events)).collect()
    assert [tuple(r) for r in got] == [(25, 25)]
    assert spark.read.parquet(f"{folder}/in").count() == events.count() > 40
