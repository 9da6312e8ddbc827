import pytest
from pyspark.sql.types import _parse_datatype_string

from catalog_sync.functions.names import normalize_names
from catalog_sync.operators import schema as sch


def test_map_columns_absent_null_and_last_wins(spark):
    df = spark.createDataFrame([(1, "a", "b")], "`T[ID]` long, `T[x]` string, `T[y]` string")
    out = sch.map_columns(df, {"T[ID]": "id", "T[x]": "v", "T[y]": "v", "T[missing]": "m"}, extracted_at="2024-06-01 00:00:00")
    assert out.columns == ["id", "v", "m", "extracted_at"]
    r = out.first()
    assert r["v"] == "b" and r["m"] is None
    assert sch.map_columns(df, {"T[missing]": "m", "T[ID]": "id"}, ignore_absent=True).columns == ["id"]


def test_normalize_names():

    got = normalize_names(["Customer Name", "Acct-Bal", "ID", "id", "Цвет"])
    assert got == ["customer_name", "acct_bal", "id", "id_1", "цвет"]
    assert normalize_names(["T[Col Name]", "[Measure]"], bracket=True) == ["col_name", "measure"]


def test_cast_columns_strict_and_bool_words(spark):
    df = spark.createDataFrame([("1", "on", "2.345"), ("2", "False", "x")], "a string, b string, c string")
    out = sch.cast_columns(df, {"a": "int", "b": "bool", "c": "numeric(10,2)"}, strict=False).collect()
    assert out[0]["b"] is True and out[1]["b"] is False and out[1]["c"] is None
    assert float(out[0]["c"]) == 2.35
    with pytest.raises(Exception):
        sch.cast_columns(df, {"c": "numeric(10,2)"}).collect()


def test_evolve_and_conform(spark):
    df = spark.createDataFrame([(1, "a", 9)], "ID long, name string, extra int")
    schema = _parse_datatype_string("id long, name string, flag boolean")
    ev = sch.evolve_schema(df, schema)
    assert ev.columns == ["ID", "name", "extra", "flag"]
    co = sch.conform_schema(df, schema)
    assert co.columns == ["id", "name", "flag"] and co.first()["flag"] is None


def test_schema_drift(spark):
    rows = spark.createDataFrame([('{"a": 1, "b": 2}', "f1"), ('{"a": 1, "z": 0}', "f2"), ('{"a": 1, "b": 3}', "f3")],
                                 "value string, file string")
    out = sch.schema_drift(rows, [("a", "bigint"), ("b", "bigint")], file_col="file")
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("f2", "add", "b", "bigint"), ("f2", "extra", "z", None)]
    # special columns carry their own type; a file whose rows have no key (or bad JSON) still shows up
    more = spark.createDataFrame([('{"a": 1, "b": 2, "ts": 5}', "g1"), ("{}", "g2"), ("not json", "g2"), ('{"a": 2, "b": 1}', "g3")],
                                 "value string, file string")
    out = sch.schema_drift(more, [("a", "bigint"), ("b", "bigint")], {"ts": "timestamp"}, file_col="file")
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("g2", "add", "a", "bigint"), ("g2", "add", "b", "bigint"), ("g2", "add", "ts", "timestamp"),
                   ("g3", "add", "ts", "timestamp")]
