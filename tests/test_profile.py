"""Profiles and type suggestions, against a plain sequential reading of the same values."""

from __future__ import annotations

import json
import math
import re
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ementario.operators.keys import key_discovery, keyset_signatures
from ementario.operators.profile import profile_simple, profile_typed, records_to_long, to_long
from ementario.operators.reports import count_where, group_count, inventory_stats, row_counts
from ementario.operators.sizing import float_ddl, integer_ddl, suggest_ddl, varchar_ddl
from ementario.sources.json_files import parse_texts


def rows_of(df):
    return {r["column"]: tuple(r)[1:] for r in df.collect()}


def test_sizing(spark):
    lengths = {0: 50, 8: 50, 9: 50, 14: 50, 44: 60, 65: 90, 79: 100, 80: 100, 81: 150, 103: 150, 234: 300, 255: 350}
    df = spark.createDataFrame([(n,) for n in [*lengths, 256, 4908]], "n int")
    got = [r[0] for r in df.select(varchar_ddl(F.col("n"))).collect()]
    assert got == [f"VARCHAR({w})" for w in lengths.values()] + ["TEXT", "TEXT"]
    ints = {32767: "SMALLINT", 32768: "INTEGER", 921305: "INTEGER", 2147483647: "INTEGER", 2147483648: "BIGINT",
            202502898843: "BIGINT"}
    df = spark.createDataFrame([(n,) for n in ints], "n long")
    assert [r[0] for r in df.select(integer_ddl(F.col("n"))).collect()] == list(ints.values())
    floats = [(12.5, 1, "FLOAT8"), (1.23456, 5, "NUMERIC(8, 5)"), (123456789012345.5, 1, "NUMERIC(18, 1)"), (0.5, 1, "FLOAT8"),
              (1e20, 0, "NUMERIC(23, 0)")]
    df = spark.createDataFrame([f[:2] for f in floats], "v double, p int")
    assert [r[0] for r in df.select(float_ddl(F.col("v"), F.col("p"))).collect()] == [f[2] for f in floats]


def test_simple(spark):
    rows = [("1", "7", "ab", None, True, "9"), ("2", "x", "a\n\nb", None, False, "abc")]
    df = spark.createDataFrame(rows, "id string, numeroX string, outro string, nulo string, valid boolean, teseJuridica string")
    df = df.withColumn("lista", F.array("id")).withColumn("n", F.monotonically_increasing_id())
    got = rows_of(profile_simple(to_long(df.drop("n"))))
    assert got == {"id_origem": ("int", None, 2), "numeroX": ("string", 1, None), "outro": ("string", 3, None),
                   "valid": ("int", None, 1), "teseJuridica": ("string", 3, None)}
    locked = rows_of(profile_simple(to_long(df, seq="n"), mode="first_seen"))
    assert locked["numeroX"] == ("int", None, 7) and locked["outro"] == ("string", 3, None)
    assert rows_of(suggest_ddl(profile_simple(to_long(df.drop("n"))))) == {
        "id_origem": ("SMALLINT",), "numeroX": ("VARCHAR(50)",), "outro": ("VARCHAR(50)",), "valid": ("SMALLINT",),
        "teseJuridica": ("TEXT",)}


def test_typed_schema_knowledge(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, 2.0D, 1.5D, DATE'2020-01-01', true, 'x', 'NaN', double('nan')),
        (300, 3.0D, 2.25D, DATE'2020-01-02', false, '5', '1', 1D) AS t(a, b, c, d, e, f, g, h)""")
    got = rows_of(profile_typed(to_long(df)))
    assert got["a"] == ("int", None, 300.0, None)
    assert got["b"] == ("int", None, 3.0, None)
    assert got["c"] == ("float", None, 2.25, 2)
    assert got["d"] == ("date", None, None, None)
    assert got["e"][0] == "boolean"
    assert got["f"] == ("string", 1, None, None)
    assert got["g"][0] == "string" and got["h"][0] == "string"
    ddl = rows_of(suggest_ddl(profile_typed(to_long(df))))
    assert [ddl[c][0] for c in "abcde"] == ["SMALLINT", "SMALLINT", "FLOAT8", "DATE ou TIMESTAMP", "BOOLEAN"]


# --- a sequential reader, for comparison ------------------------------------------------


def seq_kind(s):
    try:
        x = float(s)
        if math.isfinite(x):
            return ("float" if "." in s else "int"), x
    except ValueError:
        pass
    for fmt in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%d/%m/%Y"):
        try:
            datetime.strptime(s, fmt)
            return "date", s
        except ValueError:
            continue
    return "string", s


def sequential(values):
    state, length, top, places = None, 0, None, 0
    for v in values:
        if v is None:
            continue
        s = re.sub(r"\s{2,}", " ", re.sub(r"[\r\n\t]+", " ", v)).strip()
        kind, x = seq_kind(s)
        if kind == "date":
            state = "date"
        elif kind == "float" and state in (None, "int", "float"):
            state = "float"
            if "." in str(x):
                places = max(places, len(str(x).split(".")[-1]))
                top = max(top or 0.0, abs(x))
        elif kind == "int" and state in (None, "int"):
            state, x = "int", float(int(x))
            top = max(top or 0.0, abs(x))
        elif kind == "string" and state in (None, "string"):
            state, length = "string", max(length, len(s))
    return (state, length if state == "string" else None, top if state in ("int", "float") else None,
            places if state == "float" else None)


VALUES = st.sampled_from(["1", "-20", "300", "2.5", "-7.125", "0.50", "x", "abc d", "", " a\t b ", "2020-01-01",
                          "1/2/2020", "2020-13-01", "20200101", "1e3", "1.5.2", None])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(VALUES, min_size=5, max_size=5), min_size=1, max_size=25))
def test_typed_first_seen_is_the_sequential_reading(spark, table):
    names = [f"c{i}" for i in range(5)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(table)], "n long, " + ", ".join(f"{c} string" for c in names))
    got = rows_of(profile_typed(to_long(df.repartition(3), names, "n"), mode="first_seen"))
    want = {c: sequential([r[i] for r in table]) for i, c in enumerate(names)}
    assert got == {c: w for c, w in want.items() if w[0]}


def test_lattice_does_not_depend_on_order(spark):
    rows = [("1", "2.5"), ("x", "1"), ("2020-01-01", None)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "a string, b string").coalesce(1)
        assert rows_of(profile_typed(to_long(df))) == {"a": ("date", None, None, None), "b": ("float", None, 2.5, 1)}


def test_dynamic_records(spark):
    docs = [json.dumps([{"id": "1", "a": 5, "b": [1], "c": {"d": 1}, "e": None, "f": 2.5, "g": True},
                        {"ID": "2", "a": 70000, "h": "x" * 300}]), '{"id": "30"}']
    texts = spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)], "rel_path string, text string")
    records, rejects = parse_texts(texts)
    assert rejects.count() == 0
    got = rows_of(profile_typed(records_to_long(records)))
    assert got == {"id_origem": ("int", None, 30.0, None), "ID": ("int", None, 2.0, None), "a": ("int", None, 70000.0, None),
                   "f": ("float", None, 2.5, 1), "g": ("boolean", None, None, None), "h": ("string", 300, None, None)}
    keys = {r.key: r.n for r in key_discovery(records, F.map_keys("fields")).collect()}
    assert keys == {"id_origem": 2, "a": 2, "b": 1, "c": 1, "e": 1, "f": 1, "g": 1, "ID": 1, "h": 1}
    assert {r.signature: r.n for r in keyset_signatures(records, F.map_keys("fields")).collect()} == {
        "a,b,c,e,f,g,id": 1, "ID,a,h": 1, "id": 1}


def test_reports(spark):
    df = spark.createDataFrame([("a", "f1"), ("a", "f1"), ("a", "f2"), ("b", "f3")], "d string, f string")
    assert tuple(inventory_stats(df, F.col("d"), F.col("f")).first()) == (4, 3, 3)
    assert tuple(inventory_stats(df.limit(0), F.col("d"), F.col("f")).first()) == (0, 0, 1)
    assert [tuple(r) for r in group_count(df, "d").collect()] == [("a", 3), ("b", 1)]
    assert count_where(df, F.col("f") == "f1").first().n == 2
    assert {tuple(r) for r in row_counts({"x": df, "y": df.limit(1)}).collect()} == {("x", 4), ("y", 1)}


@pytest.mark.parametrize("value", [-(2**63), 2**63 - 1])
def test_extreme_numbers(spark, value):
    df = spark.createDataFrame([(value,)], "idX long")
    assert rows_of(profile_simple(to_long(df))) == {"idX": ("int", None, 2**63 - 1)}


def test_states_of_loads_merge_to_the_profile_of_all(spark, tmp_path):
    from ementario.operators import profile

    rows = [(i, str(i) if i % 5 else f"{i}.25", None if i % 4 else f"t{i % 7}", "2024-01-02" if i < 50 else "x") for i in range(90)]
    df = spark.createDataFrame(rows, "i int, a string, b string, c string")
    path = str(tmp_path / "states")
    for load in (0, 1, 2, 1):
        profile.store_profile(profile.to_long(df.filter(F.col("i") % 3 == load), ["a", "b", "c"]), path, load)
    got = {r.column: r.asDict() for r in profile.stored_profile(spark, path).collect()}
    want = {r.column: r.asDict() for r in profile.profile_typed(profile.to_long(df, ["a", "b", "c"])).collect()}
    assert {c: {k: v for k, v in r.items() if k not in ("n", "n_distinct")} for c, r in got.items()} == want
    assert {c: r["n"] for c, r in got.items()} == {"a": 90, "b": 23, "c": 90}
    assert {c: r["n_distinct"] for c, r in got.items()} == {"a": 90, "b": 7, "c": 2}
