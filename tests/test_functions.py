"""Column functions against values derived by reading the described behaviour."""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ementario.functions import dates, legal, numbers, text, urls, vectors

NBSP = "\xa0"


def py_clean(s: str) -> str:
    return re.sub(r"\s{2,}", " ", re.sub(r"[\r\n\t]+", " ", s)).strip()


def py_clean_full(s: str | None) -> str:
    return "" if s is None else re.sub(r"\s+", " ", s).strip()


SPACES = ["a  b", " a\r\nb ", "a\tb", f"a{NBSP}b", f"a{NBSP}{NBSP}b", "a\x0cb", f"a {NBSP}b", " x ",
          "a  b", "x—y  z", "\x1ca\x1cb\x1c\x1c", "", "   ", "\n", "a \n b", "a　\nb", "a b"]


def test_whitespace(column):
    assert column(SPACES, text.ws_normalize) == [py_clean(s) for s in SPACES]
    assert column(SPACES + [None], text.ws_normalize_full) == [py_clean_full(s) for s in SPACES + [None]]
    assert column([None], text.ws_normalize) == [None]
    assert column([f" {NBSP}x\x1f ", " 　"], text.strip) == ["x", ""]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=list(" \t\r\n\x0c\x1c\x85\xa0  — 　aé0"), max_size=12), min_size=30, max_size=60))
def test_whitespace_random(column, values):
    assert column(values, text.ws_normalize) == [py_clean(v) for v in values]
    assert column(values, text.ws_normalize_full) == [py_clean_full(v) for v in values]


def test_whitespace_is_matched_by_table_and_replaced_only_where_it_changes(spark):
    assert "-" not in text.WS_LATIN1  # a range is tested per character, a single character looked up
    plan = spark.range(1).select(text.ws_normalize(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert "replace(cast" not in plan.replace("regexp_replace", "")  # one pass, not one more for each of CR, LF and TAB


def test_arrays(column):
    rows = [[" Linha 1\r\n", " Linha 2 \t com tab ", "Linha 3\n\nFinal. "], None, [], ["a", None]]
    assert column(rows, text.clean_array, "array<string>") == [
        ["Linha 1", "Linha 2 com tab", "Linha 3 Final."], [], [], ["a", ""]]
    assert column([[" a ", None], [" a ", "b\n"], None], text.clean_array_if_text, "array<string>") == [
        [" a ", None], ["a", "b"], None]
    assert column([["a", None, " b\n"], None, []], text.ws_normalize_joined, "array<string>") == ["a b", "", ""]


def test_terms_and_template(column):
    assert column(["a; b ;;c\n d;", "", None, ";"], text.split_terms) == [["a", "b", "c d"], [], [], []]
    assert column(["x", None], lambda c: text.embed_text(c, F.lit("y"))) == [
        "Ementa: x\n\nDecisão: y", "Ementa: \n\nDecisão: y"]
    # 8 characters before the text, 2 line breaks and 9 after it; the last space is stripped.
    long = ["e" * n for n in (31, 32, 33)]
    assert column(long, lambda c: text.long_enough(text.embed_text(c, F.lit("")))) == [False, True, True]


def test_truncation(spark):
    df = spark.createDataFrame([("é" * 400,) * 5], "numeroProcesso string, dataPublicacao string, ministroRelator string, outro string, ementa string")
    lengths = lambda d: [len(v) for v in d.first()]
    assert lengths(text.truncate_columns(df, text.load_limits(df.columns, "load"))) == [50, 300, 255, 255, 400]
    assert lengths(text.truncate_columns(df, text.load_limits(df.columns))) == [50, 300, 90, 255, 400]


DATES = {
    "23/10/1989": "1989-10-23", "23-10-1989": "1989-10-23", "19890912": "1989-09-12",
    "1989-09-12": "1989-09-12", "1989/09/12": "1989-09-12", "1/2/2020": "2020-02-01",
    "31/02/2020": "31/02/2020", "DJ  DATA:23/10/1989  PG:1": "1989-10-23",
    "DJE DATA:05/09/2024\nRSTJ VOL.:1": "2024-09-05", "x DATA: 1/2/2020 DATA:3/4/2021": "2020-02-01",
    "DATA:01/01/2020DATA:x": "2020-01-01", "data:01/01/2020": "2020-01-01", "": "", "  ": "",
    " livre ": "livre", "DATA:": "DATA:", "1989091": "1989091", "00/00/0000": "00/00/0000",
    "01/01/0000": "01/01/0000",
}


def test_dates(column):
    assert column(list(DATES), dates.date_multi_format) == list(DATES.values())
    assert column([None], dates.date_multi_format) == [None]
    typed = {
        "19890912": dt.date(1989, 9, 12), "DJ  DATA:23/10/1989  PG:1": dt.date(1989, 10, 23),
        "DATA:31/02/2020": None, "a DATA:05/09/2024\nDATA:06/09/2024": dt.date(2024, 9, 5),
        "1989-09-12": dt.date(1989, 9, 12), "1989-9-2": dt.date(1989, 9, 2), "23/10/1989": None,
        "19891332": None, "data:01/01/2020": None, "": None, "19890912 ": None,
    }
    assert column(list(typed), dates.date_typed) == list(typed.values())


def test_typed_dates_are_parsed_once_and_refuse_the_year_zero(spark):
    values = ["00000101", "00010101", "0000-01-01", "0001-1-1", "DATA:01/01/0000", "DATA:01/01/0001", "20240230"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(dates.date_typed(F.col("v")).cast("string").alias("d"))
    assert [r.d for r in df.collect()] == [None, "0001-01-01", None, "0001-01-01", None, "0001-01-01", None]
    assert df._jdf.queryExecution().analyzed().toString().count("try_to_date(") == 3


def test_date_columns(spark):
    df = spark.createDataFrame([("1/2/2020", "1/2/2020")], "DATADECISAO string, outra string")
    assert tuple(dates.apply_date_fields(df).first()) == ("2020-02-01", "1/2/2020")


NUMBERS = ["12", " 12 ", "12.0", "12.75", "1e5", "-7", "1.2.3", "1d", "1_0", "nan", "inf", "", None, "+.5", "5.",
           "1e400", "9" * 30, "2024-01-01", "texto", "١٢"]


def test_numbers(column):
    assert column(NUMBERS, numbers.int_lenient) == [
        12, 12, 12, 12, 100000, -7, None, None, 10, None, None, None, None, 0, 5, None, None, None, None, None]
    kinds = ["12", " 12 ", "12.0", "1e5", "1.2.3", "nan", "inf", "", None, "2024-01-01", "2024-01-01 10:00:00",
             "01/02/2024", "20240101", "2024-13-01", "true"]
    assert column(kinds, numbers.value_kind) == [
        "int", "int", "float", "int", "string", "string", "string", "string", None, "date", "date", "date",
        "int", "string", "string"]
    floats = [12.75, 12.0, 0.1, 1e7, 12345678.25, 1.5e-4, 0.001, 123456789.125]
    assert column(floats, numbers.decimal_places, "double") == [2, 1, 1, 1, 2, 5, 3, 3]


def test_ids(spark):
    rows = [("000389583", None), (None, "15"), ("x", " 7 "), ("99999999999", "3"), ("9.5", "a"), (None, None),
            ("9" * 20, "3"), ("", "3000000000")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r.o for r in df.select(numbers.int_id(F.col("a"), F.col("b")).alias("o")).collect()]
    assert got == [389583, 15, 7, 99999999999, None, None, None, 3000000000]


def test_patterns_that_a_phrase_implies_are_not_run(spark):
    df = spark.createDataFrame([("CONHECER EM PARTE E DAR PROVIMENTO",), ("CONHECER E",), ("A1B",)], "t string")
    found = legal.outcome_of_text(F.col("t"))
    assert [r[0] for r in df.select(found).collect()] == [True, None, None]
    assert "RLIKE" not in df.select(found)._jdf.queryExecution().analyzed().toString()
    # Others are, also those that hold a phrase but match without it.
    others = legal.outcome_of_text(F.col("t"), ("DAR", "A[0-9]B", "C.*DARE?"), ("E",))
    assert [r[0] for r in df.select(others).collect()] == [True, False, True]


def test_outcome(column):
    values = ["deu provimento", "Negar\nprovimento ao recurso", "NEGAR PROVIMENTO e dar  provimento", "CONCEDER",
              "não conhecer do recurso", None, "conhecer do agravo e dar provimento", "JULGAR IMPROCEDENTE"]
    want = [True, False, True, None, False, None, True, False]
    assert column(values, lambda c: legal.outcome(c, F.lit("x"))) == want
    assert column(values, lambda c: legal.outcome(F.lit(None).cast("string"), c)) == want


@pytest.mark.parametrize("base,href", [
    ("http://h/a/b", "/x"), ("http://h/a/b", "x.json"), ("http://h/a/b", "http://o/x"), ("http://h/a/b", "//o/x"),
    ("http://h/a/b?q=1#f", "?z=2"), ("http://h/a/b?q=1#f", "#g"), ("http://h/a/b/", "../c/./d?x=1"),
    ("http://h", "x"), ("http://h/a/b/c", "../../../d"), ("https://h/a/b", "mailto:z@y"), ("http://h/a b/c", "d é.json"),
    ("http://h/a/b", "x/.."), ("http://h/p", ""),
])
def test_links(spark, base, href):
    df = spark.createDataFrame([(base, href)], "b string, h string")
    assert df.select(urls.resolve_link(F.col("b"), F.col("h"))).first()[0] == urljoin(base, href)


def test_names(column):
    names = {"http://h/a/b.json?x=1#y": "b.json", "http://h/a/": "downloaded_file", "http://h": "downloaded_file",
             "http://h/a/ação (1)*.json": "ação1.json", "http://h/a/b;v=1": "b", "http://h/a|b/c d_e-f": "cd_e-f"}
    assert column(list(names), urls.file_name) == list(names.values())
    assert column(["http://h/a/b", "x"], urls.last_segment) == ["b", "x"]
    paths = ["file:///d/base/a%20b/c+d.json", "file:/d/base/x.json", "hdfs://n/d/base/y.json"]
    assert column(paths, lambda c: urls.relative_path(c, "/d/base")) == ["a b/c+d.json", "x.json", "/n/d/base/y.json"]


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([1.0, 0.0], [-3.0, 0.0]),
                                ([0.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 0.0])], "a array<float>, b array<float>")
    got = [r.d for r in df.select(vectors.cosine_distance(F.col("a"), F.col("b")).alias("d")).collect()]
    assert got[:3] == pytest.approx([1.0, 0.0, 2.0])
    assert got[3:] == [None, None]
    assert df.select(vectors.vector_literal(F.col("a"))).first()[0] == "[1.0,0.0]"
