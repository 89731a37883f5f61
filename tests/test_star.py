"""Star schema rows, their loading, upserts and constraint checks."""

from __future__ import annotations

import json
import re

import pytest

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ementario.functions.legal import reference_items
from ementario.operators import evolve, keys, quality
from ementario.operators import star as star_load
from ementario.operators.staging import rename_key
from ementario.operators.star import explode_subjects, fact_projection, legal_refs, load_star, with_id
from ementario.operators.upsert import (
    FIRST,
    LAST,
    VECTOR_POLICY,
    collapse,
    combine_states,
    dim_upsert,
    fact_policy,
    partial_state,
    state_rows,
    upsert,
)
from ementario.plans.star import stream_loads
from ementario.schemas import STAGING, TABLES
from ementario.session import scratch_run

CFD = "LEG:FED CFD:****** ANO:1988\n*****  CF-1988\n        ART:00005 INC:00034 LET:A     LET:B"
LEI = "LEG:FED LEI:008213 ANO:1991\n*****  LBPS-91\n        ART:00041 ART:00103"
PAR = "LEG:FED CFD:****** ANO:1988\n*****  ADCT-88\n        ART:00027 PAR:00001"
SUM = "LEG:FED SUM:****** ANO:****\n*****  SUM(STJ)\n        SUM:000340"
CASES = [  # item, as written, intended
    ("LEG:FED LEI:005890 ANO:1973", ("LEI", "005890", ""), ("LEI", "005890", "")),
    (CFD, ("CFD", "******", "ART:00005 INC:00034"), ("CFD", "******", "ART:00005 INC:00034")),
    (LEI, ("LEI", "008213", ""), ("LEI", "008213", "ART:00041")),
    (PAR, ("CFD", "******", ""), ("CFD", "******", "ART:00027 PAR:00001")),
    ("LEG:FED A:B ART:1 INC:2 PAR:3", ("A", "B", "ART:1 PAR:3 INC:2"), ("A", "B", "ART:1 PAR:3 INC:2")),
    (SUM, ("SUM", "******", ""), ("SUMULA", "SUMULA 000340", "")),
    ("SUM:000340", ("SUMULA", "SUMULA 000340", ""), ("SUMULA", "SUMULA 000340", "")),
    ("LEG:EST LEI:1", None, None),
    ("SUM:x", None, None),
]


def test_references(spark):
    df = spark.createDataFrame([(i, [c[0]]) for i, c in enumerate(CASES)], "id int, refs array<string>")
    for at, mode in ((1, "as_written"), (2, "intended")):
        got = {r[0]: tuple(r)[1:] for r in legal_refs(df, "id", F.col("refs"), mode).collect()}
        assert got == {i: c[at] for i, c in enumerate(CASES) if c[at]}


def test_reference_encodings(column):
    rows = [json.dumps(["a", "{b"]), json.dumps([{"referencia": "x\ny"}, {"o": 1}]), "{nope", '{"referencia": "x"}',
            '"s"', None, "[]", '{a,"b c"}', '["a"] junk', "['a']", '["a"],"v":["b"]', '["a"],"x":1', '["a"]},{"v":["b"]', '["a"]}', ' ["a"]\n']
    assert column(rows, reference_items) == [["a", "{b"], ["x\ny", ""], *[[]] * 12, ["a"]]


def staging(spark, rows):
    full = [{"load_id": 1, "id_dw": i, **r} for i, r in enumerate(rows)]
    ddl = "load_id bigint, " + STAGING.toDDL()
    return spark.createDataFrame([{c.name: r.get(c.name) for c in spark.createDataFrame([], ddl).schema} for r in full], ddl)


ROW = {"id_origem": "000389583", "dataDecisao": "19890912", "siglaClasse": "MS", "ementa": "MANDADO\nDE  SEGURANÇA",
       "decisao": "DEU\nPROVIMENTO", "tema": " 12 ", "termosAuxiliares": "a; b;;a", "teseJuridica": None,
       "dataPublicacao": "DJ DATA:23/10/1989\nX", "referenciasLegislativas": json.dumps([CFD, LEI, CFD])}


def test_fact(spark):
    df = staging(spark, [ROW, {**ROW, "id_origem": "abc"}])
    (fact,) = fact_projection(df).collect()
    assert (fact.id_julgado, fact.id_origem_natural, fact.resultado_binario) == (389583, "389583", True)
    assert (str(fact.dt_decisao), str(fact.dt_publicacao)) == ("1989-09-12", "1989-10-23")
    assert (fact.ementa_limpa, fact.tema_repetitivo, fact.tese_juridica_limpa) == ("MANDADO DE SEGURANÇA", "12", "")
    raw = json.loads(fact.teor_bruto_json)
    assert raw["ementa"] == "MANDADO\nDE  SEGURANÇA" and raw["notas"] is None
    subjects = {tuple(r)[1:] for r in explode_subjects(with_id(df.limit(1)), "id_julgado").collect()}
    assert subjects == {("TEMA_REPETITIVO", "12"), ("TERMO_AUXILIAR", "a"), ("TERMO_AUXILIAR", "b")}


def test_load_is_idempotent_and_ordered(spark, tmp_path):
    names = ("fato_julgados_stj", "dim_referencias_legais", "dim_assuntos_stj")
    first = staging(spark, [ROW, {**ROW, "ementa": "NOVA"}, {**ROW, "id_origem": "2"}])

    def state():
        return {n: sorted(map(str, spark.table(f"t1_{n}").drop("ordem_primeira", "ordem_ultima").collect())) for n in names}

    load_star(spark, first, str(tmp_path), "1", prefix="t1_")
    once = state()
    load_star(spark, first, str(tmp_path), "1", prefix="t1_")  # repeated at once
    assert state() == once
    load_star(spark, first.repartition(3), str(tmp_path), "2", prefix="t1_")
    assert state() == once
    fact = {r.id_julgado: r for r in spark.table("t1_fato_julgados_stj").collect()}
    assert fact[389583].ementa_limpa == "NOVA"
    assert json.loads(fact[389583].teor_bruto_json)["ementa"] == "MANDADO\nDE  SEGURANÇA"
    assert (len(once[names[1]]), len(once[names[2]])) == (4, 6)
    load_star(spark, first, str(tmp_path), "1", prefix="t1_")  # the same load again
    assert state() == once

    load_star(spark, staging(spark, [{**ROW, "id_origem": "3"}, {**ROW, "siglaClasse": "AR"}]), str(tmp_path), "3", prefix="t1_")
    fact = {r.id_julgado: r for r in spark.table("t1_fato_julgados_stj").collect()}
    assert sorted(fact) == [2, 3, 389583] and fact[389583].classe_sigla == "AR"
    assert json.loads(fact[389583].teor_bruto_json)["siglaClasse"] == "MS"
    before = state()
    for old in ("1", "2", "3"):  # loads repeated in any order change nothing
        load_star(spark, first if old != "3" else staging(spark, [{**ROW, "id_origem": "3"}, {**ROW, "siglaClasse": "AR"}]), str(tmp_path), old, prefix="t1_")
        assert state() == before
    assert spark.table("t1_dim_referencias_legais").groupBy("load").count().count() >= 2
    for dim, key in (("dim_referencias_legais", "id_ref_legal"), ("dim_assuntos_stj", "id_assunto")):
        numbers = [r[0] for r in spark.table(f"t1_{dim}").select(key).collect()]
        assert sorted(numbers) == list(range(1, len(numbers) + 1))
    assert spark.table("t1_dim_referencias_legais").count() == 6


def test_load_into_created_tables_with_large_ids(spark, tmp_path):
    layouts = {f"t3_{n}": s for n, s in TABLES.items() if n != "judged"}
    evolve.recreate(spark, layouts)
    rows = [{**ROW, "id_origem": "3000000000"}, {**ROW, "id_origem": "sem"}, {**ROW, "id_origem": "9" * 20}]
    load_star(spark, staging(spark, rows), str(tmp_path), "1", prefix="t3_")
    assert [r.id_julgado for r in spark.table("t3_fato_julgados_stj").collect()] == [3000000000]
    assert spark.table("t3_dim_assuntos_stj").count() == 3
    rejected = spark.read.parquet(f"{tmp_path}/t3_rejeitados").collect()
    assert sorted(json.loads(r.record)["id_origem"] for r in rejected) == ["9" * 20, "sem"]
    load_star(spark, staging(spark, rows), str(tmp_path), "1", prefix="t3_")
    assert spark.table("t3_dim_assuntos_stj").count() == 3
    evolve.drop_table(spark, "t3_dim_assuntos_stj")
    spark.sql("CREATE TABLE t3_dim_assuntos_stj (termo string) USING parquet")
    with pytest.raises(ValueError):  # asked before anything is written
        load_star(spark, staging(spark, rows), str(tmp_path), "2", prefix="t3_")
    assert spark.table("t3_fato_julgados_stj").count() == 1


def load(spark, root, prefix, number, rows, **how):
    load_star(spark, staging(spark, rows), root, number, prefix=prefix, **how)


def subject_ids(spark, prefix):
    return {(r.id_julgado_fk, r.termo): r.id_assunto for r in spark.table(f"{prefix}dim_assuntos_stj").collect()}


def test_a_repeated_load_that_grew_gets_further_ids(spark, tmp_path):
    def term(i, t):
        return {**ROW, "id_origem": str(i), "termosAuxiliares": t, "tema": None}

    root = str(tmp_path)
    load(spark, root, "t4_", "1", [term(1, "t1"), term(2, "t2")])
    load(spark, root, "t4_", "2", [term(3, "t3")])
    before = subject_ids(spark, "t4_")
    load(spark, root, "t4_", "1", [term(1, "t1"), term(2, "t2"), term(4, "t4"), term(5, "t5")])
    load(spark, root, "t4_", "2", [term(3, "t3"), term(6, "t6")])
    after = subject_ids(spark, "t4_")
    assert before.items() <= after.items() and sorted(after.values()) == list(range(1, 7))
    given = sorted(map(tuple, spark.read.parquet(f"{root}/t4_dim_assuntos_stj-faixas").collect()))
    assert given == [("1", 0, 2), ("1", 3, 2), ("2", 2, 1), ("2", 5, 1)]


def test_a_load_touches_its_buckets_only(spark, tmp_path):
    def files():
        return {r[0]: r[1] for r in spark.table("t5_fato_julgados_stj").select("id_julgado", "_metadata.file_path").collect()}

    root = str(tmp_path)
    load(spark, root, "t5_", "1", [{**ROW, "id_origem": str(i)} for i in range(40)], buckets=8)
    before, buckets = files(), {r.id_julgado: r.balde for r in spark.table("t5_fato_julgados_stj").collect()}
    assert len(before) == 40 and len(set(buckets.values())) == 8
    load(spark, root, "t5_", "2", [{**ROW, "id_origem": "7", "ementa": "NOVA"}, {**ROW, "id_origem": "100"}], buckets=99)
    after = files()
    touched = {buckets[7], spark.table("t5_fato_julgados_stj").filter("id_julgado = 100").first().balde}
    assert {i for i in before if before[i] != after[i]} == {i for i in before if buckets[i] in touched}
    assert len(after) == 41 and spark.table("t5_fato_julgados_stj").filter("ementa_limpa = 'NOVA'").count() == 1


def test_a_fact_of_another_layout_is_refused(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "id_julgado long, ementa_limpa string").write.saveAsTable("t6_fato_julgados_stj")
    with pytest.raises(ValueError, match="ordem_primeira"):
        load(spark, str(tmp_path), "t6_", "1", [ROW])
    assert spark.table("t6_fato_julgados_stj").count() == 2 and not list(tmp_path.iterdir())


def test_one_scan_of_staging_and_no_text_in_aggregates(spark, tmp_path):
    from ementario.operators.star import star_rows

    path = str(tmp_path / "staging")
    staging(spark, [ROW, {**ROW, "id_origem": "x"}, ROW]).write.parquet(path)
    df = spark.read.parquet(path)
    plans = []
    listener = lambda d: plans.append(d._jdf.queryExecution().executedPlan().toString())
    listener(star_rows(df, "1"))
    assert plans[0].count("FileScan") == 1
    # The written rows are all that the tables read: with the files gone, the load's other steps still work.
    rows = star_rows(df, "1").withColumn("_n", F.monotonically_increasing_id())
    from ementario.operators.upsert import collapse_wide

    policy = {"ementa_limpa": LAST, "teor_bruto_json": FIRST}
    plan = collapse_wide(rows.filter("id_julgado IS NOT NULL"), "id_julgado", policy, "at", "_n")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert collapse_wide(rows.filter("id_julgado IS NOT NULL"), "id_julgado", policy, "at", "_n").count() == 1  # equal rows are one


def test_upsert_rules(spark):
    policy = {"a": LAST, "raw": FIRST}
    target = spark.createDataFrame([(1, "old", "r1"), (2, "keep", "r2")], "id int, a string, raw string")
    batch = spark.createDataFrame(
        [(1, "x", "n1", 1), (1, None, "n2", 2), (3, "y", "n3", 1), (3, "z", "n4", 2), (4, "w", None, 1)],
        "id int, a string, raw string, seq int")
    want = {1: (None, "r1"), 2: ("keep", "r2"), 3: ("z", "n3"), 4: ("w", None)}
    once = upsert(target, batch, ["id"], policy, ["seq"])
    assert {r.id: (r.a, r.raw) for r in once.collect()} == want
    again = upsert(once, batch.repartition(3), ["id"], policy, ["seq"])
    assert {r.id: (r.a, r.raw) for r in again.collect()} == want
    assert fact_policy(["id_julgado", "a", "teor_bruto_json"]) == {"a": LAST, "teor_bruto_json": FIRST}
    assert VECTOR_POLICY["tipo_fonte"] == FIRST


def test_states_combine_in_any_grouping(spark):
    rows = [(i % 3, i, f"v{i}", None if i % 4 else f"r{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "k int, seq int, v string, raw string")
    policy = {"v": LAST, "raw": FIRST}
    parts = [df.filter(F.col("seq") % 5 == p) for p in range(5)]
    states = partial_state(parts[0], ["k"], policy, ["seq"])
    for p in parts[1:]:
        states = states.unionByName(partial_state(p, ["k"], policy, ["seq"]))
    split = state_rows(combine_states(states, ["k"]), ["k"], policy)
    assert sorted(split.collect()) == sorted(collapse(df, ["k"], policy, ["seq"]).collect())


def test_dimension_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    rows = spark.createDataFrame([(1, "a"), (3, "c"), (3, "c")], "id int, t string")
    assert sorted(map(tuple, dim_upsert(target, rows, ["id", "t"]).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_dense_keys(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    first = {r.k: r.n for r in keys.dense_keys(df, ["k"], "n", hex_digits=1).collect()}
    assert sorted(first.values()) == list(range(1, 1001))
    assert first == {r.k: r.n for r in keys.dense_keys(df.repartition(7), ["k"], "n", hex_digits=1).collect()}
    assert df.select(keys.hashed_key("k")).distinct().count() == 1000


def test_rename_key(spark):
    df = spark.createDataFrame([("1", "2", "x"), ("1", None, "y"), (None, None, "z")], "ID string, id_registro string, o string")
    assert [tuple(r) for r in rename_key(df).collect()] == [("2", "x"), ("1", "y"), (None, "z")]
    assert rename_key(df.select("o")).columns == ["o"]


def test_checks(spark):
    df = spark.createDataFrame([(1, "aa", [1.0]), (1, "a", [1.0, 2.0]), (2, None, None)], "k int, s string, v array<float>")
    assert [tuple(r) for r in quality.unique_violations(df, ["k"]).collect()] == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "pk int")
    assert [r.k for r in quality.fk_violations(df, "k", parent, "pk").collect()] == [2]
    assert {tuple(r) for r in quality.not_null_violations(df, ["k", "s"]).collect()} == {("k", 0), ("s", 1)}
    assert [tuple(r) for r in quality.width_violations(df, {"s": 1, "absent": 3}).collect()] == [("s", 1, 2, 1)]
    assert quality.vector_dim_check(df, "v", 2).count() == 2


def test_tables(spark, tmp_path):
    layouts = {f"t2_{n}": s for n, s in TABLES.items()}
    evolve.recreate(spark, layouts)
    evolve.create_if_missing(spark, "t2_judged", STAGING)
    assert spark.table("t2_judged").schema.names == STAGING.names
    spark.createDataFrame([(1, "k")], "id_assunto long, termo string").createOrReplaceTempView("v")
    spark.sql("INSERT INTO t2_dim_assuntos_stj (id_assunto, id_julgado_fk, tipo_assunto, termo) SELECT id_assunto, 1, 'T', termo FROM v")
    assert spark.table("t2_dim_assuntos_stj").count() == 1
    evolve.recreate(spark, layouts)
    assert spark.table("t2_dim_assuntos_stj").count() == 0
    for name in layouts:
        evolve.drop_table(spark, name)
        evolve.drop_table(spark, name)
    assert not spark.catalog.tableExists("t2_judged")

    path = str(tmp_path / "staging")
    good = spark.createDataFrame([("a",)], "s string")
    evolve.append_rows(good, path)
    broken = good.select(F.raise_error(F.lit("boom")).cast("string").alias("s"))
    try:
        evolve.append_rows(good.unionByName(broken), path)
    except Exception:  # noqa: BLE001
        pass
    assert spark.read.parquet(path).count() == 1
    evolve.append_rows(good, path)
    assert spark.read.parquet(path).count() == 2


def test_the_parts_of_a_stream_are_written_by_many_tasks(spark, tmp_path):
    orders = spark.range(900).selectExpr(
        "id AS o_orderkey", "id % 50 AS o_custkey", "'F' AS o_orderstatus", "DATE'2024-01-02' AS o_orderdate", "'1-URGENT' AS o_orderpriority")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    with scratch_run(spark) as folder:
        got = {r.part: r for r in stream_loads(spark, str(tmp_path)).collect()}
        arrived = spark.read.parquet(f"{folder}/stream-star-*/arrived").select(F.input_file_name().alias("f"), "id_dw")
        parts = [r.n for r in arrived.groupBy(F.col("id_dw") % 3).agg(F.countDistinct("f").alias("n")).collect()]
    assert len(parts) == 3 and min(parts) > 1
    assert (got["fact"].n, got["fact"].total) == (810, sum(k for k in range(900) if k % 10))
    for name in ("fato_julgados_stj", "dim_referencias_legais", "dim_assuntos_stj"):
        spark.sql(f"DROP TABLE IF EXISTS q4_{name}")


def test_a_stream_that_fails_when_started_anew_gives_no_result(spark, tmp_path, monkeypatch):
    orders = spark.range(60).selectExpr(
        "id AS o_orderkey", "id % 50 AS o_custkey", "'F' AS o_orderstatus", "DATE'2024-01-02' AS o_orderdate", "'1-URGENT' AS o_orderpriority")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    whole = star_load.load_dimensions

    def broken(session, rows, into, number, **kw):
        if number == "s1":
            raise RuntimeError("disk full")
        whole(session, rows, into, number, **kw)

    monkeypatch.setattr(star_load, "load_dimensions", broken)
    try:
        with scratch_run(spark), pytest.raises(StreamingQueryException, match="disk full"):
            stream_loads(spark, str(tmp_path))
    finally:
        for name in ("fato_julgados_stj", "dim_referencias_legais", "dim_assuntos_stj"):
            spark.sql(f"DROP TABLE IF EXISTS q4_{name}")


def test_fact_projection_stays_in_methods_that_the_jvm_compiles(spark):
    names = [f.name for f in STAGING.fields]
    df = spark.createDataFrame([], STAGING).select(*names)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        plan = fact_projection(df).drop("teor_bruto_json")._jdf.queryExecution().executedPlan()
        code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    assert all(int(n) < 8000 for n in re.findall(r"maxMethodCodeSize:(\d+)", code))


def fact_files(spark, prefix):
    return {r[0]: r[1] for r in spark.table(f"{prefix}fato_julgados_stj").select("id_julgado", "_metadata.file_path").collect()}


def test_a_repeated_load_rewrites_only_buckets_to_which_it_brings_something(spark, tmp_path):
    root = str(tmp_path)
    one, two = [{**ROW, "id_origem": str(i)} for i in range(20)], [{**ROW, "id_origem": str(i), "ementa": "NOVA"} for i in range(10, 30)]
    load(spark, root, "t7_", "1", one, buckets=8)
    load(spark, root, "t7_", "2", two)
    before = fact_files(spark, "t7_")
    load(spark, root, "t7_", "1", one)
    load(spark, root, "t7_", "2", two)
    assert fact_files(spark, "t7_") == before
    load(spark, root, "t7_", "1", [*one, {**ROW, "id_origem": "500"}])
    after, buckets = fact_files(spark, "t7_"), {r.id_julgado: r.balde for r in spark.table("t7_fato_julgados_stj").collect()}
    assert {i for i in before if before[i] != after[i]} == {i for i in before if buckets[i] == buckets[500]} and 500 in after
    assert {r.id_julgado for r in spark.table("t7_fato_julgados_stj").filter("ementa_limpa = 'NOVA'").collect()} == set(range(10, 30))


def test_rows_whose_key_comes_once_are_neither_joined_nor_moved(spark):
    from ementario.operators.upsert import collapse_wide

    df = spark.range(50).selectExpr("id AS k", "id AS n", "cast(id AS string) AS at", "'x' AS raw", "'y' AS a").union(
        spark.sql("SELECT cast(null AS bigint), 99L, '99', 'x', 'y'"))
    got = collapse_wide(df, "k", {"a": LAST, "raw": FIRST}, "at", "n")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert sorted(r.k for r in got.collect()) == list(range(50)) and all(r.ordem_primeira == r.ordem_ultima == str(r.k) for r in got.collect())


def test_loads_in_any_order_keep_the_first_record_and_the_last_writes(spark, tmp_path):
    import random

    rng = random.Random(5)
    loads = {n: [{**ROW, "id_dw": i, "id_origem": str(rng.randrange(9)), "ementa": f"{n}  {i}", "tema": None if i % 3 else str(i)}
                 for i in range(14)] for n in ("1", "2", "3")}
    for number in ("2", "3", "1", "2"):
        load(spark, str(tmp_path), "t8_", number, loads[number])
    want = {}
    for number in sorted(loads):
        for row in loads[number]:
            first = want.get(row["id_origem"], (row["ementa"],))[0]
            want[row["id_origem"]] = (first, " ".join(row["ementa"].split()), row["tema"] or "")
    got = {str(r.id_julgado): (json.loads(r.teor_bruto_json)["ementa"], r.ementa_limpa, r.tema_repetitivo)
           for r in spark.table("t8_fato_julgados_stj").collect()}
    assert got == want


def test_citation_parts_are_what_the_patterns_capture(spark):
    from ementario.functions.legal import NORM, PROVISION, SUMULA, reference_matches, reference_parts

    texts = [c[0].replace("\n", " ") for c in CASES] + [
        "", "LEG:FED LEI:1 ART:2 LEG:FED CFD:3 ART:4", "ART:1 INC: ART:2", "ART:a  PAR:", "ART:a  PAR:b c", "ART:x INC:y  z", "ART:x INC:y PAR:z",
        "ART:1 INC:2 PAR:3 INC:9", "LEG:FED ação:X9é", "LEG:FED LEI:** SUM:12x", "LEG:FED LEI:abc", "ART: ART:7PAR:1 INC:2", "SUM:", "xSUM:7"]
    names = ["_kind", "_name", "_sumula", "_art", "_inc", "_par"]
    for mode in PROVISION:
        df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
        found = df.select("i", *[c.alias(n) for n, c in reference_matches(F.col("t"), mode).items()])
        got = {r.i: [r[n] for n in names] for r in found.select("i", *[c.alias(n) for n, c in reference_parts().items()]).collect()}
        asked = [(NORM, 1), (NORM, 2), (SUMULA, 1), *[(PROVISION[mode], g) for g in (1, 2, 3)]]
        want = df.select("i", *[F.regexp_extract("t", p, g).alias(n) for n, (p, g) in zip(names, asked)])
        assert got == {r.i: [r[n] for n in names] for r in want.collect()}


def test_citations_and_subjects_are_worked_out_once(spark, tmp_path):
    path = str(tmp_path / "staging")
    staging(spark, [ROW, {**ROW, "referenciasLegislativas": None, "termosAuxiliares": None, "tema": " "}]).write.parquet(path)
    rows = with_id(spark.read.parquet(path))
    refs = legal_refs(rows, "id_julgado", reference_items(F.col("referenciasLegislativas")))
    terms = explode_subjects(rows, "id_julgado")
    for df, part in ((refs, "from_json"), (refs, "regexp_extract(_text"), (terms, "split(")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "size(" not in plan and part in plan
    assert (refs.count(), terms.count()) == (3, 4)
