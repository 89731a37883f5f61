"""Record files: reading, rejects, incremental loads, streams."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from ementario.functions.text import clean_json_array
from ementario.operators import staging as st
from ementario.operators.profile import profile_files
from ementario.schemas import LONG_FIELDS, SOURCE
from ementario.sources import folders, json_files, manifest, tables
from ementario.sources import texts as places
from ementario.sources.pages import page_links, resource_links, scan_resources
from ementario.streaming.ingest import record_stream, start_staging
from ementario.streaming.upserts import compact, compact_in_place, read_upserted, start_upsert
from ementario.operators.upsert import FIRST, LAST, collapse

RECORD = {
    "id": "000389583", "numeroProcesso": "15", "siglaClasse": "MS", "ementa": "LINHA 1\nLINHA  2",
    "dataPublicacao": "DJ         DATA:23/10/1989      PG:16185\nRSTJ       VOL.:00005", "dataDecisao": "19890912",
    "referenciasLegislativas": ["LEG:FED LEI:1\n ART:2", "b\tc"], "acordaosSimilares": [], "notas": None,
    "ministroRelator": "M" * 95,
}


def write(folder, files):
    for name, text in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")


FILES = {
    "a/list one+.json": json.dumps([RECORD, {"id_registro": "2", "extra": {"x": 1}}]),
    "a/ação.json": json.dumps({**RECORD, "id": "3"}),
    "scalar.json": "42",
    "text.json": '"x"',
    "cut.json": '[{"id": "4"}, {"id":',
    "mixed.json": '[1, {"id": "5"}]',
    "empty.json": "[]",
    "noid.json": json.dumps([{"ementa": "sem id"}]),
    "lines.json": '{"id": "50"}\n{"id": "51"}',
    "after.json": '[{"id": "52"}] junk',
    "quotes.json": "{'id': '53'}",
    "further.json": '[{"id":"54"}],"v":[{"id":"55"}]',
    "other.json": '[{"id":"56"}],"x":[2]',
    "closed.json": '{"id":"57"}},{"v":{"id":"58"}',
    "nothing.json": "[null]",
    "zero.json": "",
    "a/dados[1].json": json.dumps({"ID": "6"}, indent=2),
    "a/{x}?.json": json.dumps([{"id": "1", "Id_Registro": "8"}, {"ID_REGISTRO": "1", "id": "9"}], indent=1),
    "ignored.JSON": "[]",
    "ignored.txt": "[]",
}
BAD = {**dict.fromkeys(("further.json", "other.json", "closed.json"), "malformed_json"), "scalar.json": "invalid_shape", "text.json": "invalid_shape", "cut.json": "malformed_json",
       "mixed.json": "invalid_shape", "lines.json": "malformed_json", "after.json": "malformed_json",
       "quotes.json": "malformed_json", "nothing.json": "invalid_shape", "zero.json": "malformed_json"}
IDS = ["000389583", "2", "3", "6", "8", "9"]


def test_readers(spark, tmp_path):
    write(tmp_path, FILES)
    base = str(tmp_path)
    names = {r.rel_path for r in folders.list_folder(spark, base, json_files.PATTERN).collect()}
    assert names == {n for n in FILES if n.endswith(".json")}
    records, rejects = json_files.read_records(spark, base, base)
    assert sorted(r.id_origem for r in records.collect() if r.rel_path != "noid.json") == IDS
    assert records.count() == 7 and rejects.count() == len(BAD) - 1  # counts work on their own
    assert dict(rejects.groupBy("rel_path").count().collect())["cut.json"] == 1
    assert {r.rel_path: r.reason for r in rejects.collect()} == {k: v for k, v in BAD.items() if k != "zero.json"}
    dynamic, rejects = json_files.read_dynamic(spark, base, base)
    assert {r.rel_path: r.reason for r in rejects.collect()} == {k: v for k, v in BAD.items() if k != "zero.json"}
    ids = dynamic.select("rel_path", st.rename_map_key(F.col("fields")).cast("string").alias("id"))
    assert sorted(r.id for r in ids.collect() if r.id) == IDS


def test_map_key_order(spark):
    texts = spark.createDataFrame([("f", '[{"ID": "1", "id_registro": "2"}, {"Id_Registro": 3, "id": "4"}]')], "rel_path string, text string")
    records, _ = json_files.parse_texts(texts)
    got = records.select(st.rename_map_key(F.col("fields")).cast("string")).collect()
    assert [r[0] for r in got] == ["2", "4"]


def test_stage(spark):
    df = spark.createDataFrame([json.dumps(RECORD)], "string").select(F.from_json("value", SOURCE).alias("r")).select("r.*")
    good, bad = st.stage(df)
    (r,) = good.collect()
    assert (r.id_origem, r.dataDecisao, r.dataPublicacao) == ("000389583", "1989-09-12", "1989-10-23")
    assert (r.ementa, r.referenciasLegislativas, r.acordaosSimilares) == ("LINHA 1 LINHA 2", '["LEG:FED LEI:1 ART:2","b c"]', "[]")
    assert len(r.ministroRelator) == 90 and bad.count() == 0
    loose, _ = st.stage(df, widths="load")
    assert len(loose.first().ministroRelator) == 95


def test_json_arrays(column):
    rows = ['["a\\n b", " c "]', '["a\\n", 1]', "[bad\n", '{"a":\n1}', " x\ny ", None, "[]"]
    assert column(rows, clean_json_array) == ['["a b","c"]', '["a\\n", 1]', "[bad", '{"a": 1}', "x y", None, "[]"]


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_incremental_load(spark, tmp_path, scheme):
    base = tmp_path / "in"
    write(base, FILES)
    staging, quarantine, done = (str(tmp_path / n) for n in ("staging", "quarantine", "manifest"))
    load = lambda n=None: st.load_files(spark, f"{scheme}{base}", staging, quarantine, done, n)
    seen = lambda: sorted(r.id_origem for r in spark.read.parquet(staging).collect())
    assert load() == 1
    assert seen() == IDS
    reasons = {(r.rel_path, r.reason) for r in spark.read.parquet(quarantine).collect()}
    assert reasons == {*BAD.items(), ("noid.json", "missing id_origem")}
    (kept,) = [r.record for r in spark.read.parquet(quarantine).collect() if r.rel_path == "noid.json"]
    assert json.loads(kept) == {"ementa": "sem id"}
    processed = {r.rel_path for r in manifest.read_manifest(spark, done).collect()}
    assert processed == {n for n in FILES if n.endswith(".json") and n not in BAD}
    assert load() == 2  # what cannot be read is tried again
    assert seen() == IDS
    write(base, {"cut.json": json.dumps({"id": "4"}), "new/n.json": json.dumps([{"ID": "x", "id": "99"}])})
    with pytest.raises(ValueError):
        load(1)  # it holds other files
    assert seen() == IDS
    load()
    assert seen() == sorted([*IDS, "4", "99"])
    load()
    assert seen() == sorted([*IDS, "4", "99"])
    assert manifest.read_manifest(spark, str(tmp_path / "none")).count() == 0


def test_folders_are_listed_by_tasks(spark, tmp_path):
    write(tmp_path, {f"d{k % 3}/e{k % 2}/f{k}.json": "{}" * (k % 4) for k in range(30)} | {"top.json": "{}", "_hidden/x.json": "", ".y.json": "", "d1/z.txt": ""})
    got = folders.list_folder(spark, str(tmp_path), "*.json")
    assert got.rdd.getNumPartitions() == 4  # the root's files and three folders
    want = {f"d{k % 3}/e{k % 2}/f{k}.json": 2 * (k % 4) for k in range(30)} | {"top.json": 2}
    assert {r.rel_path: r.size for r in got.collect()} == want
    texts = {r.rel_path: r.text for r in folders.open_files(got, str(tmp_path)).collect()}
    assert texts == {n: "{}" * (s // 2) for n, s in want.items()}


def test_a_load_that_died_is_repeated(spark, tmp_path, monkeypatch):
    base = tmp_path / "in"
    write(base, {"a.json": '{"id": "1"}'})
    paths = [str(tmp_path / n) for n in ("staging", "quarantine", "manifest")]
    with monkeypatch.context() as m:
        m.setattr(st, "append_manifest", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            st.load_files(spark, str(base), *paths)
    write(base, {"b.json": '{"id": "2"}'})
    assert st.load_files(spark, str(base), *paths) == 1
    assert sorted(r.id_origem for r in spark.read.parquet(paths[0]).collect()) == ["1", "2"]
    assert st.load_files(spark, str(base), *paths) is None


def test_streamed_load_equals_batch(spark, tmp_path):
    base = tmp_path / "in"
    write(base, FILES)
    out, bad, ckpt = (str(tmp_path / n) for n in ("s", "q", "c"))

    def run():
        start_staging(record_stream(spark, str(base), files_per_batch=2), out, bad, ckpt).awaitTermination()

    run()
    records, _ = json_files.read_records(spark, str(base), str(base))
    batch = st.to_staging(st.stage(records)[0], 0).drop("id_dw", "load_id")
    streamed = spark.read.parquet(out).select(*batch.columns)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
    seen_by_stream = {k: v for k, v in BAD.items() if k != "zero.json"}
    assert {(r.rel_path, r.reason) for r in spark.read.parquet(bad).collect()} == {*seen_by_stream.items(), ("noid.json", "missing id_origem")}
    write(base, {"later.json": json.dumps({"id": "77"})})
    run()
    assert spark.read.parquet(out).filter("id_origem = '77'").count() == 1
    assert spark.read.parquet(out).count() == batch.count() + 1


def test_streamed_upsert(spark, tmp_path):
    rows = [(i % 7, i, f"v{i}", f"r{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "k int, seq int, v string, raw string")
    src = str(tmp_path / "src")
    df.repartition(6).write.parquet(src)
    policy = {"v": LAST, "raw": FIRST}
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(src)
    start_upsert(stream, f"{tmp_path}/st", f"{tmp_path}/ck", ["k"], policy, ["seq"]).awaitTermination()
    want = sorted(collapse(df, ["k"], policy, ["seq"]).collect())
    assert sorted(read_upserted(spark, f"{tmp_path}/st", ["k"], policy).collect()) == want
    compact(spark, f"{tmp_path}/st", f"{tmp_path}/st2", ["k"])
    assert sorted(read_upserted(spark, f"{tmp_path}/st2", ["k"], policy).collect()) == want
    for _ in range(2):  # compacted where it is, also again, and the stream goes on
        compact_in_place(spark, f"{tmp_path}/st", ["k"])
        assert sorted(read_upserted(spark, f"{tmp_path}/st", ["k"], policy).collect()) == want
    assert spark.read.parquet(f"{tmp_path}/st").select("batch_id").distinct().count() == 1
    df.filter("seq > 90").write.mode("append").parquet(src)  # replayed rows change nothing
    stream = spark.readStream.schema(df.schema).parquet(src)
    start_upsert(stream, f"{tmp_path}/st", f"{tmp_path}/ck", ["k"], policy, ["seq"]).awaitTermination()
    assert sorted(read_upserted(spark, f"{tmp_path}/st", ["k"], policy).collect()) == want


def test_tables(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, t string")
    assert tables.schema_probe(df) == ["id", "t"]
    assert [r.id for r in tables.preview(df, "id", 2).collect()] == [1, 2]
    assert [tuple(r) for r in tables.ordered_projection(df, ["t"], "id").collect()] == [("a",), ("b",), ("c",)]
    options = tables.jdbc_options("jdbc:x", "judged", "id_dw", 1, 1000, 8)
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "id_dw"
    assert tables.spread(spark.range(10)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


INDEX = """<html><body><a href="/no">x</a><section id="dataset-resources"><ul>
<li><a href="/top">t</a><div><br><ul><li><a href="/p1">p</a></li><li><a href="f1.json?a=1&amp;b=2">f</a><a>none</a></li></ul></div></li>
<li><div><ul><li><a href="/p2">p</a></li><li><span><a href="/nested">x</a></span><a href="/f2.json">f</a></li><li><a href="/api">a</a></li></ul></div></li>
</ul></section><ul><li></li><li><a href="/outside">o</a></li></ul></body></html>"""


def test_pages(spark):
    df = spark.createDataFrame([(1, "http://h/set", INDEX), (2, "u", "<p>none"), (3, "u", None)], "page_id long, url string, html string")
    assert [(r.page_id, r.pos, r.href) for r in resource_links(df).collect()] == [(1, 0, "f1.json?a=1&b=2"), (1, 1, "/f2.json")]
    assert page_links(df).count() == 9


def test_page_links_in_all_forms(spark):
    html = """<a href='x'>1</a><A class=b HREF = y/z>2</A><!-- <a href="no">c</a> --><a data-href="n" href="a?b=1&amp;c=2">3</a><abbr href="q">"""
    df = spark.createDataFrame([(1, "u", html), (2, "u", "<!-- <a href='open'>")], "page_id long, url string, html string")
    assert [(r.pos, r.href) for r in page_links(df).collect()] == [(0, "x"), (1, "y/z"), (2, "a?b=1&c=2")]


def test_links_in_scripts_and_character_references(spark):
    html = """<script type=x>var a = '<a href="no">';</script><a href="caf&eacute;&#233;&#xE9;?a=1&amp;b=&copy;2">1</a><STYLE><a href="no"></style >
    <a href="&amp;eacute;&nix;&#0;&#x1F600;&apos;&lt;">2</a><a href="plain">3</a><script><a href="open">"""
    df = spark.createDataFrame([(1, "u", html), (2, "u", None), (3, "u", "")], "page_id long, url string, html string")
    assert [(r.pos, r.href) for r in page_links(df).collect()] == [(0, "cafééé?a=1&b=©2"), (1, "&eacute;&nix;&#0;😀'<"), (2, "plain")]


def test_one_bad_page_does_not_end_the_scan(spark):
    df = spark.createDataFrame([(1, "http://h/set", INDEX), (2, "u", "<![foo[ x ]]>" + INDEX)], "page_id long, url string, html string")
    found = scan_resources(df).collect()
    assert [r.page_id for r in found if r.error is None].count(1) == 2
    assert resource_links(df).filter("page_id = 1").count() == 2


def test_profile_of_a_folder(spark, tmp_path):
    write(tmp_path, FILES)
    inventory, profile, rejects = profile_files(spark, str(tmp_path))
    (n,) = inventory.collect()
    assert (n.n_rows, n.n_files, n.n_folders) == (7, len([f for f in FILES if f.endswith(".json")]), 2)
    rows = {r.column: r for r in profile.collect()}
    assert rows["ministroRelator"].max_len == 95 and rows["tema"].max_len == 0 and rows["numeroProcesso"].max_val == 15
    assert set(rows) >= set(LONG_FIELDS) and rejects.count() == len(BAD) - 1
    _, typed, _ = profile_files(spark, str(tmp_path), typed=True)
    assert {r.column: r.type for r in typed.collect()}["notas"] == "string"


def test_ordered_projection_leaves_texts_out_of_the_shuffle(spark, monkeypatch):
    rows = [(k * 7 % 40 if k % 9 else None, k % 5) for k in range(40)]
    df = spark.createDataFrame(rows, "id int, at int")
    texts = spark.createDataFrame([(0, "a"), (1, "b\n" * 90), (2, None), (2, "twice")], "k int, text string")
    want = df.join(texts, F.col("at") == F.col("k"), "left").select("id", "text")
    plans = []
    for most in (tables.LOOKUP_BYTES, 0):
        monkeypatch.setattr(tables, "LOOKUP_BYTES", most)
        got = tables.ordered_projection(df, ["id", "text"], "id", texts, F.col("at") == F.col("k"))
        found = [tuple(r) for r in got.collect()]
        assert [r[0] for r in found] == sorted((r[0] for r in found), key=lambda x: (x is not None, x))
        assert sorted(map(str, found)) == sorted(str(tuple(r)) for r in want.collect())
        plans.append(got._jdf.queryExecution().executedPlan().toString())
    sent = plans[0].partition("Initial Plan")[0]
    assert sent.count("Exchange rangepartitioning") == 1 and sent.index("Exchange rangepartitioning") > sent.index("BroadcastHashJoin")


def test_ordered_projection_sorts_places_of_texts_that_are_too_large_to_send(spark, monkeypatch):
    long = "".join(chr(97 + k * k * 7 % 26) for k in range(300))
    texts = spark.createDataFrame(
        [(k, "ção" + long[k:] if k % 4 else None, "" if k % 3 else f"n{k}", k * 2) for k in range(50)] + [(7, "twice", None, 1), (None, "x", "x", 1)],
        "k int, text string, note string, n int").repartition(3)
    df = spark.createDataFrame([(r * 37 % 400 if r % 50 else None, r % 60 if r % 11 else None) for r in range(400)], "id int, at int")
    on = F.col("at") == F.col("k")
    want = df.join(texts, on, "left").select("text", "id", "n", "note")
    monkeypatch.setattr(tables, "LOOKUP_BYTES", 0)
    for piece in (places.PIECE_BYTES, 1000):
        monkeypatch.setattr(places, "PIECE_BYTES", piece)
        got = tables.ordered_projection(df, ["text", "id", "n", "note"], "id", texts, on)
        found = [tuple(r) for r in got.collect()]
        assert [r[1] for r in found] == sorted((r[1] for r in found), key=lambda x: (x is not None, x or 0))
        assert sorted(map(str, found)) == sorted(str(tuple(r)) for r in want.collect())
        plan = got._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
        assert "rangepartitioning" in plan and all("text#" not in line for line in plan[plan.index("rangepartitioning") :].splitlines())
    by_text = tables.ordered_projection(df, ["id", "text"], "id", texts, F.concat(F.lit("n"), F.col("at")) == F.col("note"))
    assert by_text.count() == 400
    by_wide = tables.ordered_projection(df, ["id", "note"], "id", texts, F.concat(F.lit("n"), F.col("at")) == F.col("note"))
    assert sorted(r.note for r in by_wide.collect() if r.note)[:1] == ["n0"]
    assert tables.ordered_projection(df, ["id", "text"], "id", texts.limit(0), on).count() == 400
