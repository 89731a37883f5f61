"""Queries: reading record files, cleaning, typing, required fields, increments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ementario.functions.dates import date_multi_format, date_typed
from ementario.functions.numbers import int_lenient, value_kind
from ementario.functions.text import (
    clean_array,
    embed_text,
    load_limits,
    long_enough,
    split_terms,
    strip,
    truncate_columns,
    ws_normalize,
    ws_normalize_full,
    ws_normalize_joined,
)
from ementario.operators.batches import key_signature, keyset_batches
from ementario.operators.evolve import add_nullable, drop_column, rename_column
from ementario.operators.keys import key_discovery, keyset_signatures
from ementario.operators.reports import inventory_stats
from ementario.operators.staging import load_files, rename_key, required_field_split
from ementario.operators.star import id_fallback_parse, pack_row_json
from ementario.plans.bindings import judged_like, judged_sql, sql_clean, sql_clean_full, sql_strip, sql_typed_date, with_text_key
from ementario.plans.registry import query
from ementario.session import scratch_path
from ementario.sources.json_files import read_dynamic, read_records
from ementario.sources.manifest import pending
from ementario.sources.tables import ordered_projection, preview, read_table, spread

# --- record files ------------------------------------------------------------------

CONVERSATIONS_PER_FILE = 200


def _conversation_files(spark: SparkSession, sf_dir: str, damage: bool) -> str:
    """Write the conversations as ``*.json``-like record files in the shared folder, indented over several lines.

    A file holds the list of the rows of ``CONVERSATIONS_PER_FILE`` neighbouring conversations, but for the first row of
    the first conversation, which is a file with one object; ``damage`` adds a truncated and a scalar file to each, and two with text after the value.
    """
    single = (F.col("conv_id") % CONVERSATIONS_PER_FILE == 0) & (F.col("turn") == 0)
    placed = read_table(spark, sf_dir, "conversations").select(
        F.floor(F.col("conv_id") / CONVERSATIONS_PER_FILE).alias("run"), single.alias("single"),
        F.struct("conv_id", "turn", "role", "text").alias("rec"),
    )
    lists = placed.filter(~F.col("single")).groupBy("run").agg(F.to_json(F.collect_list("rec"), {"pretty": "true"}).alias("value"))
    ones = placed.filter("single").select("run", F.to_json("rec", {"pretty": "true"}).alias("value"))
    whole = lists.select(F.concat_ws("-", "run", F.lit("list")).alias("f"), "value").union(
        ones.select(F.concat_ws("-", "run", F.lit("one")).alias("f"), "value")
    )
    if damage:
        cut = F.substring("value", 1, F.floor(F.char_length("value") / 2).cast("int"))
        variants = F.array(
            F.struct(F.lit("good").alias("d"), F.col("value").alias("value")),
            F.struct(F.lit("cut").alias("d"), cut.alias("value")),
            F.struct(F.lit("scalar").alias("d"), F.char_length("value").cast("string").alias("value")),
            F.struct(F.lit("further").alias("d"), F.concat("value", F.lit(',"v":[{"id":"1"}]')).alias("value")),
            F.struct(F.lit("another").alias("d"), F.concat("value", F.lit(',"x":[2]')).alias("value")),
        )
        whole = whole.select(F.col("f").alias("_f"), F.inline(variants)).select(
            F.concat_ws("-", "_f", "d").alias("f"), "value"
        )
    path = scratch_path(spark, "records")
    whole.write.partitionBy("f").option("compression", "none").text(path)
    return path


CONVERSATION = "conv_id bigint, turn bigint, role string, text string"


@query("json_list_or_object", "SELECT conv_id, turn, role, text FROM conversations")
def json_list_or_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _conversation_files(spark, sf_dir, damage=False)
    schema = spark.createDataFrame([], CONVERSATION).schema
    records, _ = read_records(spark, path, path, schema, pattern="*.txt")
    return records.drop("rel_path")


@query("json_rejects", """
WITH f AS (SELECT DISTINCT conv_id // 200 AS run, conv_id % 200 = 0 AND turn = 0 AS single FROM conversations)
SELECT reason, count(*) AS n_files FROM f, (VALUES ('malformed_json'), ('malformed_json'), ('malformed_json'), ('invalid_shape')) AS r(reason) GROUP BY reason""")
def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _conversation_files(spark, sf_dir, damage=True)
    _, rejects = read_dynamic(spark, path, path, pattern="*.txt")
    return rejects.groupBy("reason").agg(F.count("*").alias("n_files"))


@query("load_incremental", f"""
SELECT load_id, conv_id || '-' || turn AS id_origem, {sql_clean('text')} AS ementa FROM (
  SELECT *, 1 + conv_id // 200 % 2 AS load_id FROM conversations WHERE turn % 5 <> 4)
UNION ALL
SELECT 1 + conv_id // 200 % 2, 'missing id_origem', count(*)::VARCHAR FROM conversations WHERE turn % 5 = 4 GROUP BY 1""")
def load_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of a growing folder: what each of them kept, and how many records each put aside."""
    root = scratch_path(spark, "incremental")
    run = F.floor(F.col("conv_id") / CONVERSATIONS_PER_FILE)
    name = F.when(F.col("turn") % 5 != 4, F.concat_ws("-", "conv_id", "turn"))
    record = F.struct(name.alias("ID_Registro"), F.col("text").alias("ementa"))
    files = read_table(spark, sf_dir, "conversations").groupBy(run.alias("run")).agg(
        F.to_json(F.collect_list(record), {"pretty": "true"}).alias("value")
    )
    for half in (0, 1):
        part = files.filter(F.col("run") % 2 == half).select(F.concat(F.lit("[r]"), "run").alias("f"), "value")
        part.write.mode("append").partitionBy("f").option("compression", "none").text(f"{root}/in")
        load_files(spark, f"{root}/in", f"{root}/s", f"{root}/q", f"{root}/m", pattern="*.txt")
    kept = spark.read.parquet(f"{root}/s").select(F.col("load_id").cast("bigint").alias("load_id"), "id_origem", "ementa")
    aside = spark.read.parquet(f"{root}/q").groupBy(F.col("load_id").cast("bigint").alias("load_id"), F.col("reason").alias("id_origem")).agg(
        F.count("*").cast("string").alias("ementa")
    )
    return kept.unionByName(aside)


@query("incremental_files", """
SELECT d.lang || '/' || d.source || '/' || CAST(d.doc_id AS VARCHAR) || '.json' AS rel_path, d.doc_id
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat_ws("/", "lang", "source", F.concat(F.col("doc_id").cast("string"), F.lit(".json")))
    docs = read_table(spark, sf_dir, "documents").select(path.alias("rel_path"), "doc_id")
    labelled = read_table(spark, sf_dir, "labels").select("doc_id")
    manifest = docs.join(labelled, "doc_id", "left_semi").select("rel_path")
    return pending(docs, manifest)


# --- scans -------------------------------------------------------------------------


@query("full_scan", f"SELECT * FROM {judged_sql(court=True, text=True)}")
def full_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_like(spark, sf_dir, court=True, text=True)


@query("ordered_projection", f"SELECT id_dw, ementa, decisao FROM {judged_sql(text=True)} ORDER BY id_dw")
def ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, texts, on = with_text_key(spark, sf_dir, judged_like(spark, sf_dir))
    return ordered_projection(rows, ["id_dw", "ementa", "decisao"], "id_dw", texts, on)


@query("preview_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100")
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(read_table(spark, sf_dir, "orders"), "o_orderkey", 100)


@query("schema_evolution", """
SELECT c_custkey, c_name AS "cNome", c_nationkey, c_mktsegment, CAST(NULL AS VARCHAR) AS numerodocumento FROM customer""")
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "customer")
    return add_nullable(drop_column(rename_column(df, "c_name", "cNome"), "c_acctbal"), "numerodocumento")


@query("inventory_stats", """
SELECT count(*) AS n_rows, count(DISTINCT lang || '/' || source) AS n_files, count(DISTINCT lang) + 1 AS n_folders
FROM documents""")
def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return inventory_stats(docs, F.col("lang"), F.concat_ws("/", "lang", "source"))


# --- keys of dynamic records ---------------------------------------------------------


def _event_json() -> Column:
    return F.concat(
        F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"'), F.col("event_type"),
        F.lit('_user":'), F.col("user_id").cast("string"), F.lit(',"props":'), F.col("props"), F.lit("}"),
    )


_SQL_EVENT_KEYS = """(SELECT unnest(json_keys('{"id":' || event_id || ',"' || event_type || '_user":' || user_id
  || ',"props":' || props || '}')) AS key FROM events)"""


@query("key_discovery", f"""
SELECT CASE WHEN key = 'id' THEN 'id_origem' ELSE key END AS key, count(*) AS n FROM {_SQL_EVENT_KEYS} GROUP BY 1""")
def discover_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_discovery(read_table(spark, sf_dir, "events"), F.json_object_keys(_event_json()))


@query("keyset_signatures", """
SELECT array_to_string(list_sort(json_keys('{"id":' || event_id || ',"' || event_type || '_user":' || user_id
  || ',"props":' || props || '}')), ',') AS signature, count(*) AS n FROM events GROUP BY 1""")
def signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyset_signatures(read_table(spark, sf_dir, "events"), F.json_object_keys(_event_json()))


_SIGNED_FILE = "CASE WHEN event_id % 2 = 0 THEN 'by-type/' || event_type ELSE 'mixed/' || (event_id // 1000) END"


@query("keyset_batches", f"""
WITH e AS (SELECT {_SIGNED_FILE} AS f, event_id AS pos, array_to_string(list_sort(json_keys('{{"id":' || event_id || ',"' || event_type
    || CASE WHEN event_id % 4001 = 0 THEN '_agent' ELSE '_user' END || '":' || user_id || ',"props":' || props || '}}')), ',') AS s FROM events),
  c AS (SELECT *, CASE WHEN s IS DISTINCT FROM lag(s) OVER (ORDER BY f, pos) THEN 1 ELSE 0 END AS changes FROM e),
  r AS (SELECT *, sum(changes) OVER (ORDER BY f, pos ROWS UNBOUNDED PRECEDING) AS run FROM c),
  k AS (SELECT *, (row_number() OVER (PARTITION BY run ORDER BY f, pos) - 1) // 1000 AS part FROM r),
  b AS (SELECT *, dense_rank() OVER (ORDER BY run, part) AS batch FROM k)
SELECT batch, count(*) AS rows, min(f) AS first_file, arg_min(pos, (f, pos)) AS first_pos, max(f) AS last_file, arg_max(pos, (f, pos)) AS last_pos
FROM b GROUP BY batch""")
def batches_of_key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second event in a file of its type, where runs are long, the others in files where types alternate."""
    event = F.col("event_id")
    file = F.when(event % 2 == 0, F.concat(F.lit("by-type/"), "event_type")).otherwise(
        F.concat(F.lit("mixed/"), F.floor(event / 1000).cast("string"))
    )
    who = F.when(event % 4001 == 0, F.lit('_agent":')).otherwise(F.lit('_user":'))
    record = F.concat(F.lit('{"id":'), event.cast("string"), F.lit(',"'), F.col("event_type"), who, F.col("user_id").cast("string"),
                      F.lit(',"props":'), F.col("props"), F.lit("}"))
    rows = read_table(spark, sf_dir, "events").select(
        file.alias("rel_path"), event.alias("pos"), key_signature(F.json_object_keys(record)).alias("signature")
    )
    return keyset_batches(rows, block=3_000)


# --- record treatment ----------------------------------------------------------------


@query("rename_key", """
SELECT coalesce(CASE WHEN o_orderkey % 13 <> 0 THEN 'R' || o_orderkey END,
                CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS VARCHAR) END) AS id_origem, o_orderkey
FROM orders""")
def rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    df = read_table(spark, sf_dir, "orders").select(
        F.when(key % 7 != 0, key.cast("string")).alias("Id"),
        "o_orderkey",
        F.when(key % 13 != 0, F.concat(F.lit("R"), key.cast("string"))).alias("ID_REGISTRO"),
    )
    return rename_key(df)


@query("required_field_split", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS id_origem,
       CASE WHEN o_orderkey % 7 = 0 THEN 'missing id_origem' END AS reject_reason FROM orders""")
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("id_origem")
    )
    kept, rejected = required_field_split(df)
    return kept.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejected)


@query("id_fallback_parse", """
SELECT o_orderkey, CASE WHEN regexp_full_match(trim(id), '[0-9]+') THEN TRY_CAST(trim(id) AS BIGINT)
  ELSE TRY_CAST(id_origem AS BIGINT) END AS id_julgado FROM (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'x' || o_orderkey
         WHEN o_orderkey % 13 = 0 THEN '99999999999' WHEN o_orderkey % 17 = 0 THEN '99999999999999999999' ELSE ' 000' || o_orderkey || ' ' END AS id,
    CASE WHEN o_orderkey % 5 = 0 THEN 'sem id' ELSE CAST(o_custkey AS VARCHAR) END AS id_origem
  FROM orders)""")
def id_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    text = key.cast("string")
    df = read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 7 == 0, F.lit(None))
        .when(key % 11 == 0, F.concat(F.lit("x"), text))
        .when(key % 13 == 0, F.lit("99999999999"))
        .when(key % 17 == 0, F.lit("9" * 20))
        .otherwise(F.concat(F.lit(" 000"), text, F.lit(" "))).alias("id"),
        F.when(key % 5 == 0, "sem id").otherwise(F.col("o_custkey").cast("string")).alias("id_origem"),
    )
    with_ids, without = id_fallback_parse(df)
    return with_ids.unionByName(without).select("o_orderkey", "id_julgado")


@query("pack_row_json", """
SELECT c_custkey, to_json({c_custkey: c_custkey, c_name: c_name, c_nationkey: c_nationkey,
  c_mktsegment: c_mktsegment, obs: CAST(NULL AS VARCHAR)})::VARCHAR AS teor FROM customer""")
def pack_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = add_nullable(read_table(spark, sf_dir, "customer").drop("c_acctbal"), "obs")
    return df.select("c_custkey", pack_row_json(df.columns).alias("teor"))


# --- text ----------------------------------------------------------------------------


def _shown(df: DataFrame, key: str, items: str) -> DataFrame:
    """An array as its size and joined text, which every engine prints alike."""
    return df.select(
        key, F.size(items).cast("bigint").alias("n"), F.array_join(items, "|").alias(items)
    )


def _noisy() -> Column:
    return F.concat(F.lit(" \x0c"), F.replace("text", F.lit(". "), F.lit(".\t\r\n ")), F.lit(" "))


_SQL_NOISY = "' ' || chr(12) || replace(text, '. ', '.' || chr(9) || chr(13) || chr(10) || ' ') || chr(160)"


@query("ws_normalize", f"SELECT doc_id, {sql_clean('noisy')} AS clean FROM (SELECT doc_id, {_SQL_NOISY} AS noisy FROM documents)")
def normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", ws_normalize(_noisy()).alias("clean"))


@query("ws_normalize_full", f"""
SELECT doc_id, {sql_clean_full('noisy')} AS clean,
  {sql_clean_full("array_to_string(list_filter([lang, CASE WHEN quality = 1 THEN text END, source], lambda x: x IS NOT NULL), ' ')")} AS joined
FROM (SELECT d.doc_id, {_SQL_NOISY} AS noisy, lang, source, text, quality FROM documents d
      LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id)""")
def normalize_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    docs = read_table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    parts = F.array("lang", F.when(F.col("quality") == 1, F.col("text")), "source")
    return docs.select(
        "doc_id", ws_normalize_full(_noisy()).alias("clean"), ws_normalize_joined(parts).alias("joined")
    )


@query("array_clean", f"""
SELECT doc_id, len(items) AS n, array_to_string(items, '|') AS items FROM (SELECT doc_id,
  list_transform(CASE WHEN lang = 'de' OR text IS NULL THEN []::VARCHAR[] ELSE string_split(text, chr(10)) END,
  lambda x: coalesce({sql_clean("x || chr(9)")}, '')) AS items FROM documents)""")
def array_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.when(
        F.col("lang") != "de",
        F.transform(F.split("text", "\n", -1), lambda x: F.concat(x, F.lit("\t"))),
    )
    cleaned = read_table(spark, sf_dir, "documents").select("doc_id", clean_array(lines).alias("items"))
    return _shown(cleaned, "doc_id", "items")


@query("truncate_columns", """
SELECT doc_id, substr(text, 1, 50) AS "numeroProcesso", substr(text, 1, 300) AS "dataPublicacao",
  substr(text, 1, 255) AS "siglaClasse", text AS ementa FROM documents""")
def truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    df = read_table(spark, sf_dir, "documents").select(
        "doc_id", text.alias("numeroProcesso"), text.alias("dataPublicacao"),
        text.alias("siglaClasse"), text.alias("ementa"),
    )
    return truncate_columns(df, load_limits(df.columns, widths="load"))


@query("split_terms", f"""
SELECT id_dw, len(termos) AS n, array_to_string(termos, '|') AS termos FROM (SELECT id_dw,
  list_filter(list_transform(string_split({sql_clean_full('termosAuxiliares')}, ';'), lambda x: trim(x)), lambda x: x <> '') AS termos
  FROM {judged_sql()})""")
def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = judged_like(spark, sf_dir).select("id_dw", split_terms(F.col("termosAuxiliares")).alias("termos"))
    return _shown(split, "id_dw", "termos")


@query("embed_text", """
SELECT doc_id, 'Ementa: ' || coalesce(text, '') || chr(10) || chr(10) || 'Decisão: '
  || coalesce(CASE WHEN lang = 'en' THEN source END, '') AS texto FROM documents""")
def template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    decisao = F.when(F.col("lang") == "en", F.col("source"))
    return read_table(spark, sf_dir, "documents").select(
        "doc_id", embed_text(F.col("text"), decisao).alias("texto")
    )


@query("min_text_filter", f"""
SELECT doc_id, length({sql_strip('texto')}) AS n_chars FROM (
  SELECT doc_id, 'Ementa: ' || text || chr(10) || chr(10) || 'Decisão: ' AS texto FROM documents)
WHERE length({sql_strip('texto')}) >= 50""")
def min_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = read_table(spark, sf_dir, "documents").select(
        "doc_id", embed_text(F.col("text"), F.lit("")).alias("texto")
    )
    return texts.filter(long_enough(F.col("texto"))).select(
        "doc_id", F.char_length(strip(F.col("texto"))).cast("bigint").alias("n_chars")
    )


# --- dates and numbers ---------------------------------------------------------------


def _sql_iso(e: str) -> str:
    tok = (
        f"(CASE WHEN regexp_matches({e}, '(?i)DATA:') THEN regexp_extract({e}, '(?i)DATA:\\s*(\\S*)', 1) "
        f"ELSE {sql_strip(e)} END)"
    )
    tries = ", ".join(
        f"strftime(CASE WHEN regexp_full_match({tok}, '{shape}') THEN try_strptime({tok}, '{fmt}') END, '%Y-%m-%d')"
        for shape, fmt in (
            ("[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", "%d/%m/%Y"),
            ("[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}", "%d-%m-%Y"),
            ("[0-9]{8}", "%Y%m%d"),
            ("[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", "%Y-%m-%d"),
            ("[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}", "%Y/%m/%d"),
        )
    )
    return f"coalesce({tries}, {sql_strip(e)})"


@query("date_multi_format", f"""
SELECT id_dw, {_sql_iso('"dataDecisao"')} AS d_decisao, {_sql_iso('"dataPublicacao"')} AS d_publicacao FROM {judged_sql()}""")
def dates_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_like(spark, sf_dir).select(
        "id_dw",
        date_multi_format(F.col("dataDecisao")).alias("d_decisao"),
        date_multi_format(F.col("dataPublicacao")).alias("d_publicacao"),
    )


@query("date_typed", f"""
SELECT id_dw, {sql_typed_date('"dataDecisao"')}::VARCHAR AS dt_decisao, {sql_typed_date('"dataPublicacao"')}::VARCHAR AS dt_publicacao
FROM {judged_sql()}""")
def dates_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_like(spark, sf_dir).select(
        "id_dw",
        date_typed(F.col("dataDecisao")).cast("string").alias("dt_decisao"),
        date_typed(F.col("dataPublicacao")).cast("string").alias("dt_publicacao"),
    )


def _number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, form, v``: order values in the spellings that readers meet."""
    key = F.col("o_orderkey").cast("string")
    price = F.col("o_totalprice").cast("string")
    forms = {
        "key": key,
        "spaced": F.concat(F.lit(" "), price, F.lit("\t")),
        "scientific": F.concat(key, F.lit("e2")),
        "negative": F.concat(F.lit("-"), price),
        "suffixed": F.concat(key, F.lit("d")),
        "status": F.col("o_orderstatus"),
        "iso": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "stamp": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        "dmy": F.date_format("o_orderdate", "dd/MM/yyyy"),
        "compact": F.date_format("o_orderdate", "yyyyMMdd"),
        "special": F.when(F.col("o_orderstatus") == "F", "nan").when(F.col("o_orderstatus") == "O", "inf"),
        "empty": F.lit(""),
    }
    return (
        spread(read_table(spark, sf_dir, "orders"))
        .select("o_orderkey", *[c.alias(n) for n, c in forms.items()])
        .unpivot("o_orderkey", list(forms), "form", "v")
    )


_SQL_NUMBER_TEXTS = """(SELECT o_orderkey, unnest([
  {form: 'key', v: o_orderkey::VARCHAR}, {form: 'spaced', v: ' ' || o_totalprice::VARCHAR || chr(9)},
  {form: 'scientific', v: o_orderkey::VARCHAR || 'e2'}, {form: 'negative', v: '-' || o_totalprice::VARCHAR},
  {form: 'suffixed', v: o_orderkey::VARCHAR || 'd'}, {form: 'status', v: o_orderstatus},
  {form: 'iso', v: strftime(o_orderdate, '%Y-%m-%d')}, {form: 'stamp', v: strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')},
  {form: 'dmy', v: strftime(o_orderdate, '%d/%m/%Y')}, {form: 'compact', v: strftime(o_orderdate, '%Y%m%d')},
  {form: 'special', v: CASE o_orderstatus WHEN 'F' THEN 'nan' WHEN 'O' THEN 'inf' END}, {form: 'empty', v: ''}],
  recursive := true) FROM orders)"""
_SQL_NUMBER = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"


@query("int_lenient", f"""
SELECT o_orderkey, form, CASE WHEN regexp_full_match({sql_strip('v')}, '{_SQL_NUMBER}')
  THEN TRY_CAST(trunc(TRY_CAST({sql_strip('v')} AS DOUBLE)) AS BIGINT) END AS n FROM {_SQL_NUMBER_TEXTS}""")
def lenient_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _number_texts(spark, sf_dir).select("o_orderkey", "form", int_lenient(F.col("v")).alias("n"))


@query("value_kind", f"""
SELECT form, kind, count(*) AS n FROM (SELECT form, CASE WHEN v IS NULL THEN NULL
    WHEN regexp_full_match(s, '{_SQL_NUMBER}') AND NOT contains(s, '.') THEN 'int'
    WHEN regexp_full_match(s, '{_SQL_NUMBER}') THEN 'float'
    WHEN try_strptime(s, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%d/%m/%Y']) IS NOT NULL THEN 'date'
    ELSE 'string' END AS kind
  FROM (SELECT form, v, {sql_strip('v')} AS s FROM {_SQL_NUMBER_TEXTS})) GROUP BY form, kind""")
def kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = _number_texts(spark, sf_dir).select("form", value_kind(F.col("v")).alias("kind"))
    return values.groupBy("form", "kind").agg(F.count("*").alias("n"))
