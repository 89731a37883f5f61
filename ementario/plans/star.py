"""Queries: fact, dimensions, upserts, constraint checks, profiles and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ementario.functions.legal import outcome, reference_items
from ementario.operators.guard import Rules, guarded_load
from ementario.operators.keys import dense_keys
from ementario.operators.profile import profile_simple, profile_typed, store_profile, stored_profile, to_long, with_declared
from ementario.operators.quality import (
    fk_violations,
    not_null_violations,
    unique_violations,
    vector_dim_check,
    width_violations,
)
from ementario.operators.reports import count_where, group_count, row_counts
from ementario.operators.sizing import suggest_ddl
from ementario.operators.star import (
    explode_subjects,
    fact_projection,
    legal_refs,
    load_star,
    star_join_report,
    with_id,
)
from ementario.operators import star as star_load
from ementario.operators.upsert import FIRST, LAST, collapse, dim_upsert, upsert
from ementario.plans.bindings import (
    TABLES,
    judged_like,
    judged_sql,
    sql_clean,
    sql_clean_full,
    sql_outcome,
    sql_refs,
    sql_subjects,
    sql_typed_date,
)
from ementario.plans.registry import query
from ementario.schemas import DIM_SUBJECTS_KEY, LONG_FIELDS, STAGING_WIDTHS
from ementario.session import scratch_path
from ementario.sources.tables import read_table, spread
from ementario.streaming.star import start_star

# --- fact and dimensions ---------------------------------------------------------------


@query("fact_projection", f"""
SELECT TRY_CAST(id_origem AS BIGINT) AS id_julgado, id_dw, CAST(TRY_CAST(id_origem AS BIGINT) AS VARCHAR) AS id_origem_natural,
  {sql_typed_date('"dataDecisao"')}::VARCHAR AS dt_decisao, {sql_typed_date('"dataPublicacao"')}::VARCHAR AS dt_publicacao,
  {sql_clean_full('siglaClasse')} AS classe_sigla, {sql_clean_full('nomeOrgaoJulgador')} AS orgao_julgador,
  {sql_clean_full('ministroRelator')} AS ministro_relator, {sql_outcome('decisao', 'ementa')} AS resultado_binario,
  {sql_clean_full('tema')} AS tema_repetitivo, {sql_clean_full('ementa')} AS ementa_limpa,
  {sql_clean_full('decisao')} AS decsiao_teor_limpo, {sql_clean_full('teseJuridica')} AS tese_juridica_limpa,
  {sql_clean_full('acordaosSimilares')} AS acordaos_similares_limpo,
  {sql_clean_full('jurisprudenciaCitada')} AS jurisprudencia_citada_limpa
FROM {judged_sql(court=True, text=True)} WHERE TRY_CAST(id_origem AS BIGINT) IS NOT NULL""")
def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = fact_projection(judged_like(spark, sf_dir, court=True, text=True)).drop("teor_bruto_json")
    # Dates as ISO text, which every engine prints alike.
    return facts.withColumns({c: F.col(c).cast("string") for c in ("dt_decisao", "dt_publicacao")})


@query("outcome_classify", f"""
SELECT 'judged' AS src, id_dw AS id, {sql_outcome('decisao', 'ementa')} AS outcome FROM {judged_sql(text=True)}
UNION ALL
SELECT 'documents', doc_id, CASE WHEN regexp_matches(upper({sql_clean_full('source')} || ' ' || {sql_clean_full('text')}), 'THE .*AND|DIE') THEN TRUE
  WHEN regexp_matches(upper({sql_clean_full('source')} || ' ' || {sql_clean_full('text')}), 'LE |LA ') THEN FALSE END FROM documents""")
def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judged_like(spark, sf_dir, text=True).select(
        F.lit("judged").alias("src"), F.col("id_dw").alias("id"),
        outcome(F.col("decisao"), F.col("ementa")).alias("outcome"),
    )
    docs = read_table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("src"), F.col("doc_id").alias("id"),
        outcome(F.col("source"), F.col("text"), ("THE .*AND", "DIE"), ("LE ", "LA ")).alias("outcome"),
    )
    return judged.unionByName(docs)


def _refs(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    rows = with_id(judged_like(spark, sf_dir))
    return legal_refs(rows, "id_julgado", reference_items(F.col("referenciasLegislativas")), mode)


@query("legal_refs", f"""
SELECT 'intended' AS mode, * FROM {sql_refs(judged_sql(), 'intended')}
UNION ALL SELECT 'as_written', * FROM {sql_refs(judged_sql(), 'as_written')}""")
def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [_refs(spark, sf_dir, m).withColumn("mode", F.lit(m)) for m in ("intended", "as_written")],
    )


@query("explode_subjects", f"SELECT * FROM {sql_subjects(judged_sql())}")
def subject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_subjects(with_id(judged_like(spark, sf_dir)), "id_julgado")


@query("surrogate_keys", f"""
SELECT id_julgado_fk, tipo_assunto, termo, row_number() OVER (ORDER BY substr(md5(nk), 1, 3), id_julgado_fk, tipo_assunto, termo) AS id_assunto FROM (
  SELECT *, id_julgado_fk || chr(31) || tipo_assunto || chr(31) || termo AS nk
  FROM (SELECT DISTINCT * FROM {sql_subjects(judged_sql())}))""")
def surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_subjects(with_id(judged_like(spark, sf_dir)), "id_julgado").distinct()
    return dense_keys(rows, DIM_SUBJECTS_KEY, "id_assunto")


@query("star_join_report", f"""
SELECT tipo_norma, outcome AS resultado_binario, count(*) AS n
FROM (SELECT TRY_CAST(id_origem AS BIGINT) AS id, {sql_outcome('decisao', 'ementa')} AS outcome FROM {judged_sql(text=True)}) f
JOIN {sql_refs(judged_sql(), 'intended')} r ON f.id = r.id_julgado_fk GROUP BY 1, 2""")
def star_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = fact_projection(judged_like(spark, sf_dir, text=True))
    report = star_join_report(facts, _refs(spark, sf_dir, "intended"))
    return report.withColumn("n", F.col("n").cast("bigint"))


# --- upserts -----------------------------------------------------------------------

EVENT_POLICY = {"props": FIRST, "event_type": LAST, "value": LAST}


@query("upsert_first_last", """
SELECT user_id, arg_min(props, (ts, event_id)) AS props, arg_max(event_type, (ts, event_id)) AS event_type,
  arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id""")
def upsert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events up to the middle of their time span are the target, the rest the batch."""
    events = read_table(spark, sf_dir, "events")
    seconds = events.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    middle = seconds.agg((F.min("us") + (F.max("us") - F.min("us")) / 2)).scalar()
    when = F.unix_micros(F.col("ts").cast("timestamp"))
    order = ["ts", "event_id"]
    target = collapse(events.filter(when <= middle), ["user_id"], EVENT_POLICY, order)
    return upsert(target, events.filter(when > middle), ["user_id"], EVENT_POLICY, order)


@query("dim_upsert", f"SELECT DISTINCT * FROM {sql_subjects(judged_sql())}")
def upsert_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of one outcome first, then a second load with all of them."""
    rows = with_id(judged_like(spark, sf_dir))
    every = explode_subjects(rows, "id_julgado")
    earlier = explode_subjects(rows.filter(F.contains("decisao", F.lit("PROVIMENTO"))), "id_julgado")
    return dim_upsert(earlier.distinct(), every, DIM_SUBJECTS_KEY)


# --- constraints ---------------------------------------------------------------------


@query("unique_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def uniques(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_violations(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("fk_violations", """
SELECT 'labels' AS child, doc_id AS fk FROM labels WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = labels.doc_id)
UNION ALL
SELECT 'damaged', fk FROM (SELECT CASE WHEN quality = 0 THEN -1 - doc_id ELSE doc_id END AS fk FROM labels)
WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = fk)""")
def fks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    labels = read_table(spark, sf_dir, "labels")
    damaged = F.when(F.col("quality") == 0, -1 - F.col("doc_id")).otherwise(F.col("doc_id"))
    good = labels.select(F.lit("labels").alias("child"), F.col("doc_id").alias("fk"))
    bad = labels.select(F.lit("damaged").alias("child"), damaged.alias("fk"))
    return fk_violations(good.unionByName(bad), "fk", docs, "doc_id")


_NULLABLE = ["id_origem", "dataPublicacao", "tema", "teseJuridica", "referenciasLegislativas", "Obs"]


@query("not_null_violations", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n FROM {judged_sql()}" for c in _NULLABLE))
def not_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return not_null_violations(judged_like(spark, sf_dir), _NULLABLE)


@query("width_violations", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {w} AS \"limit\", max(length({c})) AS max_len, "
    f"count(*) FILTER (length({c}) > {w}) AS n_over FROM {{j}}" for c, w in {**STAGING_WIDTHS, "ementa": 2000}.items()
).replace("{j}", judged_sql(court=True, text=True)))
def widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judged_like(spark, sf_dir, court=True, text=True)
    return width_violations(judged, {**STAGING_WIDTHS, "ementa": 2000})


@query("vector_dim_check", """
SELECT vec_id, len(v) AS n FROM (
  SELECT vec_id, CASE WHEN vec_id % 50 = 0 THEN embedding[1:63] ELSE embedding END AS v FROM embeddings)
WHERE len(v) <> 64""")
def vector_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = F.when(F.col("vec_id") % 50 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    damaged = read_table(spark, sf_dir, "embeddings").select("vec_id", emb.alias("embedding"))
    return vector_dim_check(damaged, "embedding", 64).select(
        "vec_id", F.size("embedding").cast("bigint").alias("n")
    )


_GUARDED = "(SELECT *, o_orderkey % 6 AS l FROM orders)"


@query("guarded_load", f"""
SELECT l::VARCHAR AS load, 'published' AS rule, count(*) AS n FROM {_GUARDED} WHERE l IN (0, 5) GROUP BY l
UNION ALL SELECT '1', 'not null o_orderstatus', count(*) FROM {_GUARDED} WHERE l = 1 AND o_orderkey % 5 = 0
UNION ALL SELECT '2', 'width o_orderpriority', count(*) FROM {_GUARDED} WHERE l = 2
UNION ALL SELECT '3', 'unique o_orderkey', count(*) + (SELECT count(*) FROM {_GUARDED} WHERE l = 0) FROM {_GUARDED} WHERE l = 3
UNION ALL SELECT '4', 'foreign o_custkey', count(*) FROM {_GUARDED} WHERE l = 4
""")
def guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six loads of orders, four of which break a rule: what is published, and what kept the others out."""
    root, name = scratch_path(spark, "guarded"), "q3_pedidos"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    load = F.col("o_orderkey") % 6
    customers = read_table(spark, sf_dir, "customer").select("c_custkey")
    rules = Rules(not_null=["o_orderkey", "o_orderstatus"], widths={"o_orderpriority": 15}, unique=[["o_orderkey"]], foreign={"o_custkey": customers})
    damage = {
        1: {"o_orderstatus": F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus"))},
        2: {"o_orderpriority": F.rpad("o_orderpriority", 16, "!")},
        4: {"o_custkey": -1 - F.col("o_custkey")},
    }
    for k in (0, 1, 2, 3, 4, 5, 5):
        rows = orders.filter(load == k).withColumns(damage.get(k, {}))
        if k == 3:  # its own rows twice, and those of load 0 again
            rows = rows.union(rows).union(orders.filter(load == 0))
        guarded_load(spark, rows, name, root, str(k), rules)
    published = spark.table(name).groupBy(F.substring("load", 6, 9).alias("load")).agg(F.lit("published").alias("rule"), F.count("*").alias("n"))
    return published.union(spark.read.parquet(f"{root}/{name}_violacoes").select("load", "rule", "n"))


# --- profiles ------------------------------------------------------------------------

_JUDGED_COLUMNS = [c for c in STAGING_WIDTHS] + list(LONG_FIELDS)
_SQL_NUMBER = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"


def _sql_long(columns: list[str], source: str, seq: str = "id_dw") -> str:
    return "(" + " UNION ALL ".join(
        f"SELECT {seq} AS seq, '{c}' AS \"column\", {sql_clean(c)} AS v FROM src WHERE {c} IS NOT NULL" for c in columns
    ) + ")"


def _sql_is_long() -> str:
    return "\"column\" IN (" + ", ".join(f"'{c}'" for c in LONG_FIELDS) + ")"


def _sql_simple(source: str, columns: list[str], first_seen: bool) -> str:
    kind = (
        "CASE WHEN bool_or(" + _sql_is_long() + ") THEN 'string' "
        + ("ELSE arg_min(k, seq) END" if first_seen else "WHEN bool_or(k = 'string') THEN 'string' ELSE 'int' END")
    )
    length = "max(CASE WHEN k = 'string' THEN length(v) END)" if first_seen else "max(length(v))"
    return f"""WITH src AS MATERIALIZED (SELECT * FROM {source}),
  vals AS (SELECT *, CASE WHEN n IS NULL THEN 'string' ELSE 'int' END AS k FROM (
    SELECT *, CASE WHEN (contains(lower("column"), 'numero') OR contains(lower("column"), 'id'))
        AND regexp_full_match(v, '{_SQL_NUMBER}') THEN TRY_CAST(trunc(TRY_CAST(v AS DOUBLE)) AS BIGINT) END AS n
    FROM {_sql_long(columns, source)})),
  agg AS (SELECT "column", {kind} AS type, {length} AS len, max(abs(n)) AS num FROM vals GROUP BY "column")
SELECT "column", type, CASE WHEN type = 'string' THEN coalesce(len, 0) END AS max_len,
  CASE WHEN type = 'int' THEN num END AS max_val FROM agg"""


def _judged_long(spark: SparkSession, sf_dir: str, seq: str | None = None) -> DataFrame:
    judged = judged_like(spark, sf_dir, court=True, text=True)
    return to_long(judged, _JUDGED_COLUMNS, seq)


def _sql_declared(rest: str) -> str:
    names = ", ".join(f"'{c}'" for c in LONG_FIELDS)
    return f""" UNION ALL SELECT c, 'string', 0, {rest} FROM (SELECT unnest([{names}]) AS c) WHERE c NOT IN (SELECT "column" FROM agg)"""


@query("profile_columns", _sql_simple(judged_sql(court=True, text=True), _JUDGED_COLUMNS, False) + _sql_declared("NULL"))
def profile_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_declared(profile_simple(_judged_long(spark, sf_dir)), LONG_FIELDS)


_MIXED = ["numeroMisto", "idMisto", "numeroNulo", "texto"]


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose kind changes along the order of ``o_orderkey``."""
    key = F.col("o_orderkey")
    text = key.cast("string")
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 3 == 0, text).otherwise(F.concat(F.lit("N"), text)).alias("numeroMisto"),
        F.when(key % 3 == 0, F.col("o_orderpriority")).otherwise(text).alias("idMisto"),
        F.when(key % 2 == 1, F.concat(F.lit("-"), text, F.lit(".5"))).alias("numeroNulo"),
        F.col("o_orderstatus").alias("texto"),
    )


_SQL_MIXED = """(SELECT o_orderkey AS id_dw,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey::VARCHAR ELSE 'N' || o_orderkey END AS "numeroMisto",
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE o_orderkey::VARCHAR END AS "idMisto",
  CASE WHEN o_orderkey % 2 = 1 THEN '-' || o_orderkey || '.5' END AS "numeroNulo",
  o_orderstatus AS texto FROM orders)"""


@query("profile_first_seen", _sql_simple(_SQL_MIXED, _MIXED, True))
def profile_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_simple(to_long(_mixed(spark, sf_dir), _MIXED, "o_orderkey"), mode="first_seen")


def _sql_typed(source: str, columns: list[str], first_seen: bool) -> str:
    places = "greatest(length(regexp_extract(abs(x)::VARCHAR, '\\.([0-9]+)', 1)), 1)"
    ints = "k = 'int' AND (fs IS NULL OR seq < fs)" if first_seen else "k = 'int'"
    base = "len" if not first_seen else "CASE WHEN " + _sql_is_long() + " THEN 0 ELSE len END"
    kind = (
        "WHEN first_kind = 'string' THEN 'string' WHEN any_float THEN 'float' ELSE 'int' END"
        if first_seen
        else "WHEN any_string THEN 'string' WHEN any_float THEN 'float' ELSE 'int' END"
    )
    length = "max(CASE WHEN k = 'string' THEN length(v) END)" if first_seen else "max(length(v))"
    return f"""WITH src AS MATERIALIZED (SELECT * FROM {source}),
  vals AS MATERIALIZED (SELECT *, CASE WHEN x IS NOT NULL AND NOT contains(v, '.') THEN 'int' WHEN x IS NOT NULL THEN 'float'
      WHEN try_strptime(v, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%d/%m/%Y']) IS NOT NULL THEN 'date' ELSE 'string' END AS k
    FROM (SELECT *, CASE WHEN regexp_full_match(v, '{_SQL_NUMBER}') THEN TRY_CAST(v AS DOUBLE) END AS x
          FROM {_sql_long(columns, source)})),
  vals2 AS (SELECT *, min(CASE WHEN k = 'float' THEN seq END) OVER (PARTITION BY "column") AS fs FROM vals),
  agg AS (SELECT "column", bool_or(k = 'date') AS any_date, bool_or(k = 'string') AS any_string,
      bool_or(k = 'float') AS any_float, arg_min(k, seq) AS first_kind, {length} AS len,
      max(CASE WHEN {ints} OR k = 'float' THEN abs(x) END) AS val, max(CASE WHEN k = 'float' THEN {places} END) AS places
    FROM vals2 GROUP BY "column"),
  typed AS (SELECT *, CASE WHEN {_sql_is_long()} THEN 'string' WHEN any_date THEN 'date' {kind} AS type FROM agg)
SELECT "column", type, CASE WHEN type = 'string' THEN coalesce({base}, 0) END AS max_len,
  CASE WHEN type IN ('int', 'float') THEN val END AS max_val,
  CASE WHEN type = 'float' THEN coalesce(places, 0) END AS precision FROM typed"""


@query("profile_typed", _sql_typed(judged_sql(court=True, text=True), _JUDGED_COLUMNS, False) + _sql_declared("NULL, NULL"))
def profile_judged_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_declared(profile_typed(_judged_long(spark, sf_dir)), LONG_FIELDS)


@query("profile_merged", _sql_typed(judged_sql(court=True), _JUDGED_COLUMNS, False).replace("precision FROM typed", "precision, n FROM typed").replace(
    "bool_or(k = 'date') AS any_date", "count(*) AS n, bool_or(k = 'date') AS any_date"))
def profile_of_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads, each profiled once when it came in, and the second repeated: the profile of all from their states."""
    root = scratch_path(spark, "profile-states")
    judged = judged_like(spark, sf_dir, court=True)
    for load in (0, 1, 2, 1):
        store_profile(to_long(judged.filter(F.col("id_dw") % 3 == load), _JUDGED_COLUMNS), root, load)
    return stored_profile(spark, root).drop("n_distinct")


@query("profile_typed_first_seen", _sql_typed(_SQL_MIXED, _MIXED, True))
def profile_mixed_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_typed(to_long(_mixed(spark, sf_dir), _MIXED, "o_orderkey"), mode="first_seen")


_ATOMIC = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


def _sql_table_long() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", {sql_clean(f'CAST({c} AS VARCHAR)')} AS v, typeof({c}) AS typ FROM {t} WHERE {c} IS NOT NULL"
        for t, cols in _ATOMIC.items()
        for c in cols.split()
    )


def _all_tables_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        to_long(spread(read_table(spark, sf_dir, t))).withColumn("table", F.lit(t)) for t in TABLES
    ]
    return reduce(DataFrame.unionByName, parts)


_SQL_VARCHAR = """CASE WHEN len > 255 THEN 'TEXT' WHEN len = 0 THEN 'VARCHAR(50)'
    WHEN len * 1.25 < 100 THEN 'VARCHAR(' || greatest(ceil(len * 1.25 / 10)::INT * 10, 50) || ')'
    ELSE 'VARCHAR(' || ceil(len * 1.25 / 50)::INT * 50 || ')' END"""
_SQL_INT = "CASE WHEN num <= 32767 THEN 'SMALLINT' WHEN num <= 2147483647 THEN 'INTEGER' ELSE 'BIGINT' END"


@query("suggest_ddl", f"""
WITH vals AS (SELECT *, CASE WHEN (contains("column", 'id') OR contains("column", 'numero'))
    AND regexp_full_match(v, '{_SQL_NUMBER}') THEN TRY_CAST(trunc(TRY_CAST(v AS DOUBLE)) AS BIGINT) END AS n FROM ({_sql_table_long()})),
  agg AS (SELECT "table", "column", bool_or(n IS NULL) AS is_text, max(length(v)) AS len, max(abs(n)) AS num FROM vals GROUP BY ALL)
SELECT "table", "column", CASE WHEN is_text THEN {_SQL_VARCHAR} ELSE {_SQL_INT} END AS ddl FROM agg""")
def ddl_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suggest_ddl(profile_simple(_all_tables_long(spark, sf_dir), by=("table",)), keep=("table",))


@query("suggest_ddl_typed", f"""
WITH vals AS (SELECT *, CASE WHEN typ = 'TIMESTAMP' THEN 'date' WHEN typ = 'DOUBLE' AND x = trunc(x) THEN 'int'
      WHEN x IS NOT NULL AND NOT contains(v, '.') THEN 'int' WHEN x IS NOT NULL THEN 'float'
      WHEN try_strptime(v, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%d/%m/%Y']) IS NOT NULL THEN 'date' ELSE 'string' END AS k
    FROM (SELECT *, CASE WHEN regexp_full_match(v, '{_SQL_NUMBER}') THEN TRY_CAST(v AS DOUBLE) END AS x FROM ({_sql_table_long()}))),
  agg AS (SELECT "table", "column", bool_or(k = 'date') AS d, bool_or(k = 'string') AS s, bool_or(k = 'float') AS f,
    max(length(v)) AS len, max(abs(x)) AS num,
    max(CASE WHEN k = 'float' THEN length(regexp_extract(x::VARCHAR, '\\.([0-9]+)', 1)) END) AS places FROM vals GROUP BY ALL),
  digits AS (SELECT *, length(trunc(num)::BIGINT::VARCHAR) + places AS dg FROM agg)
SELECT "table", "column", CASE WHEN d THEN 'DATE ou TIMESTAMP' WHEN s THEN {_SQL_VARCHAR}
  WHEN f THEN CASE WHEN dg > 15 OR places > 4 THEN 'NUMERIC(' || (dg + 2) || ', ' || places || ')' ELSE 'FLOAT8' END
  ELSE {_SQL_INT} END AS ddl FROM digits""")
def ddl_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suggest_ddl(profile_typed(_all_tables_long(spark, sf_dir), by=("table",)), keep=("table",))


# --- reports ---------------------------------------------------------------------------


@query("row_counts", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n FROM {t}" for t in TABLES))
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts({t: read_table(spark, sf_dir, t) for t in TABLES})


@query("group_count_one", f"""
SELECT "nomeOrgaoJulgador", count(*) AS n FROM {judged_sql(court=True)} GROUP BY 1 ORDER BY n DESC, 1""")
def by_court(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_count(judged_like(spark, sf_dir, court=True), "nomeOrgaoJulgador")


@query("group_count_two", f"""
SELECT "nomeOrgaoJulgador", "ministroRelator", count(*) AS n FROM {judged_sql(court=True)} GROUP BY 1, 2""")
def by_court_and_judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_count(judged_like(spark, sf_dir, court=True), "nomeOrgaoJulgador", "ministroRelator")


def _flag(c: Column) -> Column:
    return c == F.lit(1)


@query("count_where", """
SELECT 'quality' AS flag, count(*) AS n FROM labels WHERE quality = 1
UNION ALL SELECT 'toxic', count(*) FROM labels WHERE toxic = 1""")
def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    return count_where(labels, _flag(F.col("quality"))).select(F.lit("quality").alias("flag"), "n").unionByName(
        count_where(labels, _flag(F.col("toxic"))).select(F.lit("toxic").alias("flag"), "n")
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions per court and judge with their favourable share, and citations made."""
    judged = judged_like(spark, sf_dir, court=True, text=True)
    facts = fact_projection(judged).select(
        "id_julgado", "orgao_julgador", "ministro_relator", "resultado_binario"
    )
    cited = _refs(spark, sf_dir, "intended").groupBy("id_julgado_fk").agg(F.count("*").alias("refs"))
    return (
        facts.join(cited, F.col("id_julgado") == F.col("id_julgado_fk"), "left")
        .groupBy("orgao_julgador", "ministro_relator")
        .agg(
            F.count("*").alias("n"),
            F.count_if("resultado_binario").alias("n_fav"),
            F.coalesce(F.sum("refs"), F.lit(0)).alias("n_refs"),
        )
        .orderBy("orgao_julgador", "ministro_relator")
    )


# --- the load itself -----------------------------------------------------------------------

_LOADS = {"1": "id_dw % 3 <> 0", "2": "id_dw % 3 <> 1"}


def _loaded(spark: SparkSession, sf_dir: str, prefix: str) -> str:
    """Two overlapping loads, the second with other texts, and a repetition of the first."""
    root = scratch_path(spark, "star")
    rows = judged_like(spark, sf_dir)
    for name in ("fato_julgados_stj", "dim_referencias_legais", "dim_assuntos_stj"):
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")
    for load in ("1", "2", "1"):
        changed = F.concat("decisao", F.lit(f" CARGA {load}"))
        odd_id = F.when(F.col("id_dw") % 10 == 0, F.concat(F.lit("sem id "), "id_origem")).otherwise(F.col("id_origem"))
        part = rows.filter(_LOADS[load]).withColumns({"decisao": changed, "id_origem": odd_id})
        load_star(spark, part, root, load, prefix=prefix)
    return root


_SQL_LOADED = f"(SELECT * FROM {judged_sql()} WHERE id_dw % 10 <> 0)"


@query("load_star_fact", f"""
SELECT TRY_CAST(id_origem AS BIGINT) AS id_julgado, {sql_clean_full('decisao')} || CASE WHEN {_LOADS['2']} THEN ' CARGA 2' ELSE ' CARGA 1' END AS decisao,
  decisao || CASE WHEN {_LOADS['1']} THEN ' CARGA 1' ELSE ' CARGA 2' END AS primeira, tema_repetitivo, 0 AS rejeitados
FROM (SELECT *, {sql_clean_full('tema')} AS tema_repetitivo FROM {_SQL_LOADED})
UNION ALL SELECT NULL, NULL, NULL, NULL, count(*) FILTER ({_LOADS['1']}) + count(*) FILTER ({_LOADS['2']})
FROM {judged_sql()} WHERE id_dw % 10 = 0""")
def load_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last writes, the first raw record, and how many records had no usable id."""
    root = _loaded(spark, sf_dir, "q1_")
    none = F.lit(None).cast("string")
    rejected = spark.read.parquet(f"{root}/q1_rejeitados").agg(F.count("*").alias("rejeitados"))
    rows = spark.table("q1_fato_julgados_stj").select(
        "id_julgado", F.col("decsiao_teor_limpo").alias("decisao"),
        F.get_json_object("teor_bruto_json", "$.decisao").alias("primeira"), "tema_repetitivo",
        F.lit(0).cast("bigint").alias("rejeitados"),
    )
    return rows.unionByName(rejected.select(
        F.lit(None).cast("bigint").alias("id_julgado"), none.alias("decisao"), none.alias("primeira"),
        none.alias("tema_repetitivo"), "rejeitados",
    ))


@query("load_star_dims", f"""
SELECT 'refs' AS dim, count(*) AS n, 1 AS low, count(*) AS high, count(*) AS n_keys FROM (SELECT DISTINCT * FROM {sql_refs(_SQL_LOADED, 'intended')})
UNION ALL SELECT 'subjects', count(*), 1, count(*), count(*) FROM (SELECT DISTINCT * FROM {sql_subjects(_SQL_LOADED)})""")
def load_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural keys are held once, and their numbers run from 1 without a gap."""
    _loaded(spark, sf_dir, "q2_")
    parts = [
        spark.table(f"q2_{name}").agg(
            F.lit(label).alias("dim"), F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"),
            F.countDistinct(key).alias("n_keys"),
        )
        for label, name, key in (("refs", "dim_referencias_legais", "id_ref_legal"), ("subjects", "dim_assuntos_stj", "id_assunto"))
    ]
    return parts[0].unionByName(parts[1])


@query("stream_star", f"""
SELECT 'fact' AS part, count(*) AS n, count(*) AS n_keys, sum(CAST(id_origem AS BIGINT))::BIGINT AS total FROM {_SQL_LOADED}
UNION ALL SELECT 'refs', count(*), count(*), sum(id_julgado_fk)::BIGINT FROM (SELECT DISTINCT * FROM {sql_refs(_SQL_LOADED, 'intended')})
UNION ALL SELECT 'subjects', count(*), count(*), sum(id_julgado_fk)::BIGINT FROM (SELECT DISTINCT * FROM {sql_subjects(_SQL_LOADED)})""")
def stream_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three micro-batches, the second of which dies once between the fact and its dimensions and is repeated."""
    root, prefix = scratch_path(spark, "stream-star"), "q4_"
    names = {"fato_julgados_stj": "id_julgado", "dim_referencias_legais": "id_ref_legal", "dim_assuntos_stj": "id_assunto"}
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")
    rows = judged_like(spark, sf_dir).filter("id_dw % 10 <> 0")
    files = rows.rdd.getNumPartitions()  # a part arrives as that many files at most, each written by a task of its own
    for part in range(3):
        rows.filter(F.col("id_dw") % 3 == part).write.mode("append").parquet(f"{root}/arrived")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/arrived")
    died: list[str] = []

    def dying(session: SparkSession, batch: DataFrame, into: str, number: str) -> None:
        written = star_load.load_fact(session, batch, into, number, prefix)
        if number == "s1" and not died:
            died.append(number)
            raise RuntimeError("between two tables")
        star_load.load_dimensions(session, written, into, number, prefix=prefix)

    try:
        start_star(stream, root, f"{root}/checkpoint", prefix, dying).awaitTermination()
    except StreamingQueryException:
        if not died:  # whatever else ends a stream, now or when it is started anew, is no result
            raise
        start_star(stream, root, f"{root}/checkpoint", prefix, dying).awaitTermination()
    parts = []
    for (name, key), label in zip(names.items(), ("fact", "refs", "subjects"), strict=True):
        id_ = "id_julgado" if label == "fact" else "id_julgado_fk"
        parts.append(spark.table(f"{prefix}{name}").agg(
            F.lit(label).alias("part"), F.count("*").alias("n"), F.countDistinct(key).alias("n_keys"), F.sum(id_).alias("total")
        ))
    return reduce(DataFrame.unionByName, parts)
