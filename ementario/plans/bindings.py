"""Court-decision-shaped input made from the given tables.

Every row of ``orders`` is one decision: codes, dates and free text in the shapes the
source publishes, from expressions that exist in Spark and in DuckDB alike. The SQL twin
of each binding is next to it, so the oracles do not depend on Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ementario.sources.tables import read_table, spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _pad(c: Column, n: int) -> Column:
    text = c.cast("string")
    return F.lpad(text, F.greatest(F.lit(n), F.char_length(text)), F.lit("0"))


def judged_like(spark: SparkSession, sf_dir: str, court: bool = False, text: bool = False) -> DataFrame:
    """Staging-like rows, one per order.

    ``court`` joins the customer for court and judge; ``text`` joins a document as the
    summary. Queries ask only for what they read.
    """
    # Dealt out while the rows are still narrow; the texts join after that.
    o = spread(read_table(spark, sf_dir, "orders"))
    if court:
        c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
        o = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    if text:
        docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
        n_docs = docs.agg(F.count("*")).scalar()
        o = o.withColumn("_doc", F.col("o_orderkey") % n_docs).join(
            docs, F.col("_doc") == F.col("doc_id"), "left"
        )
    key = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    none = F.lit(None).cast("string")
    dmy = F.date_format("o_orderdate", "dd/MM/yyyy")
    published = (
        F.when(key % 5 == 0, F.concat(F.lit("DJE        DATA:"), dmy, F.lit("      PG:1")))
        .when(key % 5 == 1, F.concat(F.lit("DJ         DATA:"), dmy, F.lit("\nRSTJ       VOL.:00005")))
        .when(key % 5 == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(key % 5 == 3, F.date_format("o_orderdate", "yyyyMMdd"))
        .otherwise(F.concat(F.lit("SEM DATA "), key.cast("string")))
    )
    decided = (
        F.when(status == "F", "POR UNANIMIDADE,  DEU PROVIMENTO AO RECURSO.")
        .when(status == "O", "POR MAIORIA, NEGAR\n PROVIMENTO AO RECURSO.")
        .otherwise("CONCEDER A ORDEM.")
    )
    law = F.concat(
        F.lit("LEG:FED LEI:"), _pad(F.col("o_custkey"), 6),
        F.lit("\\nANO:1991\\n*****  LBPS-91    LEI DE BENEFICIOS\\n        ART:"),
        _pad(key % 100 + 1, 5), F.lit(" ART:00103"),
    )
    constitution = F.concat(
        F.lit("LEG:FED CFD:****** ANO:1988\\n*****  CF-1988\\n        ART:00005 INC:"),
        _pad(key % 78 + 1, 5), F.lit(" LET:A"),
    )
    precedent = F.concat(
        F.lit("LEG:FED SUM:****** ANO:****\\n*****  SUM(STJ)\\n        SUM:"), _pad(key % 650, 6)
    )
    bare = F.concat(F.lit("SUM:"), _pad(key % 700, 6))
    state_law = F.lit("LEG:EST LEI:000001 ANO:2000")
    refs = (
        F.when(key % 4 == 0, F.concat(
            F.lit('["'), law, F.lit('","'), constitution, F.lit('","'), precedent, F.lit('","'), state_law, F.lit('"]')))
        .when(key % 4 == 1, F.concat(
            F.lit('[{"referencia":"'), law, F.lit('"},{"referencia":"'), bare, F.lit('"},{"nota":"x"}]')))
        .when(key % 4 == 2, F.concat(F.lit("ver nota "), key.cast("string")))
    )
    return o.select(
        key.alias("id_dw"),
        _pad(key, 9).alias("id_origem"),
        F.col("o_custkey").cast("string").alias("numeroProcesso"),
        (key + 202500000000).cast("string").alias("numeroRegistro"),
        none.alias("Obs"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("dataDecisao"),
        published.alias("dataPublicacao"),
        (F.col("c_name") if court else none).alias("ministroRelator"),
        (F.col("c_mktsegment") if court else none).alias("nomeOrgaoJulgador"),
        F.lit("ACÓRDÃO").alias("tipoDeDecisao"),
        F.col("o_orderpriority").alias("siglaClasse"),
        F.concat(F.lit("RECURSO  "), F.col("o_orderpriority")).alias("descricaoClasse"),
        none.alias("informacoesComplementares"),
        none.alias("notas"),
        (F.col("text") if text else none).alias("ementa"),
        decided.alias("decisao"),
        F.when(key % 3 == 0, F.concat(F.lit("(CLASSE)\tSTJ - "), F.col("o_orderpriority"))).alias("jurisprudenciaCitada"),
        F.concat(F.col("o_orderpriority"), F.lit("; situação  "), status, F.lit(";; cliente\t"),
                 F.col("o_custkey").cast("string"), F.lit(" ; ")).alias("termosAuxiliares"),
        F.when(key % 11 == 0, F.concat(F.lit("Tese\n firmada "), F.col("o_orderpriority"))).alias("teseJuridica"),
        refs.alias("referenciasLegislativas"),
        F.when(key % 2 == 0, F.lit("AgInt 18409 DF\nDecisão:02/09/2024")).alias("acordaosSimilares"),
        F.when(key % 7 == 0, (key % 1000).cast("string")).alias("tema"),
    )


def with_text_key(spark: SparkSession, sf_dir: str, rows: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """For rows of :func:`judged_like` without text: the rows, the documents as ``ementa``, and how these join."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("ementa"))
    n_docs = docs.agg(F.count("*")).scalar()
    return rows.drop("ementa").withColumn("_doc", F.col("id_dw") % n_docs), docs, F.col("_doc") == F.col("doc_id")


def judged_sql(court: bool = False, text: bool = False) -> str:
    """The same rows as a DuckDB subquery."""

    def pad(e: str, n: int) -> str:
        t = f"CAST({e} AS VARCHAR)"
        return f"lpad({t}, greatest({n}, length({t}))::INT, '0')"

    k = "o_orderkey"
    law = (
        f"'LEG:FED LEI:' || {pad('o_custkey', 6)} || '\\nANO:1991\\n*****  LBPS-91    LEI DE BENEFICIOS\\n"
        f"        ART:' || {pad(k + ' % 100 + 1', 5)} || ' ART:00103'"
    )
    con = (
        "'LEG:FED CFD:****** ANO:1988\\n*****  CF-1988\\n        ART:00005 INC:' || "
        f"{pad(k + ' % 78 + 1', 5)} || ' LET:A'"
    )
    pre = f"'LEG:FED SUM:****** ANO:****\\n*****  SUM(STJ)\\n        SUM:' || {pad(k + ' % 650', 6)}"
    bare = f"'SUM:' || {pad(k + ' % 700', 6)}"
    joins = ""
    if court:
        joins += " LEFT JOIN customer ON o_custkey = c_custkey"
    if text:
        joins += " LEFT JOIN documents ON doc_id = o_orderkey % (SELECT count(*) FROM documents)"
    none = "CAST(NULL AS VARCHAR)"
    return f"""(SELECT {k} AS id_dw, {pad(k, 9)} AS id_origem,
  CAST(o_custkey AS VARCHAR) AS numeroProcesso,
  CAST({k} + 202500000000 AS VARCHAR) AS numeroRegistro,
  {none} AS Obs,
  strftime(o_orderdate, '%Y%m%d') AS dataDecisao,
  CASE {k} % 5
    WHEN 0 THEN 'DJE        DATA:' || strftime(o_orderdate, '%d/%m/%Y') || '      PG:1'
    WHEN 1 THEN 'DJ         DATA:' || strftime(o_orderdate, '%d/%m/%Y') || chr(10) || 'RSTJ       VOL.:00005'
    WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 3 THEN strftime(o_orderdate, '%Y%m%d')
    ELSE 'SEM DATA ' || CAST({k} AS VARCHAR) END AS dataPublicacao,
  {'c_name' if court else none} AS ministroRelator,
  {'c_mktsegment' if court else none} AS nomeOrgaoJulgador,
  'ACÓRDÃO' AS tipoDeDecisao,
  o_orderpriority AS siglaClasse,
  'RECURSO  ' || o_orderpriority AS descricaoClasse,
  {none} AS informacoesComplementares,
  {none} AS notas,
  {'text' if text else none} AS ementa,
  CASE o_orderstatus WHEN 'F' THEN 'POR UNANIMIDADE,  DEU PROVIMENTO AO RECURSO.'
    WHEN 'O' THEN 'POR MAIORIA, NEGAR' || chr(10) || ' PROVIMENTO AO RECURSO.'
    ELSE 'CONCEDER A ORDEM.' END AS decisao,
  CASE WHEN {k} % 3 = 0 THEN '(CLASSE)' || chr(9) || 'STJ - ' || o_orderpriority END AS jurisprudenciaCitada,
  o_orderpriority || '; situação  ' || o_orderstatus || ';; cliente' || chr(9) || CAST(o_custkey AS VARCHAR) || ' ; ' AS termosAuxiliares,
  CASE WHEN {k} % 11 = 0 THEN 'Tese' || chr(10) || ' firmada ' || o_orderpriority END AS teseJuridica,
  CASE {k} % 4
    WHEN 0 THEN '["' || {law} || '","' || {con} || '","' || {pre} || '","LEG:EST LEI:000001 ANO:2000"]'
    WHEN 1 THEN '[{{"referencia":"' || {law} || '"}},{{"referencia":"' || {bare} || '"}},{{"nota":"x"}}]'
    WHEN 2 THEN 'ver nota ' || CAST({k} AS VARCHAR) END AS referenciasLegislativas,
  CASE WHEN {k} % 2 = 0 THEN 'AgInt 18409 DF' || chr(10) || 'Decisão:02/09/2024' END AS acordaosSimilares,
  CASE WHEN {k} % 7 = 0 THEN CAST({k} % 1000 AS VARCHAR) END AS tema
FROM orders{joins})"""


# --- SQL pieces for the oracles -----------------------------------------------------
SQL_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_clean_full(e: str) -> str:
    return f"coalesce(trim(regexp_replace({e}, '{SQL_WS}+', ' ', 'g')), '')"


def sql_strip(e: str) -> str:
    return f"regexp_replace(regexp_replace({e}, '^{SQL_WS}+', ''), '{SQL_WS}+$', '')"


def sql_clean(e: str) -> str:
    one_line = f"regexp_replace({e}, '[\\r\\n\\t]+', ' ', 'g')"
    return sql_strip(f"regexp_replace({one_line}, '{SQL_WS}{{2,}}', ' ', 'g')")


def sql_typed_date(e: str) -> str:
    return (
        f"coalesce(CASE WHEN regexp_full_match({e}, '[0-9]{{8}}') THEN try_strptime({e}, '%Y%m%d')::DATE END, "
        f"try_strptime(nullif(regexp_extract({e}, 'DATA:([0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}})', 1), ''), '%d/%m/%Y')::DATE, "
        f"try_strptime({e}, '%Y-%m-%d')::DATE)"
    )


# --- fixed values: outcome phrases, as the classifier has them -------------------------
SQL_FAVOURABLE = (
    "DAR PROVIMENTO|DEU PROVIMENTO|ACOLHER OS EMBARGOS|CONHECER.*E DAR PROVIMENTO|JULGAR PROCEDENTE"
)
SQL_UNFAVOURABLE = (
    "NEGAR PROVIMENTO|NEGOU PROVIMENTO|REJEITAR OS EMBARGOS|NÃO CONHECER DO RECURSO|"
    "INDEFERIR O PEDIDO|JULGAR IMPROCEDENTE"
)
# --- end of fixed values ---------------------------------------------------------------


def sql_outcome(decisao: str, ementa: str) -> str:
    text = f"upper({sql_clean_full(decisao)} || ' ' || {sql_clean_full(ementa)})"
    return (
        f"CASE WHEN regexp_matches({text}, '{SQL_FAVOURABLE}') THEN TRUE "
        f"WHEN regexp_matches({text}, '{SQL_UNFAVOURABLE}') THEN FALSE END"
    )


def sql_refs(judged: str, mode: str) -> str:
    """``id_julgado_fk, tipo_norma, norma_nome, artigo_dispositivo`` of a judged subquery."""
    # The citation patterns, as the parser has them.
    provision = {
        "intended": r"ART:(\w+)(?: INC:(\w+))?(?: PAR:(\w+))?",
        "as_written": r"ART:(\w+) (?:INC:(\w+))? (?:PAR:(\w+))?",
    }[mode]
    sumula_rule = "t = '' OR t = 'SUM'" if mode == "intended" else "t = ''"
    return f"""(SELECT id_julgado_fk,
    CASE WHEN is_sum THEN 'SUMULA' ELSE t END AS tipo_norma,
    CASE WHEN is_sum THEN 'SUMULA ' || s ELSE nm END AS norma_nome,
    CASE WHEN is_sum THEN '' ELSE
      (CASE WHEN a <> '' THEN 'ART:' || a ELSE '' END) || (CASE WHEN p <> '' THEN ' PAR:' || p ELSE '' END)
      || (CASE WHEN i <> '' THEN ' INC:' || i ELSE '' END) END AS artigo_dispositivo
  FROM (SELECT *, (({sumula_rule}) AND s <> '') AS is_sum FROM (
    SELECT id_julgado_fk,
      regexp_extract(n, 'LEG:FED (\\w+):(\\*+|[A-Z0-9]+)', 1) AS t,
      regexp_extract(n, 'LEG:FED (\\w+):(\\*+|[A-Z0-9]+)', 2) AS nm,
      regexp_extract(n, 'SUM:([0-9]+)', 1) AS s,
      regexp_extract(n, '{provision}', 1) AS a,
      regexp_extract(n, '{provision}', 2) AS i,
      regexp_extract(n, '{provision}', 3) AS p
    FROM (SELECT id_julgado_fk, {sql_clean_full("CASE json_type(item) WHEN 'OBJECT' THEN item->>'$.referencia' ELSE item->>'$' END")} AS n
      FROM (SELECT TRY_CAST(id_origem AS BIGINT) AS id_julgado_fk, unnest(json_extract(referenciasLegislativas, '$[*]')) AS item
        FROM {judged} WHERE json_valid(referenciasLegislativas)))))
  WHERE is_sum OR t <> '')"""


def sql_subjects(judged: str) -> str:
    """``id_julgado_fk, tipo_assunto, termo`` of a judged subquery."""
    return f"""(SELECT * FROM (
    SELECT TRY_CAST(id_origem AS BIGINT) AS id_julgado_fk, 'TEMA_REPETITIVO' AS tipo_assunto, {sql_clean_full('tema')} AS termo FROM {judged}
    UNION ALL SELECT TRY_CAST(id_origem AS BIGINT), 'TESE_JURIDICA', {sql_clean_full('teseJuridica')} FROM {judged}
    UNION ALL SELECT TRY_CAST(id_origem AS BIGINT), 'TERMO_AUXILIAR', trim(unnest(string_split({sql_clean_full('termosAuxiliares')}, ';'))) FROM {judged})
  WHERE termo <> '')"""
