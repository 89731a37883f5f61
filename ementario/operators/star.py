"""Staging -> fact and its two bridge dimensions, and their loading."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ementario.functions.dates import date_typed
from ementario.functions.legal import (
    outcome_of_text,
    outcome_text,
    reference_items,
    reference_matches,
    reference_parts,
    reference_row,
    subjects,
)
from ementario.functions.numbers import int_id
from ementario.functions.text import ws_normalize_full
from ementario.operators.keys import dense_keys
from ementario.operators.upsert import FIRST_AT, LAST, LAST_AT, changed_keys, collapse_wide, fact_policy, merge_ordered, new_keys
from ementario.schemas import BUCKET, DIM_PARTITION, DIM_REFS_KEY, DIM_SUBJECTS_KEY, LONG_FIELDS
from ementario.session import materialize
from ementario.sources.tables import read_if_any


#: Where a staging row stands in the order of all rows. They are no part of the record.
ORDER_COLUMNS = ("id_dw", "load_id", "rel_path", "pos", "_place")


def row_place(df: DataFrame, load_id: str) -> Column:
    """Text that orders rows: this load, the load of the file, the file and the position in it, or the row's number where
    files are not known.

    Numbers are padded, so that text compares as they do. The row's content breaks ties.
    """

    def number(c: Column) -> Column:
        text = c.cast("string")
        return F.lpad(text, F.greatest(F.lit(20), F.char_length(text)), F.lit("0"))

    loads = [number(F.lit(load_id)), *[number(F.coalesce(c, F.lit(0))) for c in ("load_id",) if c in df.columns]]
    if {"rel_path", "pos"} <= set(df.columns):
        at = [F.col("rel_path"), number(F.col("pos"))]
    else:
        at = [number(F.col("id_dw"))] if "id_dw" in df.columns else []
    content = F.hex(F.xxhash64(*[F.col(c) for c in df.columns if c not in ORDER_COLUMNS]))
    return F.concat_ws("|", *loads, *at, content)


def _col_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def with_id(staging: DataFrame) -> DataFrame:
    """Add ``id_julgado`` from ``id``, else ``id_origem``; null where neither is an integer."""
    return staging.withColumn(
        "id_julgado", int_id(_col_or_null(staging, "id"), _col_or_null(staging, "id_origem"))
    )


def id_fallback_parse(staging: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows with an id, rows without)``."""
    tagged = with_id(staging)
    return tagged.filter(F.col("id_julgado").isNotNull()), tagged.filter(F.col("id_julgado").isNull())


def pack_row_json(columns: list[str]) -> Column:
    """The row as one JSON object; nulls are kept as ``null``."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def fact_projection(staging: DataFrame) -> DataFrame:
    """One fact row per staging row with a usable id. Narrow: no shuffle."""
    rows, _ = id_fallback_parse(staging)
    order = [c for c in ORDER_COLUMNS if c in staging.columns]
    return _projected(rows, [c for c in staging.columns if c not in ORDER_COLUMNS], {c: F.col(c) for c in order})


def _projected(rows: DataFrame, source_columns: list[str], beside: dict[str, Column]) -> DataFrame:
    """Fact columns of rows with their ``id_julgado``, after it those named in ``beside``."""

    def clean(name: str) -> Column:
        return ws_normalize_full(_col_or_null(rows, name), long=name in LONG_FIELDS and name != "tema")

    others = {
        "teseJuridica": "tese_juridica_limpa", "acordaosSimilares": "acordaos_similares_limpo",
        "jurisprudenciaCitada": "jurisprudencia_citada_limpa",
    }
    # Steps, so that the cleaned texts and the searched text are computed once each.
    cleaned = rows.select(
        "id_julgado",
        *[c.alias(n) for n, c in beside.items()],
        F.coalesce(
            _col_or_null(rows, "id_origem_natural"), F.col("id_julgado").cast("string")
        ).alias("_natural"),
        date_typed(_col_or_null(rows, "dataDecisao")).alias("dt_decisao"),
        date_typed(_col_or_null(rows, "dataPublicacao")).alias("dt_publicacao"),
        clean("siglaClasse").alias("classe_sigla"),
        clean("nomeOrgaoJulgador").alias("orgao_julgador"),
        clean("ministroRelator").alias("ministro_relator"),
        clean("tema").alias("tema_repetitivo"),
        clean("ementa").alias("ementa_limpa"),
        clean("decisao").alias("decsiao_teor_limpo"),
        # As one array: written out, the columns make one method too large for the JVM to compile.
        F.transform(F.array(*(_col_or_null(rows, c) for c in others)), lambda x: ws_normalize_full(x)).alias("_others"),
        pack_row_json(source_columns).alias("teor_bruto_json"),
    )
    searched = cleaned.withColumn(
        "_text", outcome_text(F.col("decsiao_teor_limpo"), F.col("ementa_limpa"))
    )
    return searched.select(
        "id_julgado",
        *beside,
        ws_normalize_full(F.col("_natural"), long=False).alias("id_origem_natural"),
        "dt_decisao",
        "dt_publicacao",
        "classe_sigla",
        "orgao_julgador",
        "ministro_relator",
        outcome_of_text(F.col("_text")).alias("resultado_binario"),
        "tema_repetitivo",
        "ementa_limpa",
        "decsiao_teor_limpo",
        *[F.col("_others")[k].alias(name) for k, name in enumerate(others.values())],
        "teor_bruto_json",
    )


def legal_refs(df: DataFrame, id_col: str, refs: Column, mode: str = "intended") -> DataFrame:
    """At most one row per citation: ``id_julgado_fk, tipo_norma, norma_nome, artigo_dispositivo``.

    ``refs`` is an array of citation strings. Items are exploded before the patterns run,
    so the work of one long record spreads over rows and stays in generated code.
    """
    # Outer, since Spark puts a filter on the array before a plain explode, and would work the array out for it a second time.
    items = df.select(F.col(id_col).alias("id_julgado_fk"), F.explode_outer(refs).alias("_item"))
    texts = items.select("id_julgado_fk", ws_normalize_full(F.col("_item")).alias("_text"))
    found = texts.select("id_julgado_fk", *[c.alias(n) for n, c in reference_matches(F.col("_text"), mode).items()])
    parts = found.select("id_julgado_fk", *[c.alias(n) for n, c in reference_parts().items()])
    # Items without a citation leave as empty arrays, and then as the nulls of an outer inline: a filter on
    # the parsed row would be pushed below it and run every pattern a second time.
    rows = parts.select("id_julgado_fk", F.inline_outer(F.array_compact(F.array(reference_row(mode)))))
    return rows.where(F.col("tipo_norma").isNotNull())


def explode_subjects(df: DataFrame, id_col: str) -> DataFrame:
    """``id_julgado_fk, tipo_assunto, termo`` for theme, thesis and auxiliary terms."""
    found = subjects(*(_col_or_null(df, c) for c in ("tema", "teseJuridica", "termosAuxiliares")))
    return _subject_rows(df, id_col, found)


def _subject_rows(df: DataFrame, id_col: str, found: Column) -> DataFrame:
    # Outer for the same reason as citations.
    rows = df.select(F.col(id_col).alias("id_julgado_fk"), F.inline_outer(found))
    return rows.where(F.col("termo").isNotNull())


def placed_rows(staging: DataFrame, load_id: str) -> DataFrame:
    """Staging rows with their ``id_julgado`` and ``_place``: all that a load has to keep of them."""
    return with_id(staging.withColumn("_place", row_place(staging, load_id)))


def star_rows(staging: DataFrame, load_id: str) -> DataFrame:
    """All that a load needs of a staging table, from one pass over it.

    One row per staging row: the fact's columns, ``at`` (its place), ``itens`` (citations, not yet parsed), ``assuntos`` (theme,
    thesis and terms) and, for a row without a usable id, ``rejeitado`` (the record).
    """
    return _star_rows(placed_rows(staging, load_id), staging.columns)


def _star_rows(placed: DataFrame, columns: list[str]) -> DataFrame:
    """:func:`star_rows` of placed rows. From written ones each table reads and works out its own columns only."""
    beside = {
        "at": F.col("_place"),
        "itens": reference_items(_col_or_null(placed, "referenciasLegislativas")),
        "assuntos": subjects(*(_col_or_null(placed, c) for c in ("tema", "teseJuridica", "termosAuxiliares"))),
        "rejeitado": F.when(F.col("id_julgado").isNull(), F.to_json(F.struct(*dict.fromkeys([*columns, "id_julgado"])))),
    }
    return _projected(placed, record_columns(columns), beside)


def record_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c not in ORDER_COLUMNS]


def star_join_report(fact: DataFrame, refs: DataFrame) -> DataFrame:
    """Citations per norm type and outcome.

    The dimension is counted per fact and type before the join, so a decision that cites
    one type many times crosses the network once per type.
    """
    per_fact = refs.groupBy("id_julgado_fk", "tipo_norma").agg(F.count("*").alias("n"))
    return (
        fact.select("id_julgado", "resultado_binario")
        .join(per_fact, F.col("id_julgado") == F.col("id_julgado_fk"))
        .groupBy("tipo_norma", "resultado_binario")
        .agg(F.sum("n").alias("n"))
    )


# --- loading -----------------------------------------------------------------------


def current_table(spark: SparkSession, name: str) -> DataFrame | None:
    try:
        return spark.table(name)
    except AnalysisException as err:
        if err.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
            return None
        raise


#: Buckets of a fact table that does not exist yet. A table keeps the number with which it was made.
BUCKETS = 16
_BUCKETS_KEY = "ementario.buckets"

#: For files of whole records, whose texts come twice, cleaned and raw.
WIDE_CODEC = "zstd"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def fact_buckets(spark: SparkSession, name: str, buckets: int = BUCKETS) -> int:
    """The table's number of buckets; asked before anything is written, so a table of another layout is refused unharmed."""
    old = current_table(spark, name)
    if old is None:
        return buckets
    missing = {FIRST_AT, LAST_AT, BUCKET} - set(old.columns)
    if missing:
        raise ValueError(f"{name} has no column {', '.join(sorted(missing))}; create it with the library's layout")
    kept = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return int(kept.get(_BUCKETS_KEY, BUCKETS))


def publish_buckets(spark: SparkSession, name: str, rows: DataFrame, root: str, buckets: int) -> None:
    """Replace the buckets that ``rows`` (with their bucket) are in; all others keep their files.

    New files go to a folder of their own and each bucket is then pointed at it, so nothing that is being read is overwritten,
    and a failed write leaves the table as it was. A switch that stops half-way leaves whole buckets, old or new; the load's
    repetition ends in the same table. Rows are written where they are: each task adds a file to the buckets it has rows of. Old
    folders stay until they are removed.
    """
    location = f"{root}/snapshot-{uuid.uuid4().hex}"
    rows.write.partitionBy(BUCKET).option("compression", WIDE_CODEC).parquet(location)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({BUCKET}) LOCATION '{root}/{name}' "
            f"TBLPROPERTIES ('{_BUCKETS_KEY}' = '{buckets}')"
        )
    known = {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    # Folders, at most as many as buckets.
    written = [r[0] for r in spark.read.parquet(location).select(BUCKET).distinct().collect()]
    new = " ".join(f"PARTITION ({BUCKET}={b}) LOCATION '{location}/{BUCKET}={b}'" for b in written if f"{BUCKET}={b}" not in known)
    if new:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {new}")
    for b in written:
        if f"{BUCKET}={b}" in known:
            spark.sql(f"ALTER TABLE {name} PARTITION ({BUCKET}={b}) SET LOCATION '{location}/{BUCKET}={b}'")
    spark.catalog.refreshTable(name)


def check_dimension(spark: SparkSession, name: str) -> None:
    """A dimension that exists must be partitioned by load; asked before anything is written."""
    old = current_table(spark, name)
    if old is not None and DIM_PARTITION not in old.columns:
        raise ValueError(f"{name} has no column {DIM_PARTITION}; create it with the library's layout")


def reserve_ids(spark: SparkSession, path: str, load_id: str, n: int, taken: int) -> int:
    """The number before the first of ``n`` that belong to this load alone.

    ``path`` is a small table of all ranges given out; ``taken`` is the largest number in use (for tables made
    without ranges). One load at a time, as for the table itself.
    """
    given = read_if_any(spark, path, "load string, start long, n long")
    start = max(given.agg(F.max(F.col("start") + F.col("n"))).first()[0] or 0, taken)
    spark.createDataFrame([(load_id, start, n)], "load string, start long, n long").write.mode("append").parquet(path)
    return start


def append_dimension(
    spark: SparkSession, name: str, rows: DataFrame, keys: list[str], key_name: str, location: str, load_id: str
) -> None:
    """Add the natural keys a dimension does not hold yet, numbered from a range of ids that this load reserves.

    Nothing already stored is rewritten or renumbered. A repeated load finds its keys and adds nothing; if it has grown, what is
    new gets a further range. The numbers have no gap unless a load died after it reserved them.
    """
    part = f"load-{load_id}"  # never reads as a number, so the partition value stays text
    old = current_table(spark, name)
    fresh = new_keys(old, rows, keys) if old is not None else rows.select(*keys).dropDuplicates(keys)
    fresh = materialize(fresh, f"{name}-keys")
    n = fresh.count()
    path = f"{location}/{DIM_PARTITION}={part}"
    if n or old is None:
        taken = 0 if old is None else old.agg(F.max(key_name)).first()[0] or 0
        start = reserve_ids(spark, f"{location}-faixas", load_id, n, taken) if n else taken
        numbered = dense_keys(fresh, keys, key_name)
        numbered.select((F.col(key_name) + start).alias(key_name), *keys).write.mode("append").parquet(path)
    if old is None:
        spark.catalog.createTable(name, path=location, source="parquet")
        spark.catalog.recoverPartitions(name)
    elif n:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({DIM_PARTITION}='{part}') LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def load_star(
    spark: SparkSession, staging: DataFrame, root: str, load_id: str, mode: str = "intended",
    prefix: str = "", buckets: int = BUCKETS,
) -> None:
    """Upsert a staging table, or the part of it that is new, into ``fato_julgados_stj`` and its dimensions.

    A load that died between the tables is mended by its repetition.

    ``staging`` is read once: its rows are treated and written, and the tables read what they need of that. The fact
    keeps the places of each row's first and last write, so loads may be repeated or arrive in any order and end in the
    same tables. It lies in ``buckets`` of its id, and a load reads and writes only those that its ids fall into.
    Rows without a usable id are written below ``rejeitados`` as records. Dimensions only grow. A table of another layout is
    refused before anything is written.
    """
    load_dimensions(spark, load_fact(spark, staging, root, load_id, prefix, buckets), root, load_id, mode, prefix)


def load_fact(
    spark: SparkSession, staging: DataFrame, root: str, load_id: str, prefix: str = "", buckets: int = BUCKETS
) -> DataFrame:
    """The first half of ``load_star``; gives the written rows that the dimensions are loaded from."""
    for dim in ("dim_referencias_legais", "dim_assuntos_stj"):
        check_dimension(spark, f"{prefix}{dim}")
    name = f"{prefix}fato_julgados_stj"
    buckets = fact_buckets(spark, name, buckets)

    # A number of its own, so that rows which are equal in all else can be told apart.
    placed = placed_rows(staging, load_id).withColumn("_n", F.monotonically_increasing_id())
    placed = materialize(placed, f"{name}-rows", WIDE_CODEC)
    rows = _star_rows(placed, staging.columns)
    rejected = rows.filter(F.col("id_julgado").isNull()).select(F.lit("no usable id").alias("reason"), F.col("rejeitado").alias("record"))
    rejected.write.mode("overwrite").parquet(f"{root}/{prefix}rejeitados/{DIM_PARTITION}=load-{load_id}")

    # Records as they came are compared, sent and joined; the fact's columns are made of those that won, where they are written.
    fact = placed.filter(F.col("id_julgado").isNotNull())
    record = record_columns(staging.columns)
    bucket = bucket_of(F.col("id_julgado"), buckets).alias(BUCKET)
    changes = collapse_wide(
        fact, "id_julgado", {c: LAST for c in record if c != "id_julgado"}, "_place", "_n", {"_primeiro": pack_row_json(record)}
    )

    def derive(df: DataFrame, keep: list[str]) -> DataFrame:
        made = _projected(df, record, {c: F.col(c) for c in (*keep, "_primeiro")})
        return made.withColumn("teor_bruto_json", F.coalesce("_primeiro", "teor_bruto_json")).drop("_primeiro")

    places = [FIRST_AT, LAST_AT]
    policy = fact_policy(derive(changes, []).columns)
    old = current_table(spark, name)
    if old is None:
        made = derive(changes.select("*", bucket).hint("rebalance", BUCKET), [*places, BUCKET])
        publish_buckets(spark, name, made.select("id_julgado", *policy, *places, BUCKET), f"{root}/{name}", buckets)
        return rows
    seen = fact.agg(F.collect_set(bucket).alias("touched"), F.min("_place").alias("first")).first()  # at most as many as buckets
    old, touched = old.filter(F.col(BUCKET).isin(seen.touched)), seen.touched
    newest = old.agg(F.max(LAST_AT)).first()[0]
    if newest is not None and touched and seen.first <= newest:
        # Not later than all that is stored, so it may be a repetition: a bucket to which it brings nothing stays as it is.
        touched = [r[0] for r in changed_keys(old, changes, "id_julgado").select(bucket).distinct().collect()]
        old, changes = old.filter(F.col(BUCKET).isin(touched)), changes.filter(bucket_of(F.col("id_julgado"), buckets).isin(touched))
    if touched:
        kept = merge_ordered(old, changes, "id_julgado", policy, derive)
        publish_buckets(spark, name, kept.select("*", bucket), f"{root}/{name}", buckets)
    return rows


def load_dimensions(
    spark: SparkSession, rows: DataFrame, root: str, load_id: str, mode: str = "intended", prefix: str = ""
) -> None:
    """The second half of ``load_star``, from the rows that ``load_fact`` gave."""
    refs = legal_refs(rows.filter(F.col("id_julgado").isNotNull()), "id_julgado", F.col("itens"), mode)
    subj = _subject_rows(rows.filter(F.col("id_julgado").isNotNull()), "id_julgado", F.col("assuntos"))
    for dim, found, keys, key_name in (
        ("dim_referencias_legais", refs, DIM_REFS_KEY, "id_ref_legal"),
        ("dim_assuntos_stj", subj, DIM_SUBJECTS_KEY, "id_assunto"),
    ):
        append_dimension(spark, f"{prefix}{dim}", found, keys, key_name, f"{root}/{prefix}{dim}", load_id)
