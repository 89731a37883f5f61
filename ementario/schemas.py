"""Fixed layouts of the staging table, the star schema and the vector table."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: source field names, layouts and column widths -------------------

# Free-text fields: never truncated, always sized as TEXT.
LONG_FIELDS = (
    "descricaoClasse",
    "ementa",
    "decisao",
    "jurisprudenciaCitada",
    "informacoesComplementares",
    "notas",
    "termosAuxiliares",
    "teseJuridica",
    "referenciasLegislativas",
    "acordaosSimilares",
    "tema",
)

# Short staging columns and their declared widths.
STAGING_WIDTHS = {
    "id_origem": 50,
    "numeroProcesso": 50,
    "numeroRegistro": 50,
    "Obs": 60,
    "dataDecisao": 50,
    "dataPublicacao": 300,
    "ministroRelator": 90,
    "nomeOrgaoJulgador": 50,
    "tipoDeDecisao": 50,
    "siglaClasse": 150,
}

FACT_WIDTHS = {
    "id_origem_natural": 50,
    "classe_sigla": 150,
    "orgao_julgador": 50,
    "ministro_relator": 90,
}

# Truncation limits applied while loading, by lower-case column name; the rest get 255.
LOAD_LIMITS = {
    "numeroprocesso": 50,
    "numeroregistro": 50,
    "id": 50,
    "datapublicacao": 300,
}
DEFAULT_LOAD_LIMIT = 255

# Columns read as dates while loading, by lower-case name.
DATE_FIELDS = (
    "datadecisao",
    "datadisponibilizacao",
    "dataregistro",
    "dataregistrada",
    "datanascimento",
    "datarequisicao",
    "datapublicacao",
)

# Source keys that all mean the natural id, by lower-case name.
ID_KEYS = ("id", "id_registro")
ID_COLUMN = "id_origem"
REQUIRED_FIELDS = (ID_COLUMN,)

ARRAY_FIELDS = ("referenciasLegislativas", "acordaosSimilares")

VECTOR_DIM = 768
SOURCE_TAG = "ACORDAO_COMPLETO"

# --- end of fixed values -----------------------------------------------------------


def _strings(names: tuple[str, ...] | list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# One source record. Every field is read as text, so no value can contradict the schema:
# arrays and nested objects arrive as their JSON text.
SOURCE = T.StructType(
    _strings(
        ["id", "id_registro", "numeroProcesso", "numeroRegistro", "Obs", "dataDecisao",
         "dataPublicacao", "ministroRelator", "nomeOrgaoJulgador", "tipoDeDecisao", "siglaClasse"]
    )
    + _strings(LONG_FIELDS)
)

STAGING = T.StructType(
    [T.StructField("id_dw", T.LongType())]
    + _strings(list(STAGING_WIDTHS))
    + _strings(LONG_FIELDS)
)

#: The bucket of its id in which a fact lies; the fact table is partitioned by it.
BUCKET = "balde"

FACT = T.StructType(
    [
        T.StructField("id_julgado", T.LongType(), False),
        T.StructField("id_origem_natural", T.StringType(), False),
        T.StructField("dt_decisao", T.DateType()),
        T.StructField("dt_publicacao", T.DateType()),
        T.StructField("classe_sigla", T.StringType()),
        T.StructField("orgao_julgador", T.StringType()),
        T.StructField("ministro_relator", T.StringType()),
        T.StructField("resultado_binario", T.BooleanType()),
        T.StructField("tema_repetitivo", T.StringType()),
        T.StructField("ementa_limpa", T.StringType()),
        T.StructField("decsiao_teor_limpo", T.StringType()),
        T.StructField("tese_juridica_limpa", T.StringType()),
        T.StructField("acordaos_similares_limpo", T.StringType()),
        T.StructField("jurisprudencia_citada_limpa", T.StringType()),
        T.StructField("teor_bruto_json", T.StringType()),
        T.StructField("ordem_primeira", T.StringType()),
        T.StructField("ordem_ultima", T.StringType()),
        T.StructField(BUCKET, T.IntegerType()),
    ]
)

#: Column of the load that added a row of a dimension; the dimension tables are partitioned by it.
DIM_PARTITION = "load"

DIM_REFS = T.StructType(
    [
        T.StructField("id_ref_legal", T.LongType()),
        T.StructField("id_julgado_fk", T.LongType(), False),
        T.StructField("tipo_norma", T.StringType(), False),
        T.StructField("norma_nome", T.StringType(), False),
        T.StructField("artigo_dispositivo", T.StringType(), False),
        T.StructField(DIM_PARTITION, T.StringType()),
    ]
)
DIM_REFS_KEY = ["id_julgado_fk", "tipo_norma", "norma_nome", "artigo_dispositivo"]

DIM_SUBJECTS = T.StructType(
    [
        T.StructField("id_assunto", T.LongType()),
        T.StructField("id_julgado_fk", T.LongType(), False),
        T.StructField("tipo_assunto", T.StringType(), False),
        T.StructField("termo", T.StringType(), False),
        T.StructField(DIM_PARTITION, T.StringType()),
    ]
)
DIM_SUBJECTS_KEY = ["id_julgado_fk", "tipo_assunto", "termo"]

VECTORS = T.StructType(
    [
        T.StructField("id_julgado_fk", T.LongType(), False),
        T.StructField("texto_fonte", T.StringType()),
        T.StructField("tipo_fonte", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

TABLES = {
    "judged": STAGING,
    "fato_julgados_stj": FACT,
    "dim_referencias_legais": DIM_REFS,
    "dim_assuntos_stj": DIM_SUBJECTS,
    "dim_vetores": VECTORS,
}
