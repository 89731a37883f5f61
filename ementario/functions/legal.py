"""Outcome of a decision, cited norms and subject terms."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ementario.functions.json_values import one_value
from ementario.functions.text import split_terms, ws_normalize_full

# --- fixed values: outcome phrases, citation syntax, subject tags -------------------
FAVOURABLE = (
    "DAR PROVIMENTO",
    "DEU PROVIMENTO",
    "ACOLHER OS EMBARGOS",
    "CONHECER.*E DAR PROVIMENTO",
    "JULGAR PROCEDENTE",
)
UNFAVOURABLE = (
    "NEGAR PROVIMENTO",
    "NEGOU PROVIMENTO",
    "REJEITAR OS EMBARGOS",
    "NÃO CONHECER DO RECURSO",
    "INDEFERIR O PEDIDO",
    "JULGAR IMPROCEDENTE",
)

_WORD = r"[\p{L}\p{N}_]+"
NORM = rf"LEG:FED ({_WORD}):(\*+|[A-Z0-9]+)"
SUMULA = r"SUM:([0-9]+)"
# "intended" finds the first article with or without a following INC/PAR; "as_written"
# needs both separating spaces, so it only matches when an INC and more text follow.
PROVISION = {
    "intended": rf"ART:({_WORD})(?: INC:({_WORD}))?(?: PAR:({_WORD}))?",
    "as_written": rf"ART:({_WORD}) (?:INC:({_WORD}))? (?:PAR:({_WORD}))?",
}

TAG_TEMA = "TEMA_REPETITIVO"
TAG_TESE = "TESE_JURIDICA"
TAG_TERMO = "TERMO_AUXILIAR"
# --- end of fixed values -----------------------------------------------------------


def _any_pattern(text: Column, patterns: Sequence[str]) -> Column:
    """Whether any pattern occurs. Plain phrases are searched as bytes, which is several
    times faster than a regular expression, and before the patterns that need one."""
    def literal(p: str) -> bool:
        return re.escape(p).replace("\\ ", " ") == p

    plain = [p for p in patterns if literal(p)]
    # Phrases with anything between them occur only where each of them does, so one that holds a plain phrase adds nothing.
    regex = [
        p for p in patterns
        if p not in plain and not (all(map(literal, p.split(".*"))) and any(q in x for q in plain for x in p.split(".*")))
    ]
    tests = [F.contains(text, F.lit(p)) for p in plain]
    if regex:
        tests.append(text.rlike("|".join(f"(?:{p})" for p in regex)))
    return reduce(Column.__or__, tests)


def outcome_text(decisao: Column, ementa: Column) -> Column:
    """The text that outcome phrases are searched in, from already cleaned parts."""
    return F.upper(F.concat(decisao, F.lit(" "), ementa))


def outcome_of_text(
    text: Column,
    favourable: Sequence[str] = FAVOURABLE,
    unfavourable: Sequence[str] = UNFAVOURABLE,
) -> Column:
    """True, false or unknown; favourable is tried first.

    ``text`` is read once per phrase, so pass a column that is already computed.
    """
    return F.when(_any_pattern(text, favourable), True).when(
        _any_pattern(text, unfavourable), False
    )


def outcome(
    decisao: Column,
    ementa: Column,
    favourable: Sequence[str] = FAVOURABLE,
    unfavourable: Sequence[str] = UNFAVOURABLE,
) -> Column:
    text = outcome_text(ws_normalize_full(decisao), ws_normalize_full(ementa))
    return outcome_of_text(text, favourable, unfavourable)


def reference_items(json_text: Column) -> Column:
    """Citation strings in a JSON list of strings or of ``{"referencia": ...}`` objects.

    Null, invalid JSON, text after the list and anything that is not a list give an empty array.
    """
    none = F.array().cast("array<string>")
    # Text that does not begin as a list is not parsed.
    listed = F.when(F.startswith(F.ltrim(json_text, F.lit(" \t\r\n")), F.lit("[")), json_text)
    read = F.array(one_value(listed, "array<string>"))
    items = F.transform(read, lambda r: F.when(r["whole"], F.coalesce(r["value"], none)).otherwise(none))
    return F.transform(
        items[0],
        lambda x: F.when(
            F.startswith(F.ltrim(x), F.lit("{")) & F.try_parse_json(x).isNotNull(),
            F.coalesce(F.get_json_object(x, "$.referencia"), F.lit("")),
        ).otherwise(F.coalesce(x, F.lit(""))),
    )


def reference_matches(text: Column, mode: str = "intended") -> dict[str, Column]:
    """What each citation pattern finds in one cleaned citation, ``''`` where nothing. A pattern runs once, and only where
    the phrase that it begins with occurs."""

    def found(phrase: str, pattern: str, group: int = 0) -> Column:
        return F.when(F.contains(text, F.lit(phrase)), F.regexp_extract(text, pattern, group)).otherwise(F.lit(""))

    return {"_norm": found("LEG:FED ", NORM), "_provision": found("ART:", PROVISION[mode]), "_sumula": found("SUM:", SUMULA, 1)}


def reference_parts() -> dict[str, Column]:
    """The raw captures of one citation from :func:`reference_matches`; every part is ``''`` where absent.

    Captured words hold neither colons nor spaces, so a match is taken apart at these.
    """
    norm, provision = F.col("_norm"), F.col("_provision")

    def after(label: str) -> Column:
        rest = F.substring_index(F.substring_index(provision, label, -1), " ", 1)
        return F.when(F.contains(provision, F.lit(label)), rest).otherwise(F.lit(""))

    return {
        "_kind": F.substring_index(F.substring_index(norm, ":", 2), " ", -1),
        "_name": F.substring_index(norm, ":", -1),
        "_sumula": F.col("_sumula"),
        "_art": after("ART:"),
        "_inc": after(" INC:"),
        "_par": after(" PAR:"),
    }


def reference_row(mode: str = "intended") -> Column:
    """``struct(tipo_norma, norma_nome, artigo_dispositivo)`` from the captures, or null."""
    kind, sumula = F.col("_kind"), F.col("_sumula")

    def part(label: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(label), value)).otherwise("")

    def row(tipo: Column, nome: Column, artigo: Column) -> Column:
        return F.struct(
            tipo.alias("tipo_norma"), nome.alias("norma_nome"), artigo.alias("artigo_dispositivo")
        )

    provision = F.concat(
        part("ART:", F.col("_art")), part(" PAR:", F.col("_par")), part(" INC:", F.col("_inc"))
    )
    is_sumula = (kind == "") & (sumula != "")
    if mode == "intended":
        is_sumula = is_sumula | ((kind == "SUM") & (sumula != ""))
    return F.when(
        is_sumula, row(F.lit("SUMULA"), F.concat(F.lit("SUMULA "), sumula), F.lit(""))
    ).when(kind != "", row(kind, F.col("_name"), provision))


def subjects(tema: Column, tese: Column, termos: Column) -> Column:
    """Array of ``struct(tipo_assunto, termo)``: theme, thesis, then each auxiliary term."""

    def tagged(tag: str, value: Column) -> Column:
        return F.struct(F.lit(tag).alias("tipo_assunto"), value.alias("termo"))

    return F.filter(
        F.concat(
            F.array(
                tagged(TAG_TEMA, ws_normalize_full(tema)),
                tagged(TAG_TESE, ws_normalize_full(tese)),
            ),
            F.transform(split_terms(termos), lambda t: tagged(TAG_TERMO, t)),
        ),
        lambda s: s["termo"] != "",
    )
