"""Tuning proposals in free text: find the JSON, classify it, read typed fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID, EMPTY, UNPARSEABLE, NON_OBJECT = "VALID", "EMPTY", "UNPARSEABLE", "NON_OBJECT"
#: JSON of a value that counts as no proposal at all; numbers in canonical form.
_FALSY = r'^\s*(\{\s*\}|\[\s*\]|null|""|false)\s*$'
_ZERO = r"^-?0(\.0*)?([eE][+-]?[0-9]+)?$"


def json_span(text: Column) -> Column:
    """From the first ``{`` to the last ``}``, or the whole text if there is no such span."""
    span = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.coalesce(F.nullif(span, F.lit("")), text)


def as_integer(value: Column) -> Column:
    """A variant as a whole number: numbers truncated, true 1, integer literals; else null."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    literal = F.when(
        text.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"),
        F.regexp_replace(text, r"[\s_]", "").try_cast("bigint"),
    )
    return (
        F.when(kind.isin("BOOLEAN", "BIGINT"), F.try_variant_get(value, "$", "bigint"))
        .when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), F.try_variant_get(value, "$", "double").try_cast("bigint"))
        .when(kind == "STRING", literal)
    )


def parse_proposals(rows: DataFrame, text: str = "respuesta") -> DataFrame:
    """``rows`` with ``clase, accion, parametro, valor_texto, valor_entero, valor_lista, razon``.

    Field texts are empty where absent and the reason ``Sin razón``. A null text is
    an empty proposal (no answer came). Of repeated JSON keys the last counts (a setting of ``session.configure``).
    """
    wrapped = F.concat(F.lit("["), json_span(F.col(text)), F.lit("]"))
    parsed = F.when(F.json_array_length(wrapped) == 1, F.try_parse_json(wrapped))
    df = rows.withColumn("_p", parsed).withColumn("_v", F.try_variant_get("_p", "$[0]", "variant"))
    # The text is valid JSON where this is asked, so its first character tells the kind of value.
    span = json_span(F.col(text))
    number = span.rlike(r"^\s*[-0-9]")
    clase = (
        F.when(F.col(text).isNull(), EMPTY)
        .when(F.col("_p").isNull(), UNPARSEABLE)
        .when(span.rlike(_FALSY) | (number & F.to_json("_v").rlike(_ZERO)), EMPTY)
        .when(span.rlike(r"^\s*\{"), VALID)
        .otherwise(NON_OBJECT)
    )
    # Class and parsed value come out of a list of one, so a filter on what is read from them is not pushed below, where it
    # would parse again; fields that nobody asks for are not read.
    df = df.select(*rows.columns, F.inline(F.array(F.struct(clase.alias("clase"), F.col("_v").alias("_v")))))
    object_ = F.when(F.col("clase") == VALID, F.col("_v"))
    valor = F.try_variant_get(object_, "$.valor", "variant")

    def field(name: str, default: str) -> Column:
        return F.when(F.col("clase") == VALID, F.coalesce(F.try_variant_get("_v", f"$.{name}", "string"), F.lit(default)))

    listed = F.schema_of_variant(valor).startswith("ARRAY")
    return df.select(
        *rows.columns,
        "clase",
        field("accion", "").alias("accion"),
        field("parametro", "").alias("parametro"),
        F.try_variant_get(object_, "$.valor", "string").alias("valor_texto"),
        as_integer(valor).alias("valor_entero"),
        F.when(listed, F.coalesce(F.try_variant_get(object_, "$.valor", "array<string>"), F.array().cast("array<string>"))).alias("valor_lista"),
        field("razon", "Sin razón").alias("razon"),
    )


def rule_fallback(few_organisers: int = 20, many_events: int = 50) -> tuple[Column, Column, Column]:
    """accion, parametro and valor that replace an unparseable proposal, from the metrics."""
    few = F.col("organizadores") < few_organisers
    return (
        F.when(few & (F.col("eventos") > many_events), "ENRIQUECER_EVENTOS").otherwise("AUMENTAR_BUSQUEDAS"),
        F.when(few, "organizadores").otherwise("busquedas_facebook"),
        F.when(few, "true").otherwise("80"),
    )


def append_distinct(current: Column, new: Column) -> Column:
    """``new`` elements appended to ``current`` in order, each once; null lists are empty."""
    empty = F.array().cast("array<string>")
    return F.array_union(F.coalesce(current, empty), F.coalesce(new, empty))


PROMPT = (
    "Última medición: eventos=%d, fuentes=%d, organizadores=%d, emails=%d, score=%d.\n"
    "Contesta con un objeto JSON de cuatro claves: accion, parametro, valor, razon."
)


def prompt() -> Column:
    """A request for one proposal, with the five metrics."""
    return F.format_string(PROMPT, "eventos", "fuentes", "organizadores", "emails", "score")


#: What a request adds where a metric asks for it.
ADVICE = {
    "enrich": "Hay muchos eventos con pocos organizadores: conviene enriquecer los eventos.",
    "sources": "Las fuentes son pocas: conviene añadir otras.",
    "limits": "El score es bajo: conviene subir max_eventos o busquedas_facebook.",
}


def advice(low_score: int, few_organisers: int = 20, many_events: int = 50, few_sources: int = 5) -> Column:
    """The advice that the five metrics ask for, one line each; empty if there is none."""
    c = F.col
    applies = {"enrich": (c("organizadores") < few_organisers) & (c("eventos") > many_events), "sources": c("fuentes") < few_sources, "limits": c("score") < low_score}
    return F.concat_ws("\n", *[F.when(holds, ADVICE[name]) for name, holds in applies.items()])


def summary() -> Column:
    """One line of text for the metrics of an iteration."""
    parts = [F.concat(F.lit(f"{name}: "), F.col(name).cast("string")) for name in ("eventos", "organizadores", "emails", "fuentes", "score")]
    return F.concat_ws(" | ", *parts)
