"""Experiment history and configuration records as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONFIG = (
    "max_eventos bigint, busquedas_facebook bigint, timeout bigint, priorizar_paises array<string>,"
    " extraer_contactos boolean, agregar_fuentes array<string>, profundidad_busqueda bigint, buscar_en_grupos boolean"
)
METRICS = "eventos bigint, fuentes bigint, organizadores bigint, emails bigint, score bigint"
HISTORY = f"run_id bigint, iteracion bigint, config struct<{CONFIG.replace(' bigint', ':bigint').replace(' array', ':array').replace(' boolean', ':boolean')}>, metricas struct<{METRICS.replace(' bigint', ':bigint')}>"


def write_history(df: DataFrame, path: str) -> None:
    """Append history rows, one JSON record a line, null fields kept."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def read_history(spark: SparkSession, path: str, whole_array: bool = False) -> DataFrame:
    """History rows; ``whole_array`` for a file that is one JSON array."""
    reader = spark.read.schema(HISTORY)
    return (reader.option("multiLine", "true") if whole_array else reader).json(path)


def as_json(record: Column) -> Column:
    """A struct as JSON text, null fields kept."""
    return F.to_json(record, {"ignoreNullFields": "false"})
