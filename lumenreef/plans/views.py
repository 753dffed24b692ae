"""Views that give the driver's tables the shape of catalogs, iterations and proposals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenreef.functions import policy
from lumenreef.operators import contacts, kpi


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source() -> Column:
    """The source of a page: the host of its url."""
    return F.nullif(F.regexp_extract("url", r"https?://([^/?#]+)", 1), F.lit("")).alias("fuente")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, fuente, organizador, email`` from pages; a third of the organisers left out."""
    pages = table(spark, sf_dir, "pages")
    keyed = pages.select(F.struct(F.col("page_id").alias("event_id"), source()).alias("key"), "html")
    blanked = F.when(F.col("event_id") % 3 != 0, F.col("organizador")).alias("organizador")
    return contacts.first_contacts(keyed, "key", "html").select("key.*", "organizador", "email").select("event_id", "fuente", blanked, "email")


CATALOG = r"""cat AS (
  SELECT page_id AS event_id, nullif(regexp_extract(url, 'https?://([^/?#]+)', 1), '') AS fuente,
         CASE WHEN page_id % 3 <> 0 THEN nullif(regexp_extract(html, '&copy; *([^ <]+) ', 1), '') END AS organizador,
         nullif(regexp_extract(html, '([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,})', 1), '') AS email
  FROM pages)"""


def iterations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of each run and iteration: users are runs, days iterations."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.day("ts").cast("bigint").alias("iteracion"),
        F.col("event_type").alias("fuente"),
        F.when(F.col("event_type") == "signup", "x").alias("organizador"),
        F.when(F.col("event_type") == "purchase", "x").alias("email"),
    )
    return kpi.catalog_kpi(events, ["run_id", "iteracion"])


ITERATIONS = """it AS (
  SELECT *, eventos + organizadores * 2 + emails * 3 + fuentes * 10 AS score FROM (
    SELECT user_id AS run_id, day(ts)::BIGINT AS iteracion, count(*) AS eventos,
           count(DISTINCT event_type) AS fuentes, count(*) FILTER (event_type = 'signup') AS organizadores,
           count(*) FILTER (event_type = 'purchase') AS emails
    FROM events GROUP BY ALL))"""

#: The text of a proposal, in words that Spark SQL and DuckDB read alike.
_K = "cast(regexp_extract(props, '([0-9]+)', 1) AS bigint)"
_TEXT = f"""CASE event_id % 8
  WHEN 0 THEN 'propongo {{"accion":"AUMENTAR_BUSQUEDAS","parametro":"busquedas_facebook","valor":"' || {_K} || '","razon":"r"}} fin'
  WHEN 1 THEN '{{"accion":"AUMENTAR_MAX_EVENTOS","parametro":"max_eventos","valor":' || {_K} || '.7}}'
  WHEN 2 THEN '{{"accion":"AUMENTAR_TIMEOUT","parametro":"timeout","valor":"x' || {_K} || '"}}'
  WHEN 3 THEN '{{"accion":"AGREGAR_PAISES","parametro":"p","valor":["P' || {_K} % 5 || '","P' || {_K} % 3 || '"],"razon":"q"}}'
  WHEN 4 THEN CASE WHEN {_K} % 5 = 0 THEN '{{"accion":"AGREGAR_PAISES","parametro":"p","valor":"ES"}}' ELSE '{{"accion":"OTRA","valor":{{"k":1}}}}' END
  WHEN 5 THEN CASE WHEN {_K} % 2 = 0 THEN '{{}}' ELSE '[1,' || {_K} || ']' END
  WHEN 6 THEN 'ninguna ' || {_K}
  ELSE '{{"accion":"ENRIQUECER_EVENTOS","parametro":"organizadores","valor":true,"razon":"z"}}' END"""


def raw_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, run_id, respuesta, eventos, organizadores``: a proposal for every event."""
    events = table(spark, sf_dir, "events")
    return events.selectExpr(
        "event_id", "user_id AS run_id", f"{_TEXT} AS respuesta", f"{_K} AS eventos", f"{_K} % 40 AS organizadores"
    )


RAW = f"SELECT event_id, user_id AS run_id, {_TEXT} AS respuesta, {_K} AS eventos, {_K} % 40 AS organizadores FROM events"

#: The fields of the proposals in ``raw``.
PARSED = """spans AS (
  SELECT *, coalesce(nullif(regexp_extract(respuesta, '(?s)\\{.*\\}'), ''), respuesta) AS span FROM raw
), prop AS (
  SELECT *, CASE WHEN respuesta IS NULL THEN 'EMPTY' WHEN NOT json_valid(span) THEN 'UNPARSEABLE' WHEN span = '{}' THEN 'EMPTY'
                 WHEN json_type(span) = 'OBJECT' THEN 'VALID' ELSE 'NON_OBJECT' END AS clase
  FROM spans
), parsed AS (
  SELECT *, CASE WHEN clase = 'VALID' THEN coalesce(json_extract_string(span, '$.accion'), '') END AS accion,
         CASE WHEN clase = 'VALID' THEN coalesce(json_extract_string(span, '$.parametro'), '') END AS parametro,
         CASE WHEN clase = 'VALID' THEN coalesce(json_extract_string(span, '$.razon'), 'Sin razón') END AS razon,
         CASE WHEN clase = 'VALID' THEN json_type(span, '$.valor') END AS vt,
         CASE WHEN clase = 'VALID' THEN json_extract_string(span, '$.valor') END AS vs
  FROM prop
), typed AS (
  SELECT *, CASE WHEN vt = 'BOOLEAN' THEN CASE WHEN vs = 'true' THEN 1 ELSE 0 END
                 WHEN vt IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN trunc(try_cast(vs AS DOUBLE))::BIGINT
                 WHEN vt = 'VARCHAR' AND regexp_full_match(vs, '\\s*[+-]?[0-9]+(_[0-9]+)*\\s*')
                   THEN try_cast(replace(trim(vs), '_', '') AS BIGINT) END::BIGINT AS valor_entero,
         CASE WHEN vt = 'ARRAY' THEN from_json(json_extract(span, '$.valor'), '["VARCHAR"]') END AS valor_lista
  FROM parsed)"""
PROPOSALS = f"raw AS ({RAW}), {PARSED}"


def proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All proposals in order; each 15 of a user are a run (``run_id`` is the pair of user and ``ciclo``)."""
    return policy.numbered(raw_proposals(spark, sf_dir), "event_id")


#: Runs of 15 from a number ``n`` that counts from 1 in each user.
CYCLE = "{'run_id': run_id, 'ciclo': (n - 1) // 15}"
NUMBERED = f"""looped AS (
  SELECT * REPLACE ({CYCLE} AS run_id), (n - 1) % 15 + 1 AS iteracion
  FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY event_id) AS n FROM typed))"""
#: The fold as a recursive query over the steps of each run in ``looped``.
FOLD = """steps AS (
  SELECT run_id, iteracion, clase, valor_lista, clase = 'EMPTY' AS plain,
         CASE WHEN clase = 'UNPARSEABLE' THEN CASE WHEN organizadores < 20 AND eventos > 50 THEN 'ENRIQUECER_EVENTOS' ELSE 'AUMENTAR_BUSQUEDAS' END ELSE coalesce(accion, '') END AS accion,
         CASE WHEN clase = 'UNPARSEABLE' THEN CASE WHEN organizadores < 20 THEN 'organizadores' ELSE 'busquedas_facebook' END ELSE coalesce(parametro, '') END AS parametro,
         CASE WHEN clase = 'UNPARSEABLE' THEN CASE WHEN organizadores >= 20 THEN 80 END ELSE valor_entero END AS n
  FROM looped
), named AS (
  SELECT *, CASE WHEN clase = 'NON_OBJECT' THEN 'none' WHEN plain THEN 'other'
                 WHEN accion = 'AUMENTAR_BUSQUEDAS' AND parametro = 'busquedas_facebook' THEN 'searches'
                 WHEN accion = 'AUMENTAR_MAX_EVENTOS' AND parametro = 'max_eventos' THEN 'events'
                 WHEN accion = 'AUMENTAR_TIMEOUT' AND parametro = 'timeout' THEN 'timeout'
                 WHEN accion = 'AGREGAR_PAISES' THEN 'countries' ELSE 'other' END AS what
  FROM steps
), fold AS (
  SELECT run_id, 1::BIGINT AS iteracion, 100::BIGINT AS max_eventos, 50::BIGINT AS busquedas_facebook, 20::BIGINT AS timeout, []::VARCHAR[] AS paises
  FROM (SELECT DISTINCT run_id FROM named)
  UNION ALL
  SELECT f.run_id, f.iteracion + 1,
         CASE WHEN what = 'events' THEN coalesce(n, least(max_eventos + 50, 300)) ELSE max_eventos END,
         CASE WHEN what = 'searches' THEN coalesce(n, least(busquedas_facebook + 30, 300)) WHEN what = 'other' THEN least(busquedas_facebook + 30, 300) ELSE busquedas_facebook END,
         CASE WHEN what = 'timeout' THEN coalesce(n, least(timeout + 5, 60)) ELSE timeout END,
         CASE WHEN what <> 'countries' THEN paises
              WHEN valor_lista IS NULL THEN ['España', 'Portugal', 'Alemania', 'Francia', 'Italia', 'Holanda']
              ELSE list_concat(paises, list_filter(list_filter(valor_lista, lambda x, i: list_position(valor_lista, x) = i), lambda x: NOT list_contains(paises, x))) END
  FROM fold f JOIN named s ON s.run_id = f.run_id AND s.iteracion = f.iteracion
), traj AS (
  SELECT f.run_id, f.iteracion, max_eventos, busquedas_facebook, timeout, array_to_string(paises, ',') AS paises
  FROM fold f SEMI JOIN named s ON s.run_id = f.run_id AND s.iteracion = f.iteracion
), final AS (
  SELECT run_id, max_eventos, busquedas_facebook, timeout, array_to_string(paises, ',') AS paises
  FROM fold QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY iteracion DESC) = 1)"""
TRAJECTORY = f"{PROPOSALS}, {NUMBERED}, {FOLD}"
#: ``it`` with the runs of ``looped``: days are the numbers.
LOOPED_ITERATIONS = f"{ITERATIONS}, cycles AS (SELECT * REPLACE ({CYCLE} AS run_id, (n - 1) % 15 + 1 AS iteracion) FROM (SELECT *, iteracion AS n FROM it))"


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``iterations`` where every eleventh could not be measured: its metrics are null."""
    rows = iterations(spark, sf_dir)
    return rows.select("run_id", "iteracion", *[F.when(F.col("iteracion") % 11 != 0, F.col(c)).alias(c) for c in kpi.METRIC_COLUMNS])
