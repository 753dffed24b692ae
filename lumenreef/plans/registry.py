"""Queries of the catalog and experiment operators, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenreef.functions import policy, proposals
from lumenreef.operators import contacts, frequent_sets, history, kpi, markup, rollup, runs
from lumenreef.plans import views
from lumenreef.session import configure, shared_path
from lumenreef.sources import catalog as catalogs
from lumenreef.sources import history as histories
from lumenreef.sources import versions
from lumenreef.streaming import history as history_streams
from lumenreef.streaming import kpi as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Thresholds for the small runs of the test tables.
GOAL_EVENTS, GOAL_ORGANISERS = 4, 2
FEW_ORGANISERS, MANY_EVENTS = 1, 2
LOW_SCORE = 30
STAGNANT_AFTER = 5
ITERATIONS = 15


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = wraps(f)(lambda spark, sf_dir: f(configure(spark), sf_dir))
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


_KPI = """count(*) AS eventos, count(DISTINCT fuente) AS fuentes, count(organizador) AS organizadores, count(email) AS emails"""
_SCORED = "SELECT *, eventos + organizadores * 2 + emails * 3 + fuentes * 10 AS score FROM"


@query(f"WITH {views.CATALOG} {_SCORED} (SELECT {_KPI} FROM cat)")
def catalog_kpi(spark, sf_dir):
    return kpi.catalog_kpi(views.catalog(spark, sf_dir))


@query(f"WITH {views.CATALOG} {_SCORED} (SELECT count(*) AS eventos, count(DISTINCT fuente) AS fuentes, count(organizador) AS organizadores, 0::BIGINT AS emails FROM cat)")
def kpi_missing_column(spark, sf_dir):
    return kpi.catalog_kpi(views.catalog(spark, sf_dir).drop("email"))


@query(f"WITH {views.CATALOG} {_SCORED} (SELECT fuente, {_KPI} FROM cat GROUP BY fuente)")
def kpi_by_source(spark, sf_dir):
    return kpi.catalog_kpi(views.catalog(spark, sf_dir), ["fuente"])


@query(f"WITH {views.ITERATIONS} SELECT run_id, iteracion, eventos, fuentes, organizadores, emails, score FROM it")
def kpi_by_iteration(spark, sf_dir):
    return views.iterations(spark, sf_dir)


@query(f"WITH {views.ITERATIONS} SELECT run_id, iteracion, organizadores < {FEW_ORGANISERS} AND eventos > {MANY_EVENTS} AS needs FROM it")
def needs_enrichment(spark, sf_dir):
    return views.iterations(spark, sf_dir).select("run_id", "iteracion", kpi.needs_enrichment(FEW_ORGANISERS, MANY_EVENTS).alias("needs"))


@query(f"WITH {views.ITERATIONS} SELECT run_id, iteracion, eventos, organizadores FROM it WHERE eventos >= {GOAL_EVENTS} AND organizadores >= {GOAL_ORGANISERS}")
def goal_reached(spark, sf_dir):
    rows = views.iterations(spark, sf_dir).where(kpi.goal_reached(GOAL_EVENTS, GOAL_ORGANISERS))
    return rows.select("run_id", "iteracion", "eventos", "organizadores")


@query(f"""WITH {views.ITERATIONS} SELECT run_id, iteracion, concat_ws(',',
  CASE WHEN organizadores < {FEW_ORGANISERS} AND eventos > {MANY_EVENTS} THEN 'enrich_events' END,
  CASE WHEN fuentes < 5 THEN 'add_sources' END, CASE WHEN score < {LOW_SCORE} THEN 'raise_limits' END) AS advice FROM it""")
def advice_flags(spark, sf_dir):
    advice = kpi.advice(LOW_SCORE, MANY_EVENTS, FEW_ORGANISERS).alias("advice")
    return views.iterations(spark, sf_dir).select("run_id", "iteracion", advice)


_BEST = """best AS (SELECT *, score > greatest(coalesce(max(score) OVER (PARTITION BY run_id ORDER BY iteracion
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS new_best FROM it)"""


@query(f"WITH {views.ITERATIONS}, {_BEST} SELECT run_id, iteracion, score FROM best WHERE new_best")
def new_best(spark, sf_dir):
    return history.mark_new_best(views.iterations(spark, sf_dir)).where("new_best").select("run_id", "iteracion", "score")


def _with_config(spark, sf_dir) -> DataFrame:
    """Iteration metrics with the configuration used, where the run has one."""
    used = policy.trajectory(views.proposals(spark, sf_dir), levels=1)
    used = used.withColumn("paises", F.array_join("priorizar_paises", ",")).drop("priorizar_paises")
    return policy.looped(views.iterations(spark, sf_dir)).join(used, ["run_id", "iteracion"])


#: A run in the results: user and pass of the loop.
_RUN = "run_id.run_id AS run_id, run_id.ciclo AS ciclo"
_JOINED = f"{views.TRAJECTORY}, {views.LOOPED_ITERATIONS}, both_ AS (SELECT * FROM cycles JOIN traj USING (run_id, iteracion))"


@query(f"""WITH RECURSIVE {_JOINED} SELECT {_RUN}, iteracion, score, max_eventos, busquedas_facebook, timeout, paises FROM both_
  WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY score DESC, iteracion) = 1""")
def best_config(spark, sf_dir):
    best = history.best_row(_with_config(spark, sf_dir), "max_eventos", "busquedas_facebook", "timeout", "paises")
    return best.select("run_id.*", "score", "iteracion", "max_eventos", "busquedas_facebook", "timeout", "paises")


@query(f"""WITH {views.ITERATIONS}, m AS (SELECT *,
    min(CASE WHEN eventos >= {GOAL_EVENTS} AND organizadores >= {GOAL_ORGANISERS} THEN iteracion END) OVER (PARTITION BY run_id) AS g,
    min(CASE WHEN eventos = 1 AND emails = 1 THEN iteracion END) OVER (PARTITION BY run_id) AS f
  FROM it WHERE iteracion <= {ITERATIONS})
SELECT run_id, iteracion, score FROM m WHERE (g IS NULL OR iteracion <= g) AND (f IS NULL OR iteracion < f)""")
def history_until_stop(spark, sf_dir):
    failed = (F.col("eventos") == 1) & (F.col("emails") == 1)  # stands for an iteration that could not be measured
    kept = history.until_stop(views.iterations(spark, sf_dir), kpi.goal_reached(GOAL_EVENTS, GOAL_ORGANISERS), failed, ITERATIONS)
    return kept.select("run_id", "iteracion", "score")


@query(f"""WITH RECURSIVE {views.TRAJECTORY} SELECT {_RUN}, iteracion, max_eventos, busquedas_facebook, timeout, paises FROM (
  SELECT *, lag(struct_pack(a := max_eventos, b := busquedas_facebook, c := timeout, d := paises)) OVER w AS p,
         struct_pack(a := max_eventos, b := busquedas_facebook, c := timeout, d := paises) AS q, row_number() OVER w AS n
  FROM traj WINDOW w AS (PARTITION BY run_id ORDER BY iteracion)) WHERE n > 1 AND q IS DISTINCT FROM p""")
def config_changes(spark, sf_dir):
    used = policy.trajectory(views.proposals(spark, sf_dir), levels=1).withColumn("paises", F.array_join("priorizar_paises", ","))
    marked = history.mark_changes(used, "max_eventos", "busquedas_facebook", "timeout", "paises").where("changed")
    return marked.select("run_id.*", "iteracion", "max_eventos", "busquedas_facebook", "timeout", "paises")


_STAGNATION = f"""{views.ITERATIONS}, {_BEST}, since AS (SELECT *, iteracion - coalesce(last_value(CASE WHEN new_best THEN iteracion END IGNORE NULLS)
  OVER (PARTITION BY run_id ORDER BY iteracion ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS since_best FROM best)"""


@query(f"WITH {_STAGNATION} SELECT run_id, iteracion, since_best, since_best >= {STAGNANT_AFTER} AS stagnant FROM since")
def stagnation(spark, sf_dir):
    marked = history.mark_stagnation(views.iterations(spark, sf_dir))
    return marked.select("run_id", "iteracion", "since_best", (F.col("since_best") >= STAGNANT_AFTER).alias("stagnant"))


@query(f"""WITH RECURSIVE {_JOINED} SELECT max_eventos, busquedas_facebook, timeout, paises, count(*) AS n, avg(score) AS avg_score,
  min(score) AS min_score, max(score) AS max_score FROM both_ GROUP BY ALL""")
def score_by_config(spark, sf_dir):
    return history.score_by_config(_with_config(spark, sf_dir), "max_eventos", "busquedas_facebook", "timeout", "paises")


@query(f"WITH {views.PROPOSALS} SELECT event_id, span FROM prop")
def extract_json_span(spark, sf_dir):
    return views.raw_proposals(spark, sf_dir).select("event_id", proposals.json_span(F.col("respuesta")).alias("span"))


@query(f"WITH {views.PROPOSALS} SELECT event_id, accion, parametro, razon, array_to_string(valor_lista, ',') AS valor_lista FROM typed")
def parse_proposal(spark, sf_dir):
    parsed = proposals.parse_proposals(views.raw_proposals(spark, sf_dir))
    return parsed.select("event_id", "accion", "parametro", "razon", F.array_join("valor_lista", ",").alias("valor_lista"))


@query(f"WITH {views.PROPOSALS} SELECT event_id, valor_entero FROM typed")
def parse_int_value(spark, sf_dir):
    return proposals.parse_proposals(views.raw_proposals(spark, sf_dir)).select("event_id", "valor_entero")


@query(f"WITH {views.PROPOSALS} SELECT event_id, clase FROM prop")
def classify_proposal(spark, sf_dir):
    return proposals.parse_proposals(views.raw_proposals(spark, sf_dir)).select("event_id", "clase")


@query(f"WITH {views.PROPOSALS} SELECT event_id, run_id, respuesta FROM prop WHERE clase = 'NON_OBJECT'")
def proposal_rejects(spark, sf_dir):
    parsed = proposals.parse_proposals(views.raw_proposals(spark, sf_dir))
    return parsed.where(F.col("clase") == proposals.NON_OBJECT).select("event_id", "run_id", "respuesta")


@query(f"""WITH {views.ITERATIONS} SELECT run_id, iteracion,
  CASE WHEN organizadores < {FEW_ORGANISERS} AND eventos > {MANY_EVENTS} THEN 'ENRIQUECER_EVENTOS' ELSE 'AUMENTAR_BUSQUEDAS' END AS accion,
  CASE WHEN organizadores < {FEW_ORGANISERS} THEN 'organizadores' ELSE 'busquedas_facebook' END AS parametro,
  CASE WHEN organizadores < {FEW_ORGANISERS} THEN 'true' ELSE '80' END AS valor FROM it""")
def rule_fallback(spark, sf_dir):
    action, parameter, value = proposals.rule_fallback(FEW_ORGANISERS, MANY_EVENTS)
    rows = views.iterations(spark, sf_dir)
    return rows.select("run_id", "iteracion", action.alias("accion"), parameter.alias("parametro"), value.alias("valor"))


@query(f"WITH RECURSIVE {views.TRAJECTORY} SELECT {_RUN}, max_eventos, busquedas_facebook, timeout, paises FROM final WHERE run_id IN (SELECT run_id FROM named WHERE what <> 'none')")
def config_fold(spark, sf_dir):
    last = policy.fold(views.proposals(spark, sf_dir), levels=1)
    return last.select("run_id.*", "max_eventos", "busquedas_facebook", "timeout", F.array_join("priorizar_paises", ",").alias("paises"))


#: All proposals of a user as one run, in the order of their ids.
_LONG = f"{views.PROPOSALS}, looped AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY event_id) AS iteracion FROM typed), {views.FOLD}"
_NUMBERS = "max_eventos, busquedas_facebook, timeout, paises"
_LONG_TRAJECTORY = f"WITH RECURSIVE {_LONG} SELECT run_id, event_id, {_NUMBERS} FROM traj JOIN looped USING (run_id, iteracion)"


def _long_runs(spark, sf_dir) -> DataFrame:
    return views.raw_proposals(spark, sf_dir).withColumnRenamed("event_id", "iteracion")


def _shown(df: DataFrame, *key: str) -> DataFrame:
    return df.select(*key, "max_eventos", "busquedas_facebook", "timeout", F.array_join("priorizar_paises", ",").alias("paises"))


@query(f"WITH RECURSIVE {_LONG} SELECT run_id, {_NUMBERS} FROM final WHERE run_id IN (SELECT run_id FROM named WHERE what <> 'none')")
def fold_long_runs(spark, sf_dir):
    """Runs of any length as a tree of aggregates, without numbering their steps."""
    return _shown(policy.fold(_long_runs(spark, sf_dir)), "run_id")


@query(_LONG_TRAJECTORY)
def trajectory_long_runs(spark, sf_dir):
    return _shown(policy.trajectory(_long_runs(spark, sf_dir)).withColumnRenamed("iteracion", "event_id"), "run_id", "event_id")


#: Measured iterations up to each run's stop with their proposals, parsed and folded.
_STOPPED = f"""{views.LOOPED_ITERATIONS}, hist AS (SELECT run_id, iteracion, CASE WHEN n % 11 <> 0 THEN eventos END AS eventos,
  CASE WHEN n % 11 <> 0 THEN organizadores END AS organizadores, score FROM cycles
), stops AS (SELECT *, min(CASE WHEN eventos >= {GOAL_EVENTS} AND organizadores >= {GOAL_ORGANISERS} THEN iteracion END) OVER (PARTITION BY run_id) AS g,
  min(CASE WHEN eventos IS NULL THEN iteracion END) OVER (PARTITION BY run_id) AS f FROM hist
), answers AS (SELECT {views.CYCLE} AS run_id, (n - 1) % 15 + 1 AS iteracion, respuesta
  FROM (SELECT run_id, respuesta, row_number() OVER (PARTITION BY run_id ORDER BY event_id) AS n FROM ({views.RAW}))
), raw AS (SELECT iteracion AS event_id, run_id, respuesta, eventos, organizadores, score FROM stops LEFT JOIN answers USING (run_id, iteracion)
  WHERE (g IS NULL OR iteracion <= g) AND (f IS NULL OR iteracion < f)
), {views.PARSED}, looped AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY event_id) AS iteracion FROM typed), {views.FOLD}"""


@query(f"""WITH RECURSIVE {_STOPPED}
SELECT {_RUN}, max_eventos, busquedas_facebook, timeout, paises FROM final WHERE run_id IN (SELECT run_id FROM named WHERE what <> 'none')""")
def fold_history(spark, sf_dir):
    """The proposals of each measured iteration up to the run's stop, folded; a missing one is empty."""
    goal = kpi.goal_reached(GOAL_EVENTS, GOAL_ORGANISERS)
    kept = history.until_stop(policy.looped(views.measured(spark, sf_dir)), goal, F.col("eventos").isNull(), ITERATIONS)
    last = policy.fold(history.with_proposals(kept, views.proposals(spark, sf_dir)), levels=1)
    return last.select("run_id.*", "max_eventos", "busquedas_facebook", "timeout", F.array_join("priorizar_paises", ",").alias("paises"))


@query(f"""WITH RECURSIVE {_STOPPED}
SELECT {_RUN}, score, event_id AS iteracion, max_eventos, busquedas_facebook, timeout, paises FROM traj JOIN (SELECT run_id, iteracion, event_id, score FROM looped) USING (run_id, iteracion)
WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY score DESC, event_id) = 1""")
def run_results(spark, sf_dir):
    """What the loop returns: the best configuration of each run before its stop, where missing proposals are empty ones."""
    goal = kpi.goal_reached(GOAL_EVENTS, GOAL_ORGANISERS)
    best = runs.run_results(policy.looped(views.measured(spark, sf_dir)), views.proposals(spark, sf_dir), goal, F.col("eventos").isNull(), ITERATIONS)
    return _shown(best.select("run_id.*", "score", "iteracion", *policy.NUMBERS, "priorizar_paises"), "run_id", "ciclo", "score", "iteracion")


@query(f"WITH RECURSIVE {views.TRAJECTORY} SELECT {_RUN}, iteracion, max_eventos, busquedas_facebook, timeout, paises FROM traj")
def config_trajectory(spark, sf_dir):
    used = policy.trajectory(views.proposals(spark, sf_dir), levels=1)
    return used.select("run_id.*", "iteracion", "max_eventos", "busquedas_facebook", "timeout", F.array_join("priorizar_paises", ",").alias("paises"))


@query(f"""WITH {views.PROPOSALS} SELECT event_id, array_to_string(list_concat(['P0', 'P9'], list_filter(list_filter(valor_lista,
  lambda x, i: list_position(valor_lista, x) = i), lambda x: NOT list_contains(['P0', 'P9'], x))), ',') AS paises FROM typed WHERE valor_lista IS NOT NULL""")
def array_append_distinct(spark, sf_dir):
    parsed = proposals.parse_proposals(views.raw_proposals(spark, sf_dir)).where("valor_lista IS NOT NULL")
    merged = proposals.append_distinct(F.array(F.lit("P0"), F.lit("P9")), F.col("valor_lista"))
    return parsed.select("event_id", F.array_join(merged, ",").alias("paises"))


@query(f"""WITH RECURSIVE {views.TRAJECTORY} SELECT {_RUN}, iteracion, concat_ws(',', CASE WHEN max_eventos NOT BETWEEN 100 AND 300 THEN 'max_eventos' END,
  CASE WHEN busquedas_facebook NOT BETWEEN 50 AND 300 THEN 'busquedas_facebook' END,
  CASE WHEN timeout NOT BETWEEN 20 AND 60 THEN 'timeout' END) AS fuera FROM traj""")
def config_range_check(spark, sf_dir):
    return policy.trajectory(views.proposals(spark, sf_dir), levels=1).select("run_id.*", "iteracion", policy.range_violations().alias("fuera"))


@query(f"""WITH {_STAGNATION} SELECT run_id, iteracion, concat_ws(',',
  CASE WHEN eventos < 2 THEN 'raise_searches+add_countries+enable_contacts' END,
  CASE WHEN eventos > {MANY_EVENTS} AND organizadores < {FEW_ORGANISERS} THEN 'improve_extraction+search_groups' END,
  CASE WHEN since_best >= {STAGNANT_AFTER} THEN 'change_strategy+vary_countries+lower_searches+raise_timeout' END) AS strategy FROM since""")
def strategy_advice(spark, sf_dir):
    marked = history.mark_stagnation(views.iterations(spark, sf_dir))
    advice = kpi.strategy(2, MANY_EVENTS, FEW_ORGANISERS, F.col("since_best") >= STAGNANT_AFTER)
    return marked.select("run_id", "iteracion", advice.alias("strategy"))


@query("""WITH e(source) AS (VALUES ('Goabase'), ('Facebook'), ('Instagram'), ('Songkick'), ('Eventbrite'), ('src0')),
  n AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source)
SELECT source, coalesce(n, 0) AS n, e.source IS NOT NULL AS expected FROM n FULL JOIN e USING (source)""")
def source_coverage(spark, sf_dir):
    return kpi.source_coverage(views.table(spark, sf_dir, "documents"), "source", (*kpi.KNOWN_SOURCES, "src0"))


@query(r"""SELECT 'page' AS kind, page_id AS id, unnest(regexp_extract_all(html, '([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,})')) AS email FROM pages
UNION ALL
SELECT 'document', doc_id, unnest(regexp_extract_all(text, '([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,})')) FROM documents""")
def extract_contacts(spark, sf_dir):
    pages = contacts.emails_in(views.table(spark, sf_dir, "pages"), "page_id", "html")
    docs = contacts.emails_in(views.table(spark, sf_dir, "documents"), "doc_id", "text")
    return pages.select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), "email").unionByName(
        docs.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "email")
    )


_CONTACTS = r"""con AS (SELECT page_id AS event_id, nullif(regexp_extract(html, '&copy; *([^ <]+) ', 1), '') AS organizador,
  nullif(regexp_extract(html, '([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,})', 1), '') AS email FROM pages)"""


def _contacts(spark, sf_dir) -> DataFrame:
    pages = views.table(spark, sf_dir, "pages").withColumnRenamed("page_id", "event_id")
    return contacts.first_contacts(pages, "event_id", "html")


@query(f"""WITH {views.CATALOG}, {_CONTACTS} SELECT event_id, fuente, coalesce(cat.organizador, con.organizador) AS organizador,
  coalesce(cat.email, con.email) AS email FROM cat LEFT JOIN con USING (event_id)""")
def fill_contacts(spark, sf_dir):
    return contacts.fill_contacts(views.catalog(spark, sf_dir), _contacts(spark, sf_dir))


@query(f"""WITH {views.CATALOG}, {_CONTACTS}, runs AS (SELECT *, event_id % 7 AS run_id FROM cat),
before AS (SELECT run_id, {_KPI} FROM runs GROUP BY run_id),
filled AS (SELECT run_id, fuente, CASE WHEN b.organizadores < 20 AND b.eventos > 20 THEN coalesce(r.organizador, con.organizador) ELSE r.organizador END AS organizador,
  CASE WHEN b.organizadores < 20 AND b.eventos > 20 THEN coalesce(r.email, con.email) ELSE r.email END AS email,
  b.organizadores < 20 AND b.eventos > 20 AS enriched FROM runs r JOIN before b USING (run_id) LEFT JOIN con USING (event_id))
{_SCORED} (SELECT run_id, enriched, {_KPI} FROM filled GROUP BY run_id, enriched)""")
def enrich_then_kpi(spark, sf_dir):
    """Own and new values come from one look at each page, and one pass over the rows."""
    return rollup.enriched_kpis(_with_news(spark, sf_dir), "run_id", 20, 20)


def _with_news(spark, sf_dir) -> DataFrame:
    """The catalog of seven runs with the contacts of each page as ``nuevo_organizador`` and ``nuevo_email``."""
    pages = views.table(spark, sf_dir, "pages")
    own = F.struct(F.col("page_id").alias("event_id"), views.source(), (F.col("page_id") % 7).alias("run_id"))
    rows = contacts.first_contacts(pages.select(own.alias("key"), "html"), "key", "html").select("key.*", "organizador", "email")
    blanked = F.when(F.col("event_id") % 3 != 0, F.col("organizador")).alias("organizador")
    return rows.select("run_id", "event_id", "fuente", blanked, "email", F.col("organizador").alias("nuevo_organizador"), F.col("email").alias("nuevo_email"))


@query(ORACLE["enrich_then_kpi"])
def enrich_by_version(spark, sf_dir):
    """The catalog as a versioned table: measured, filled where a run needs it, committed as the next version and measured again."""
    root = shared_path(spark, "catalog")
    catalog = views.catalog(spark, sf_dir).withColumn("run_id", F.col("event_id") % 7)
    first = versions.commit(catalog, root, versions.current_version(spark, root))
    contacts.enrich_version(spark, root, _contacts(spark, sf_dir), "run_id", 20, 20)
    before = kpi.catalog_kpi(versions.read(spark, root, first), ["run_id"]).select("run_id", kpi.needs_enrichment(20, 20).alias("enriched"))
    return kpi.catalog_kpi(versions.read(spark, root), ["run_id"]).join(before, "run_id")


@query(ORACLE["enrich_then_kpi"])
def enrich_by_delta(spark, sf_dir):
    """Counts by source are stored; of the runs that need it the filled rows change them, and nothing else is counted again."""
    rows = _with_news(spark, sf_dir)
    path = shared_path(spark, "parts")
    rollup.by_source(rows, ["run_id"]).write.parquet(path)
    parts = spark.read.parquet(path)
    before = rollup.kpis(parts, ["run_id"]).select("run_id", kpi.needs_enrichment(20, 20).alias("enriched"))
    news = {c: F.when(F.col(c).isNull(), F.col(f"nuevo_{c}")) for c in ("organizador", "email")}
    poor = rows.withColumns(news).join(before.where("enriched"), "run_id", "left_semi")
    return rollup.kpis(rollup.merged(parts, rollup.filled(poor, ["run_id"]), by=["run_id"]), ["run_id"]).join(before, "run_id")


@query(f"WITH {views.CATALOG} {_SCORED} (SELECT event_id % 7 AS run_id, {_KPI} FROM cat GROUP BY 1)")
def kpi_rollup(spark, sf_dir):
    """Sketches by run and day are stored and merged into those of runs; so few sources are estimated exactly."""
    catalog = views.catalog(spark, sf_dir).withColumns({"run_id": F.col("event_id") % 7, "dia": F.col("event_id") % 30})
    path = shared_path(spark, "sketches")
    rollup.sketched(catalog, ["run_id", "dia"]).write.parquet(path)
    return rollup.estimated(rollup.rolled_up(spark.read.parquet(path), ["run_id"]))


_MARKED = r"""regexp_replace(regexp_replace(html, '(?s)<(script|style).*?</(script|style)>', '', 'g'), '<!--.*?-->', '', 'g')"""


@query(rf"""WITH p AS (SELECT page_id, {_MARKED} AS html, nullif(regexp_extract(url, 'https?://([a-z0-9.-]+)', 1), '') AS host FROM pages)
SELECT page_id, 'text' AS lugar, unnest(regexp_extract_all(html, '([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{{2,}})')) AS email FROM p
UNION ALL SELECT page_id, 'mailto', 'web@' || host FROM p WHERE page_id % 3 = 0 AND host IS NOT NULL""")
def contacts_from_markup(spark, sf_dir):
    """Pages with encoded addresses, every third with a link to its owner and a comment that does not count."""
    pages = views.table(spark, sf_dir, "pages")
    host = F.nullif(F.regexp_extract("url", "https?://([a-z0-9.-]+)", 1), F.lit(""))
    link = F.concat(F.lit('<!-- not@this.one --><a class=x href="mailto:web%40'), host, F.lit('?subject=a@b.cc">w</a>'))
    coded = F.concat(F.replace("html", F.lit("@"), F.lit("&#64;")), F.when(F.col("page_id") % 3 == 0, F.coalesce(link, F.lit(""))).otherwise(""))
    return markup.contacts_in(pages.select("page_id", coded.alias("html")), "page_id", "html")


SETS_LEAST = 8


@query(f"""WITH RECURSIVE {_JOINED}, lists AS (SELECT list_sort(string_split(paises, ',')) AS l, count(*) AS n, sum(score) AS total FROM both_ WHERE paises <> '' GROUP BY 1),
masks AS (SELECT l, n, total, unnest(range(1, (1 << len(l))::BIGINT)) AS m FROM lists)
SELECT array_to_string(list_filter(l, lambda x, i: (m >> (i - 1)::BIGINT) & 1 = 1), ',') AS paises, sum(n)::BIGINT AS n, sum(total) / sum(n) AS avg_score
FROM masks GROUP BY 1 HAVING sum(n) >= {SETS_LEAST}""")
def countries_together(spark, sf_dir):
    """Which countries go together with which score, over the configurations used in measured iterations."""
    used = policy.trajectory(views.proposals(spark, sf_dir), levels=1).select("run_id", "iteracion", "priorizar_paises")
    rows = policy.looped(views.iterations(spark, sf_dir)).join(used, ["run_id", "iteracion"])
    sets = frequent_sets.frequent_sets(rows, "priorizar_paises", "score", SETS_LEAST)
    return sets.select(F.array_join("items", ",").alias("paises"), "n", "avg_score")


@query(f"""WITH {views.CATALOG} SELECT event_id, fuente, organizador, email, NULL::VARCHAR AS lang FROM cat
UNION ALL SELECT doc_id, source, NULL, NULL, lang FROM documents""")
def union_catalogs(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"), F.col("source").alias("fuente"), "lang")
    return catalogs.union_catalogs(views.catalog(spark, sf_dir), docs)


def _as_csv(spark, df: DataFrame) -> str:
    return catalogs.write_csv(df, shared_path(spark, "catalog"), 1)


@query(f"WITH {views.CATALOG} SELECT event_id::VARCHAR AS event_id, fuente, organizador, email FROM cat")
def csv_catalog_scan(spark, sf_dir):
    return catalogs.scan_csv(spark, _as_csv(spark, views.catalog(spark, sf_dir)))


_TOKEN = "CASE event_id % 6 WHEN 0 THEN 'NA' WHEN 1 THEN '#N/A' WHEN 2 THEN ' ' WHEN 3 THEN '-' WHEN 4 THEN 'null' ELSE fuente END"


@query(f"WITH {views.CATALOG} {_SCORED} (SELECT count(*) AS eventos, count(DISTINCT nullif(nullif(nullif(t, 'NA'), '#N/A'), 'null')) AS fuentes, count(organizador) AS organizadores, count(email) AS emails FROM (SELECT *, {_TOKEN} AS t FROM cat))")
def csv_missing_tokens(spark, sf_dir):
    marked = views.catalog(spark, sf_dir).withColumn("fuente", F.expr(_TOKEN))
    return kpi.catalog_kpi(catalogs.scan_csv(spark, _as_csv(spark, marked)))


@query(f"""WITH {views.CATALOG} SELECT event_id::VARCHAR AS event_id, 'a "b", ' || coalesce(fuente, '') || chr(10) || 'c' AS nota, organizador FROM cat""")
def csv_catalog_roundtrip(spark, sf_dir):
    note = F.concat(F.lit('a "b", '), F.coalesce("fuente", F.lit("")), F.lit("\nc"))
    first = _as_csv(spark, views.catalog(spark, sf_dir).select("event_id", note.alias("nota"), "organizador"))
    root = first.rpartition("/")[0]
    return catalogs.scan_csv(spark, catalogs.write_csv(catalogs.scan_csv(spark, first), root, 2))


@query(f"WITH {views.ITERATIONS} SELECT run_id, iteracion, eventos, score, 'España,Portugal' AS paises FROM it")
def history_json_roundtrip(spark, sf_dir):
    countries = F.array(F.lit("España"), F.lit("Portugal"))
    config = F.struct(
        *[F.lit(v).cast("bigint").alias(c) for c, v in (("max_eventos", 100), ("busquedas_facebook", 50), ("timeout", 20))], countries.alias("priorizar_paises")
    )
    rows = views.iterations(spark, sf_dir)
    rows = rows.select("run_id", "iteracion", config.alias("config"), F.struct(*kpi.METRIC_COLUMNS).alias("metricas"))
    path = shared_path(spark, "history")
    histories.write_history(rows, path)
    back = histories.read_history(spark, path)
    return back.select("run_id", "iteracion", "metricas.eventos", "metricas.score", F.array_join("config.priorizar_paises", ",").alias("paises"))


@query(f"""WITH RECURSIVE {views.TRAJECTORY} SELECT {_RUN}, '{{"max_eventos":' || max_eventos || ',"busquedas_facebook":' || busquedas_facebook || ',"timeout":' || timeout
  || ',"priorizar_paises":[' || CASE WHEN paises = '' THEN '' ELSE '"' || replace(paises, ',', '","') || '"' END
  || '],"extraer_contactos":false,"agregar_fuentes":[],"profundidad_busqueda":3,"buscar_en_grupos":false}}' AS config FROM final
  WHERE run_id IN (SELECT run_id FROM named WHERE what <> 'none')""")
def config_as_json(spark, sf_dir):
    last = policy.fold(views.proposals(spark, sf_dir), levels=1)
    return last.select("run_id.*", histories.as_json(policy.full_config()).alias("config"))


@query(f"WITH {views.CATALOG} SELECT event_id, fuente, organizador, email FROM cat ORDER BY event_id LIMIT 19")
def catalog_preview(spark, sf_dir):
    return catalogs.preview(views.catalog(spark, sf_dir), "event_id")


@query(f"""WITH {views.ITERATIONS} SELECT run_id, iteracion, 'Última medición: eventos=' || eventos || ', fuentes=' || fuentes
  || ', organizadores=' || organizadores || ', emails=' || emails || ', score=' || score || '.' || chr(10)
  || 'Contesta con un objeto JSON de cuatro claves: accion, parametro, valor, razon.' AS prompt FROM it""")
def render_prompt(spark, sf_dir):
    return views.iterations(spark, sf_dir).select("run_id", "iteracion", proposals.prompt().alias("prompt"))


@query(f"""WITH {views.ITERATIONS} SELECT run_id, iteracion, concat_ws(chr(10),
  CASE WHEN organizadores < {FEW_ORGANISERS} AND eventos > {MANY_EVENTS} THEN '{proposals.ADVICE["enrich"]}' END,
  CASE WHEN fuentes < 3 THEN '{proposals.ADVICE["sources"]}' END, CASE WHEN score < {LOW_SCORE} THEN '{proposals.ADVICE["limits"]}' END) AS consejo FROM it""")
def render_advice(spark, sf_dir):
    advice = proposals.advice(LOW_SCORE, FEW_ORGANISERS, MANY_EVENTS, 3).alias("consejo")
    return views.iterations(spark, sf_dir).select("run_id", "iteracion", advice)


@query(f"""WITH {views.ITERATIONS} SELECT run_id, iteracion, 'eventos: ' || eventos || ' | organizadores: ' || organizadores || ' | emails: ' || emails
  || ' | fuentes: ' || fuentes || ' | score: ' || score AS resumen FROM it""")
def render_summary(spark, sf_dir):
    return views.iterations(spark, sf_dir).select("run_id", "iteracion", proposals.summary().alias("resumen"))


def _stream(spark, sf_dir, prepare: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows written in the order of time and read back as a stream, in one or more micro-batches."""
    path = shared_path(spark, "stream-in")
    rows = prepare(views.table(spark, sf_dir, "events"))
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def _drain(spark, stream: DataFrame, mode: str) -> DataFrame:
    """Run a stream over all that is there and read its table."""
    path = shared_path(spark, "stream-out")

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={number}")

    spark.createDataFrame([], stream.schema).write.parquet(path if mode == "complete" else f"{path}/batch=-1")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", shared_path(spark, "stream-state"))
    writer.foreachBatch(save).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path).select(*stream.columns)


_WINDOWS = """SELECT date_trunc('day', ts) AS inicio, count(*) AS eventos, count(DISTINCT event_type) AS fuentes,
  count(*) FILTER (event_type = 'signup') AS organizadores, count(*) FILTER (event_type = 'purchase') AS emails FROM events GROUP BY 1"""


def _windowed(spark, sf_dir, mode: str, measure: Callable[[DataFrame], DataFrame] = streams.windowed_kpi) -> DataFrame:
    def prepare(events: DataFrame) -> DataFrame:
        return events.select(
            F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("fuente"),
            F.when(F.col("event_type") == "signup", "x").alias("organizador"), F.when(F.col("event_type") == "purchase", "x").alias("email"),
        )

    done = _drain(spark, measure(_stream(spark, sf_dir, prepare)), mode)
    return done.withColumn("inicio", F.col("inicio").cast("timestamp_ntz"))


@query(f"{_SCORED} ({_WINDOWS})")
def stream_kpi(spark, sf_dir):
    return _windowed(spark, sf_dir, "complete")


@query(f"{_SCORED} ({_WINDOWS}) WHERE inicio + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)")
def stream_kpi_append(spark, sf_dir):
    """Only windows that the watermark has passed: the last, open ones are not emitted."""
    return _windowed(spark, sf_dir, "append")


@query(ORACLE["stream_kpi_append"])
def stream_kpi_sketch(spark, sf_dir):
    """Closed windows whose state holds a sketch of fixed size instead of a set of sources."""
    return _windowed(spark, sf_dir, "append", lambda events: rollup.estimated(rollup.windowed(events)))


@query(ORACLE["new_best"])
def stream_new_best(spark, sf_dir):
    path = shared_path(spark, "stream-in")
    rows = views.iterations(spark, sf_dir).select("run_id", "iteracion", "score")
    rows.repartition("run_id").write.parquet(path)
    return _drain(spark, streams.stream_new_best(spark.readStream.schema(rows.schema).parquet(path)), "append")


def _fed(spark, rows: DataFrame, time: str = "ts") -> DataFrame:
    """``rows`` as a stream, with one more row (no run has its id, -1) long after them, so that the watermark passes them all."""
    types = {f.name: f.dataType for f in rows.schema}
    end = rows.agg((F.max(time) + F.expr("INTERVAL 30 DAYS")).alias(time))
    ids = {"run_id": -1, "iteracion": 0}  # not null: filters on keys are pushed below the watermark
    end = end.select(*[F.col(n) if n == time else F.lit(ids.get(n)).cast(t).alias(n) for n, t in types.items()])
    path = shared_path(spark, "stream-in")
    rows.unionByName(end).write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


@query(f"""WITH answers AS (SELECT user_id AS run_id, day(ts)::BIGINT AS iteracion, count(*) AS eventos, min(event_id) AS event_id FROM events GROUP BY ALL)
SELECT run_id, iteracion, a.eventos, CASE WHEN event_id % 4 <> 0 THEN respuesta END AS respuesta FROM answers a JOIN ({views.RAW}) USING (event_id, run_id)""")
def stream_proposals(spark, sf_dir):
    """Each day of a user is an iteration; its proposal comes an hour later, and of each fourth none comes."""
    day = F.timestamp_seconds(F.col("iteracion") * 86400)
    events = views.table(spark, sf_dir, "events").select("event_id", F.day("ts").cast("bigint").alias("iteracion"))
    days = views.raw_proposals(spark, sf_dir).join(events, "event_id").groupBy("run_id", "iteracion")
    days = days.agg(F.count("*").alias("eventos"), F.min("event_id").alias("_e"), F.min_by("respuesta", "event_id").alias("respuesta"))
    rows = _fed(spark, days.select("run_id", "iteracion", "eventos", day.alias("ts")))
    answers = _fed(spark, days.where("_e % 4 <> 0").select("run_id", "iteracion", (day + F.expr("INTERVAL 1 HOUR")).alias("ts"), "respuesta"))
    joined = history_streams.with_proposals(rows, answers, wait="2 hours")
    return _drain(spark, joined.drop("ts"), "append").where("run_id <> -1")


@query(_LONG_TRAJECTORY)
def stream_trajectory(spark, sf_dir):
    """The configurations of ``trajectory_long_runs`` from a stream; the ids of the proposals are seconds of its time."""
    rows = _long_runs(spark, sf_dir).withColumn("ts", F.timestamp_seconds(F.col("iteracion") + 10**9)).orderBy(F.xxhash64("iteracion"))
    done = _drain(spark, history_streams.trajectory(_fed(spark, rows)), "append").where("run_id <> -1")
    return _shown(done.withColumnRenamed("iteracion", "event_id"), "run_id", "event_id")


@query(ORACLE["new_best"])
def stream_new_best_unordered(spark, sf_dir):
    """Iterations that arrive in the order of a hash, not of their days."""
    rows = views.iterations(spark, sf_dir).select("run_id", "iteracion", "score", F.timestamp_seconds(F.col("iteracion") * 86400).alias("ts"))
    return _drain(spark, history_streams.new_best(_fed(spark, rows.orderBy(F.xxhash64("run_id", "iteracion")))), "append").where("run_id <> -1")
