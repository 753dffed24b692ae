import time

import pytest
from lumenreef.functions import policy
from lumenreef.operators import contacts, history, kpi
from lumenreef.sources import catalog, history as histories
from lumenreef.streaming import kpi as streams
from pyspark.sql import functions as F

EDGE = '''id,fuente,organizador,email
1,Goabase,,a@b.c
2,"Face, book","O ""X"" y",NA
3,Goabase,N/A,""
4,null,None," "

5,"multi
line",<NA>,nan
6,#N/A,n/a,-
7, Goabase,NULL,x
'''


def put(tmp_path, text, name="c.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def metrics(df):
    return tuple(kpi.catalog_kpi(df).first())


def test_edge_file(spark, tmp_path):
    assert metrics(catalog.scan_csv(spark, put(tmp_path, EDGE))) == (7, 4, 1, 4, 61)


def test_header_only_has_zero_metrics(spark, tmp_path):
    assert metrics(catalog.scan_csv(spark, put(tmp_path, "fuente,organizador,email\n"))) == (0, 0, 0, 0, 0)


def test_empty_file_is_no_catalog(spark, tmp_path):
    with pytest.raises(catalog.NoCatalog):
        catalog.scan_csv(spark, put(tmp_path, ""))


def test_long_row_is_corrupt_and_short_row_padded(spark, tmp_path):
    path = put(tmp_path, "a,b\n1,2\n1,2,3\n4\n")
    assert sorted(map(tuple, catalog.scan_csv(spark, path).collect()), key=str) == [("1", "2"), ("4", None)]
    marked = catalog.scan_csv(spark, path, with_corrupt=True).where(F.col(catalog.CORRUPT).isNotNull())
    assert marked.count() == 1


def test_long_rows_with_empty_fields_are_corrupt(spark, tmp_path):
    path = put(tmp_path, 'fuente,email\n1,,3\n1,2,\n1,2,,4\n"a,b",c\n"x ""y"", z"\n"p,q\nr","s,"\nok,\n')
    kept = {tuple(r) for r in catalog.scan_csv(spark, path).collect()}
    assert kept == {("a,b", "c"), ('x "y", z', None), ("p,q\nr", "s,"), ("ok", None)}
    marked = catalog.scan_csv(spark, path, with_corrupt=True).where(F.col(catalog.CORRUPT).isNotNull())
    assert marked.count() == 3


def test_addresses_in_long_texts_take_linear_time(spark):
    began = time.monotonic()
    texts = ["a" * 1_000_000, "a." * 500_000 + "@", "a@" + "b." * 400_000, "a@b.cc1d@e.ff " + "x" * 1_000_000, None, "x.y@z.org,q+1@r-s.co.uk9"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    found = sorted((r.k, r.email) for r in contacts.emails_in(rows, "k", "text").collect())
    assert found == [(3, "1d@e.ff"), (3, "a@b.cc"), (5, "q+1@r-s.co.uk"), (5, "x.y@z.org")]
    assert time.monotonic() - began < 20


def test_missing_column_and_case_of_header(spark, tmp_path):
    assert metrics(catalog.scan_csv(spark, put(tmp_path, "fuente,organizador\nA,x\n"))) == (1, 1, 1, 0, 13)
    assert metrics(catalog.scan_csv(spark, put(tmp_path, "Fuente\nA\n", "d.csv"))) == (1, 0, 0, 0, 1)


def test_round_trip_and_versions(spark, tmp_path):
    first = catalog.scan_csv(spark, put(tmp_path, EDGE))
    again = catalog.scan_csv(spark, catalog.write_csv(first, str(tmp_path / "out"), 1))
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))


def test_union_keeps_first_seen_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id long, fuente string")
    b = spark.createDataFrame([(2, "e")], "id long, email string")
    both = catalog.union_catalogs(a, b)
    assert both.columns == ["id", "fuente", "email"] and both.count() == 2


def test_fill_keeps_present_values(spark):
    cat = spark.createDataFrame([(1, "o", None, "z"), (2, None, None, "y"), (None, None, "e", "n")], "event_id long, organizador string, email string, extra string")
    con = spark.createDataFrame([(1, "p", "q"), (2, "r", None), (2, "s", "t")], "event_id long, organizador string, email string")
    got = {(r.event_id, r.organizador, r.email, r.extra) for r in contacts.fill_contacts(cat, con).collect()}
    assert got == {(1, "o", "q", "z"), (2, "r", "t", "y"), (None, None, "e", "n")}


def test_enrichment_needs_the_enricher(spark):
    cat = spark.createDataFrame([(1, 1, "a", None, None)], "event_id long, run_id long, fuente string, organizador string, email string")
    fill = lambda df: df.withColumn("organizador", F.lit("o"))
    on = contacts.enrich_then_measure(cat, "run_id", fill, 1, 0).first()
    off = contacts.enrich_then_measure(cat, "run_id", fill, 1, 0, available=False).first()
    assert (on.organizadores, on.enriched, off.organizadores, off.enriched) == (1, True, 0, False)


GOLDEN = [(1, 81, 6, 18, 0, 177, 100, 50, 0), (3, 80, 6, 18, 0, 176, 100, 50, 0), (8, 81, 6, 19, 0, 179, 100, 50, 6), (14, 80, 6, 18, 0, 176, 120, 80, 6), (15, 81, 6, 18, 0, 177, 120, 80, 6)]


@pytest.fixture
def golden(spark):
    names = "iteracion long, eventos long, fuentes long, organizadores long, emails long, score long, max_eventos long, busquedas long, paises long"
    return spark.createDataFrame(GOLDEN, names).withColumn("run_id", F.lit(1))


def test_history_facts(golden):
    assert golden.where(F.col("score") != kpi.score()).count() == 0
    best = history.mark_new_best(golden).where("new_best")
    assert [r.iteracion for r in best.orderBy("iteracion").collect()] == [1, 8]
    top = history.best_row(golden, "max_eventos", "paises").first()
    assert (top.iteracion, top.score, top.max_eventos, top.paises) == (8, 179, 100, 6)
    assert golden.where(kpi.goal_reached()).count() == 0
    assert golden.where(kpi.needs_enrichment()).count() == 5
    changed = history.mark_changes(golden, "max_eventos", "busquedas", "paises").where("changed")
    assert [r.iteracion for r in changed.orderBy("iteracion").collect()] == [8, 14]
    assert [r.since_best for r in history.mark_stagnation(golden).orderBy("iteracion").collect()] == [0, 2, 0, 6, 7]


def test_stops(spark):
    rows = spark.createDataFrame([(1, 1, 5, False), (1, 2, 9, False), (1, 3, 9, False), (2, 1, 1, False), (2, 2, 1, True), (2, 3, 1, False)], "run_id long, iteracion long, eventos long, failed boolean")
    kept = history.until_stop(rows, F.col("eventos") >= 9, F.col("failed"), 15)
    assert sorted((r.run_id, r.iteracion) for r in kept.collect()) == [(1, 1), (1, 2), (2, 1)]


def test_no_best_without_positive_scores_and_ties_keep_the_earliest(spark):
    rows = spark.createDataFrame([(1, 1, 0), (2, 1, 7), (2, 2, 7)], "run_id long, iteracion long, score long")
    assert [(r.run_id, r.iteracion) for r in history.best_row(rows).collect()] == [(2, 1)]


def test_history_json(spark, tmp_path):
    config = "struct<max_eventos:bigint,busquedas_facebook:bigint,timeout:bigint,priorizar_paises:array<string>,extraer_contactos:boolean,agregar_fuentes:array<string>,profundidad_busqueda:bigint,buscar_en_grupos:boolean>"
    row = [(1, 1, (100, 50, 20, ["España"], False, [], 3, False), None)]
    df = spark.createDataFrame(row, f"run_id bigint, iteracion bigint, config {config}, metricas struct<eventos:bigint,fuentes:bigint,organizadores:bigint,emails:bigint,score:bigint>")
    path = str(tmp_path / "h")
    histories.write_history(df, path)
    assert histories.read_history(spark, path).collect() == df.collect()
    whole = tmp_path / "whole.json"
    whole.write_text('[{"run_id": 1, "iteracion": 2, "config": {"priorizar_paises": ["Espa\\u00f1a"]}}]')
    back = histories.read_history(spark, str(whole), whole_array=True).first()
    assert back.config.priorizar_paises == ["España"] and back.metricas is None


def test_append_mode_emits_closed_windows_and_drops_late_rows(spark, tmp_path):
    """A window comes out once, with the batch after the one that moved the watermark (10 minutes behind) past its end; rows for it are then too late."""
    batches = [
        ["2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-02 09:00:00"],
        ["2024-01-02 08:00:00", "2024-01-03 00:20:00"],  # out of order, in time
        ["2024-01-01 23:00:00", "2024-01-02 23:59:00", "2024-01-03 00:05:00"],  # the first is too late
        ["2024-01-04 00:09:00"],  # does not close the third day
        ["2024-01-04 00:11:00"],
    ]
    source = str(tmp_path / "in")
    rows = "ts timestamp, fuente string, organizador string, email string"
    for k, times in enumerate(batches):
        part = spark.createDataFrame([(t, "a", None, None) for t in times], "ts string, fuente string, organizador string, email string")
        part.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)  # files are taken in the order of their times
    stream = spark.readStream.schema(rows).option("maxFilesPerTrigger", 1).parquet(source)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    writer = streams.windowed_kpi(stream).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()
    got = sorted((str(r.inicio)[:10], r.eventos) for r in spark.read.parquet(out).collect())
    assert got == [("2024-01-01", 2), ("2024-01-02", 3), ("2024-01-03", 2)]


def test_history_with_missing_proposals_and_metrics(spark):
    rows = spark.createDataFrame([(1, 1, 5, 0), (1, 2, 5, 0), (1, 3, None, None), (1, 4, 5, 0), (2, 1, None, None)], "run_id long, iteracion long, eventos long, organizadores long")
    answers = spark.createDataFrame([(1, 1, '{"accion":"AUMENTAR_TIMEOUT","parametro":"timeout","valor":33}'), (1, 4, '{"accion":"AUMENTAR_TIMEOUT","parametro":"timeout","valor":44}')], "run_id long, iteracion long, respuesta string")
    kept = history.until_stop(rows, F.col("eventos") >= 99, F.col("eventos").isNull(), 15)
    got = [tuple(r) for r in policy.fold(history.with_proposals(kept, answers)).select("run_id", "timeout", "busquedas_facebook").collect()]
    assert got == [(1, 33, 80)]  # the second iteration had no answer: an empty proposal raises the searches
