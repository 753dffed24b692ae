import json
import random
import re

import pytest
from lumenreef.functions import policy, proposals
from pyspark.sql import functions as F

TEXTS = {
    'texto {"accion":"AUMENTAR_TIMEOUT","parametro":"timeout","valor":"30","razon":"r"} fin': "VALID",
    '```json\n{"accion":"AUMENTAR_TIMEOUT",\n"valor":1}\n```': "VALID",
    '{"accion":"A","accion":"B"}': "VALID",
    "{}": "EMPTY", "null": "EMPTY", "[]": "EMPTY", '""': "EMPTY", "0": "EMPTY", "false": "EMPTY", "0.0": "EMPTY", "{ }": "EMPTY",
    "[1,2]": "NON_OBJECT", "5": "NON_OBJECT", '"x"': "NON_OBJECT", "true": "NON_OBJECT", "[[]]": "NON_OBJECT",
    '{"a":1} and {"accion":"B"}': "UNPARSEABLE", "{'accion':'A'}": "UNPARSEABLE", '{"accion":"A",}': "UNPARSEABLE", "none": "UNPARSEABLE", "": "UNPARSEABLE",
}


def test_classes(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "respuesta string")
    got = {r.respuesta: r.clase for r in proposals.parse_proposals(df).collect()}
    assert got == TEXTS


def test_null_text_is_empty_and_last_key_wins(spark):
    df = spark.createDataFrame([(None,), ('{"accion":"A","accion":"B"}',)], "respuesta string")
    got = proposals.parse_proposals(df).collect()
    assert [(r.clase, r.accion, r.razon) for r in got] == [("EMPTY", None, None), ("VALID", "B", "Sin razón")]


VALUES = ["120", "120.7", "-3.9", "true", '"120"', '" 1_000 "', "1e3", '"120.5"', '"abc"', "null", '["a"]', '{"k":1}', None]


def python_int(text):
    if text is None:
        return None
    try:
        return int(json.loads(text))
    except (TypeError, ValueError):
        return None


def test_integers_agree_with_python(spark):
    rows = [(k, "{}" if v is None else f'{{"a":1,"valor":{v}}}') for k, v in enumerate(VALUES)]
    got = {r.k: r.valor_entero for r in proposals.parse_proposals(spark.createDataFrame(rows, "k int, respuesta string")).collect()}
    assert [got[k] for k in range(len(VALUES))] == [python_int(v) for v in VALUES]


def rows_of(spark, texts, run=1, events=60, organisers=30):
    data = [(run, k + 1, t, events, organisers) for k, t in enumerate(texts)]
    return spark.createDataFrame(data, "run_id long, iteracion long, respuesta string, eventos long, organizadores long")


def p(action, parameter, value):
    return json.dumps({"accion": action, "parametro": parameter, "valor": value})


FIXTURE = [
    p("AUMENTAR_BUSQUEDAS", "busquedas_facebook", "290"), p("X", "", ""), p("AUMENTAR_MAX_EVENTOS", "max_eventos", "abc"),
    p("AGREGAR_PAISES", "", ["ES", "PT"]), p("AGREGAR_PAISES", "", ["PT", "FR"]), p("AGREGAR_PAISES", "", "ES"),
    p("AUMENTAR_TIMEOUT", "timeout", "57"), p("AUMENTAR_TIMEOUT", "timeout", "z"),
]


def test_fixture_fold(spark):
    got = policy.fold(rows_of(spark, FIXTURE)).first()
    assert (got.max_eventos, got.busquedas_facebook, got.timeout) == (150, 300, 60)
    assert tuple(got.priorizar_paises) == policy.DEFAULT_COUNTRIES
    steps = policy.trajectory(rows_of(spark, FIXTURE)).orderBy("iteracion").collect()
    assert [r.busquedas_facebook for r in steps] == [50, 290, 300, 300, 300, 300, 300, 300]
    assert list(steps[5].priorizar_paises) == ["ES", "PT", "FR"]


def test_cap_can_lower(spark):
    texts = [p("AUMENTAR_BUSQUEDAS", "busquedas_facebook", "1000"), p("AUMENTAR_BUSQUEDAS", "organizadores", "true")]
    assert policy.fold(rows_of(spark, texts)).first().busquedas_facebook == 300
    assert policy.range_violations() is not None


def fold_plain(texts, events, organisers, enricher):
    c = {"m": 100, "b": 50, "t": 20, "p": []}

    def up(key, step, cap):
        c[key] = min(c[key] + step, cap)

    for text in texts:
        m = re.search(r"\{.*\}", text, re.S)
        try:
            got = json.loads(m.group(0) if m else text)
        except ValueError:
            few = organisers < 20
            got = {"accion": "ENRIQUECER_EVENTOS" if few and events > 50 else "AUMENTAR_BUSQUEDAS", "parametro": "organizadores" if few else "busquedas_facebook", "valor": "true" if few else "80"}
        if not got:
            up("b", 30, 300)
            continue
        if not isinstance(got, dict):
            continue
        a, q, v = got.get("accion", ""), got.get("parametro", ""), got.get("valor", "")
        number = python_int(json.dumps(v))
        if a == "ENRIQUECER_EVENTOS" and enricher:
            continue
        if a == "AUMENTAR_BUSQUEDAS" and q == "busquedas_facebook":
            c["b"] = number if number is not None else min(c["b"] + 30, 300)
        elif a == "AUMENTAR_MAX_EVENTOS" and q == "max_eventos":
            c["m"] = number if number is not None else min(c["m"] + 50, 300)
        elif a == "AUMENTAR_TIMEOUT" and q == "timeout":
            c["t"] = number if number is not None else min(c["t"] + 5, 60)
        elif a == "AGREGAR_PAISES":
            if isinstance(v, list):
                c["p"] = c["p"] + [x for k, x in enumerate(v) if x not in c["p"] and x not in v[:k]]
            else:
                c["p"] = list(policy.DEFAULT_COUNTRIES)
        else:
            up("b", 30, 300)
    return c["m"], c["b"], c["t"], c["p"]


@pytest.mark.parametrize("enricher", [False, True])
def test_random_folds(spark, enricher):
    rng = random.Random(4)
    actions = ["AUMENTAR_BUSQUEDAS", "AUMENTAR_MAX_EVENTOS", "AUMENTAR_TIMEOUT", "AGREGAR_PAISES", "ENRIQUECER_EVENTOS", "X"]
    values = ["80", 70, 12.9, True, "z", ["A", "B", "A"], ["C"], [], {"k": 1}, None]
    data, want = [], {}
    for run in range(40):
        texts = [
            rng.choice(["{}", "nada", "[3]", "null", p(rng.choice(actions), rng.choice(["busquedas_facebook", "max_eventos", "timeout"]), rng.choice(values))] + [p(rng.choice(actions), rng.choice(["busquedas_facebook", "max_eventos", "timeout"]), rng.choice(values))] * 6)
            for _ in range(rng.randint(1, 15))
        ]
        events, organisers = rng.choice([10, 80]), rng.choice([5, 25])
        want[run] = fold_plain(texts, events, organisers, enricher)
        data += [(run, k + 1, t, events, organisers) for k, t in enumerate(texts)]
    df = spark.createDataFrame(data, "run_id long, iteracion long, respuesta string, eventos long, organizadores long")
    got = {r.run_id: (r.max_eventos, r.busquedas_facebook, r.timeout, list(r.priorizar_paises)) for r in policy.fold(df, enricher).collect()}
    for run, values_ in want.items():
        if run in got:
            assert got[run] == values_, run
    assert len(got) >= 35


def test_array_append(spark):
    row = spark.range(1).select(proposals.append_distinct(F.lit(None).cast("array<string>"), F.array(F.lit("a"), F.lit("a"))).alias("x")).first()
    assert row.x == ["a"]


def test_a_filter_on_a_field_does_not_parse_again(spark):
    df = proposals.parse_proposals(rows_of(spark, FIXTURE)).where("clase = 'NON_OBJECT' OR valor_lista IS NOT NULL")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and "parse_json" not in plan.partition("Generate")[0]


def test_rejects_keep_their_iteration(spark):
    texts = ["[1]", p("AUMENTAR_TIMEOUT", "timeout", "30"), "[2]", "{}"]
    got = policy.trajectory(rows_of(spark, texts)).orderBy("iteracion").collect()
    assert [(r.iteracion, r.timeout, r.busquedas_facebook) for r in got] == [(1, 20, 50), (2, 20, 50), (3, 30, 50), (4, 30, 50)]
    assert policy.fold(rows_of(spark, ["[1]", "[2]"])).count() == 0


def test_each_fifteen_proposals_are_a_run(spark):
    rng = random.Random(4)
    ids = rng.sample(range(10_000), 400)
    data = [(rng.choice([1, 1, 1, 2, None]), k) for k in ids]
    rows = spark.createDataFrame(data, "run_id long, event_id long")
    seen, want = {}, []
    for run, k in sorted(data, key=lambda x: x[1]):
        n = seen[run] = seen.get(run, 0) + 1
        want.append((k, run, (n - 1) // 15, (n - 1) % 15 + 1))
    for width in (100_000, 500, 1):
        got = policy.numbered(rows, "event_id", width=width).select("event_id", "run_id.run_id", "run_id.ciclo", "iteracion")
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert policy.numbered(rows.where("false"), "event_id").count() == 0


def test_one_large_run_is_folded_in_passes(spark):
    texts = [p("AUMENTAR_TIMEOUT", "timeout", k) for k in range(40)]
    rows = rows_of(spark, texts).withColumnRenamed("iteracion", "event_id")
    got = policy.fold(policy.numbered(rows, "event_id")).select("run_id.*", "timeout").collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 14), (1, 1, 29), (1, 2, 39)]


def random_steps(rng, count):
    """Proposals of all kinds, also far above the caps and next to the limits of 64 bits."""
    actions = ["AUMENTAR_BUSQUEDAS", "AUMENTAR_MAX_EVENTOS", "AUMENTAR_TIMEOUT", "AGREGAR_PAISES", "X"]
    values = ["80", 70, -500, 299, 10**6, 2**63 - 1, "z", "z", "z", ["A", "B", "A"], ["C"], [f"P{rng.randrange(9)}"], [], None]
    names = {"AUMENTAR_BUSQUEDAS": "busquedas_facebook", "AUMENTAR_MAX_EVENTOS": "max_eventos", "AUMENTAR_TIMEOUT": "timeout"}
    made = []
    for _ in range(count):
        action = rng.choice(actions)
        made.append(rng.choice(["{}", "nada", "[3]", *[p(action, names.get(action, "p"), rng.choice(values))] * 9]))
    return made


def test_runs_of_any_length_are_composed_as_they_are_folded(spark):
    """Blocks of three numbers on several levels, positions with gaps and below zero, a run without id."""
    rng = random.Random(9)
    data, texts = [], {}
    for run, count in ((1, 1), (2, 7), (3, 260), (None, 90)):
        at = sorted(rng.sample(range(-60, 600), count))
        texts[run] = list(zip(at, random_steps(rng, count)))
        data += [(run, k, t, 60, 30) for k, t in texts[run]]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "run_id long, iteracion long, respuesta string, eventos long, organizadores long")
    done = policy.steps(df)
    for levels, width in ((1, 1), (2, 40), (5, 3)):
        whole = policy.composed(done, levels, width).select("run_id", policy.applied(policy.initial(), F.col("effect")).alias("c"))
        got = {r.run_id: (r.max_eventos, r.busquedas_facebook, r.timeout, list(r.priorizar_paises)) for r in whole.select("run_id", "c.*").collect()}
        assert got == {run: fold_plain([t for _, t in listed], 60, 30, False) for run, listed in texts.items()}
        used = policy.composed_before(done, levels, width).select("run_id", "iteracion", policy.applied(policy.initial(), F.col("effect")).alias("c"))
        before = {(r.run_id, r.iteracion): (r.max_eventos, r.busquedas_facebook, r.timeout, list(r.priorizar_paises)) for r in used.select("run_id", "iteracion", "c.*").collect()}
        assert before == {(run, k): fold_plain([t for _, t in listed[:i]], 60, 30, False) for run, listed in texts.items() for i, (k, _) in enumerate(listed)}


def test_one_run_of_ten_million_steps(spark):
    """Steps without text, so that the fold and not the parser is timed: no task gets more than a block."""
    n = 10_000_000
    rules = {"max_eventos": (50, 300, 1000), "busquedas_facebook": (30, 300, 997), "timeout": (5, 60, 991)}

    def number(name):
        by, cap, every = rules[name]
        set_ = F.col("id") % every == 0
        return F.struct(F.when(set_, F.col("id") % 500).alias("fixed"), F.when(set_, 0).otherwise(by).alias("add"), F.when(~set_, cap).alias("cap")).alias(name)

    listed = F.struct((F.col("id") % 4001 == 0).alias("replaced"), F.when(F.col("id") % 7 == 0, F.array(F.concat(F.lit("P"), F.col("id") % 5))).otherwise(F.array()).cast("array<string>").alias("items"))
    made = F.struct(*[number(k) for k in rules], listed.alias("priorizar_paises")).cast(policy.EFFECT)
    rows = spark.range(n).repartition(8).select(F.lit(1).alias("run_id"), F.col("id").alias("iteracion"), made.alias("effect"), F.lit(True).alias("counts"))
    got = policy.composed(rows).select(policy.applied(policy.initial(), F.col("effect")).alias("c")).select("c.*").first()
    for name, (by, cap, every) in rules.items():
        last = (n - 1) // every * every
        assert got[name] == (last % 500 if last == n - 1 else min(last % 500 + by * (n - 1 - last), cap))
    start = (n - 1) // 4001 * 4001
    want = [f"P{start % 5}"] if start % 7 == 0 else []
    for k in range(start + 1, n):
        if k % 7 == 0 and f"P{k % 5}" not in want:
            want.append(f"P{k % 5}")
    assert got.priorizar_paises == want
