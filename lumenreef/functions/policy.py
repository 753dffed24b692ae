"""The configuration policy: proposals folded in order into a configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenreef.functions import proposals

# Countries that a proposal without a list sets.
DEFAULT_COUNTRIES = ("España", "Portugal", "Alemania", "Francia", "Italia", "Holanda")
# Initial value, step and cap of each number.
MAX_EVENTS, SEARCHES, TIMEOUT = (100, 50, 300), (50, 30, 300), (20, 5, 60)
# The initial values that no proposal changes.
FROZEN = {"extraer_contactos": False, "profundidad_busqueda": 3, "buscar_en_grupos": False}
# Documented ranges.
RANGES = {"max_eventos": (100, 300), "busquedas_facebook": (50, 300), "timeout": (20, 60)}
ITERATIONS = 15
#: Width of the blocks of the order in which a run is folded and numbered, and levels of blocks of a fold.
WIDTH, LEVELS = 2048, 3

STATE = "struct<max_eventos:bigint,busquedas_facebook:bigint,timeout:bigint,priorizar_paises:array<string>>"
#: A step on a number: the value it sets, or else what it adds and the cap of the sum.
NUMBER = "struct<fixed:bigint,add:bigint,cap:bigint>"
#: A step on the list: the elements it appends, or sets if ``replaced``.
LISTED = "struct<replaced:boolean,items:array<string>>"
EFFECT = f"struct<max_eventos:{NUMBER},busquedas_facebook:{NUMBER},timeout:{NUMBER},priorizar_paises:{LISTED}>"
NUMBERS = ("max_eventos", "busquedas_facebook", "timeout")


def initial() -> Column:
    return F.struct(
        F.lit(MAX_EVENTS[0]).cast("bigint").alias("max_eventos"),
        F.lit(SEARCHES[0]).cast("bigint").alias("busquedas_facebook"),
        F.lit(TIMEOUT[0]).cast("bigint").alias("timeout"),
        F.array().cast("array<string>").alias("priorizar_paises"),
    ).cast(STATE)


def raised(x: Column, add: Column, cap: Column) -> Column:
    """``x + add``, at most the cap if there is one (so a value above the cap comes down to it)."""
    return F.least(F.try_add(x, add), cap)


def effect(step: Column, enricher: bool = False) -> Column:
    """What a step ``accion, parametro, valor_entero, valor_lista, plain, reject`` does to any configuration.

    ``plain`` marks an empty proposal: only the searches go up. ``reject`` marks one without effect.
    """
    action, parameter, number, listed = step["accion"], step["parametro"], step["valor_entero"], step["valor_lista"]
    live = ~step["plain"] & ~step["reject"]
    searches = (action == "AUMENTAR_BUSQUEDAS") & (parameter == "busquedas_facebook")
    events = (action == "AUMENTAR_MAX_EVENTOS") & (parameter == "max_eventos")
    timeout = (action == "AUMENTAR_TIMEOUT") & (parameter == "timeout")
    countries = action == "AGREGAR_PAISES"
    enrich = (action == "ENRIQUECER_EVENTOS") & F.lit(enricher)
    other = step["plain"] | (live & ~(searches | events | timeout | countries | enrich))

    def number_of(name: str, mine: Column, also: Column, rule: tuple[int, int, int]) -> Column:
        _, by, cap = rule
        up = also | (live & mine & number.isNull())
        fixed = F.when(live & mine, number)
        return F.struct(fixed.alias("fixed"), F.when(up, by).otherwise(0).alias("add"), F.when(up, cap).alias("cap")).alias(name)

    defaults = F.array(*map(F.lit, DEFAULT_COUNTRIES))
    replaced = live & countries & listed.isNull()
    items = F.when(replaced, defaults).when(live & countries, F.array_distinct(listed)).otherwise(F.array().cast("array<string>"))
    no = F.lit(False)
    return F.struct(
        number_of("max_eventos", events, no, MAX_EVENTS), number_of("busquedas_facebook", searches, other, SEARCHES), number_of("timeout", timeout, no, TIMEOUT),
        F.struct(replaced.alias("replaced"), items.alias("items")).alias("priorizar_paises"),
    ).cast(EFFECT)


def no_effect() -> Column:
    none = F.struct(F.lit(None).alias("fixed"), F.lit(0).alias("add"), F.lit(None).alias("cap"))
    kept = F.struct(F.lit(False).alias("replaced"), F.array().alias("items"))
    return F.struct(*[none.alias(n) for n in NUMBERS], kept.alias("priorizar_paises")).cast(EFFECT)


def then(f: Column, g: Column) -> Column:
    """The effect of ``f`` and then ``g``. This is associative, so a run can be composed by parts in any nesting.

    A sum with a cap stays one: ``min(min(x + a, c) + b, d)`` is ``min(x + a + b, min(c + b, d))``.
    """

    def number_of(name: str) -> Column:
        a, b = f[name], g[name]
        fixed = F.coalesce(b["fixed"], F.when(a["fixed"].isNotNull(), raised(a["fixed"], b["add"], b["cap"])))
        return F.struct(fixed.alias("fixed"), (a["add"] + b["add"]).alias("add"), F.least(a["cap"] + b["add"], b["cap"]).alias("cap")).alias(name)

    a, b = f["priorizar_paises"], g["priorizar_paises"]
    items = F.when(b["replaced"], b["items"]).otherwise(F.array_union(a["items"], b["items"]))
    listed = F.struct((a["replaced"] | b["replaced"]).alias("replaced"), items.alias("items"))
    return F.struct(*[number_of(n) for n in NUMBERS], listed.alias("priorizar_paises")).cast(EFFECT)


def applied(config: Column, f: Column) -> Column:
    """The configuration after the effect ``f``."""
    numbers = [F.coalesce(f[n]["fixed"], raised(config[n], f[n]["add"], f[n]["cap"])).alias(n) for n in NUMBERS]
    listed = f["priorizar_paises"]
    items = F.when(listed["replaced"], listed["items"]).otherwise(F.array_union(config["priorizar_paises"], listed["items"]))
    return F.struct(*numbers, items.alias("priorizar_paises")).cast(STATE)


def steps(rows: DataFrame, enricher: bool = False, *kept: str) -> DataFrame:
    """``run_id, iteracion, effect, counts`` and the columns ``kept`` for the proposals of ``rows``, parsed and with the rule fallback.

    ``rows`` has run_id, iteracion, respuesta, eventos and organizadores. Non-objects are
    rejects: they have no effect and do not count.
    """
    parsed = proposals.parse_proposals(rows)
    action, parameter, value = proposals.rule_fallback()
    lost = F.col("clase") == proposals.UNPARSEABLE
    step = F.struct(
        F.coalesce(F.when(lost, action).otherwise(F.col("accion")), F.lit("")).alias("accion"),
        F.coalesce(F.when(lost, parameter).otherwise(F.col("parametro")), F.lit("")).alias("parametro"),
        F.when(lost, value.try_cast("bigint")).otherwise(F.col("valor_entero")).alias("valor_entero"),
        F.when(~lost, F.col("valor_lista")).alias("valor_lista"),
        (F.col("clase") == proposals.EMPTY).alias("plain"),
        (F.col("clase") == proposals.NON_OBJECT).alias("reject"),
    )
    read = parsed.select("run_id", "iteracion", *kept, F.inline(F.array(F.struct(step.alias("s")))))
    return read.select("run_id", "iteracion", *kept, effect(F.col("s"), enricher).alias("effect"), (~F.col("s.reject")).alias("counts"))


def composed(rows: DataFrame, levels: int = LEVELS, width: int = WIDTH) -> DataFrame:
    """``run_id, effect, counts``: all ``effect`` of a run in the order of ``iteracion`` as one, and whether any counts.

    A run is composed by blocks of ``width`` numbers of ``iteracion``, the blocks by blocks of blocks, and so on for
    ``levels`` levels, so a run of any length is a tree of aggregates: no task gathers it or sorts it as a whole. A group
    holds at most ``width`` effects (for a number that repeats, all that have it; these follow in the order of their
    values), at the last level one for each ``width ** (levels - 1)`` numbers of the run.
    """
    parts = rows.select("run_id", F.col("iteracion").alias("_at"), "effect", "counts")
    for level in range(levels):
        parts = parts.groupBy("run_id", _block(level == levels - 1, width)).agg(_whole(_in_order()).alias("effect"), F.max("counts").alias("counts"))
    return parts.select("run_id", "effect", "counts")


def _block(last: bool, width: int, name: str = "_at") -> Column:
    """The block of the number ``_at``; all numbers are one block at the last level."""
    return (F.lit(0).cast("bigint") if last else F.expr(f"_at div {width}")).alias(name)


def _in_order() -> Column:
    return F.array_sort(F.collect_list(F.struct("_at", "effect")))


def _whole(listed: Column) -> Column:
    return F.aggregate(listed, no_effect(), lambda acc, x: then(acc, x["effect"]))


def composed_before(rows: DataFrame, levels: int = LEVELS, width: int = WIDTH) -> DataFrame:
    """``run_id, iteracion, effect``: for each row all effects of its run before it, as one.

    Blocks are composed and numbered as in ``composed``; the effect of the blocks before a block is found level by level in the
    same way, and a block's rows start from it.
    """

    def before(parts: DataFrame, levels: int) -> DataFrame:
        blocks = parts.groupBy("run_id", _block(levels == 1, width, "_block")).agg(_in_order().alias("_list"))
        if levels == 1:
            started = blocks.withColumn("_start", no_effect())
        else:
            wholes = blocks.select("run_id", F.col("_block").alias("_at"), _whole(F.col("_list")).alias("effect"))
            earlier = before(wholes, levels - 1)
            # A struct of a null is equal to itself, so runs without id are one run here too.
            run = F.struct("run_id").alias("_run")
            starts = earlier.select(run, F.col("_at").alias("_block"), F.col("effect").alias("_start"))
            started = blocks.withColumn("_run", run).join(starts, ["_run", "_block"])
        kind = f"struct<now:{EFFECT},used:array<struct<_at:bigint,effect:{EFFECT}>>>"
        first = F.struct(F.col("_start").alias("now"), F.array().alias("used")).cast(kind)

        def add(acc: Column, x: Column) -> Column:
            mine = F.struct(x["_at"].alias("_at"), acc["now"].alias("effect"))
            return F.struct(then(acc["now"], x["effect"]).alias("now"), F.concat(acc["used"], F.array(mine)).alias("used")).cast(kind)

        return started.select("run_id", F.inline(F.aggregate("_list", first, add, lambda acc: acc["used"])))

    parts = rows.select("run_id", F.col("iteracion").cast("bigint").alias("_at"), "effect")
    return before(parts, levels).withColumnRenamed("_at", "iteracion")


def fold(rows: DataFrame, enricher: bool = False, levels: int = LEVELS) -> DataFrame:
    """The last configuration of each run that has a proposal with effect: one row with its fields.

    Runs may have any length; where each has as many proposals as the loop has iterations, one level does.
    """
    whole = composed(steps(rows, enricher), levels).where("counts")
    return whole.select("run_id", applied(initial(), F.col("effect")).alias("c")).select("run_id", "c.*")


def trajectory(rows: DataFrame, enricher: bool = False, levels: int = LEVELS) -> DataFrame:
    """The configuration used in each iteration (before its proposal is applied).

    Every iteration of ``rows`` has a row, also one whose proposal is a reject.
    """
    used = composed_before(steps(rows, enricher), levels)
    return used.select("run_id", "iteracion", applied(initial(), F.col("effect")).alias("c")).select("run_id", "iteracion", "c.*")


def looped(rows: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """``rows`` with each ``iterations`` numbers of a run as a run of its own, one pass of the loop.

    ``run_id`` becomes the pair of itself and ``ciclo`` (from 0), and ``iteracion`` starts at 1 in each.
    """
    cycle = F.expr(f"(iteracion - 1) div {iterations}").alias("ciclo")
    return rows.withColumns({"run_id": F.struct("run_id", cycle), "iteracion": (F.col("iteracion") - 1) % iterations + 1})


def numbered(rows: DataFrame, order: str, iterations: int = ITERATIONS, width: int = WIDTH) -> DataFrame:
    """``rows`` numbered from 1 by the whole-numbered column ``order`` in each run, as ``looped`` runs of ``iterations``.

    A run is numbered by blocks of ``width`` values of ``order``, each starting from the count of the blocks before, so the
    rows of a very large run are sorted by many tasks. Null run_ids are one run.
    """
    # Runs without id are one run, as a struct of a null is equal to itself.
    key = ["_run", "_block"]
    marked = rows.withColumns({"_run": F.struct("run_id"), "_block": F.expr(f"`{order}` div {width}")})
    earlier = W.partitionBy("_run").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = marked.groupBy(*key).agg(F.count("*").alias("_n")).select(*key, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    number = F.row_number().over(W.partitionBy(*key).orderBy(order))
    joined = marked.withColumn("_number", number).join(starts, key)
    return looped(joined.withColumn("iteracion", F.col("_start") + F.col("_number")), iterations).drop(*key, "_start", "_number")


def full_config() -> Column:
    """All eight fields of a configuration; four of them never change."""
    c = F.col
    return F.struct(
        c("max_eventos"), c("busquedas_facebook"), c("timeout"), c("priorizar_paises"),
        F.lit(FROZEN["extraer_contactos"]).alias("extraer_contactos"),
        F.array().cast("array<string>").alias("agregar_fuentes"),
        F.lit(FROZEN["profundidad_busqueda"]).cast("bigint").alias("profundidad_busqueda"),
        F.lit(FROZEN["buscar_en_grupos"]).alias("buscar_en_grupos"),
    )


def range_violations() -> Column:
    """Names of the numbers outside their documented range, comma-joined (the fold does not enforce it)."""
    return F.concat_ws(",", *[F.when(~F.col(n).between(low, high), n) for n, (low, high) in RANGES.items()])
