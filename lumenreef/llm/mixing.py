"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, and of all rates that meet the token target of every source (the sum of rate
times size) those nearest to 1 in relative entropy are taken. They are exponential tilts,
``exp(t * size)`` with one multiplier ``t`` for each source, cut off at ``most`` copies. The multipliers
solve the convex dual by Newton iterations, each one aggregate over the table of sizes; where a Newton step
leaves the bracket of signs seen so far, it is halved instead. Then rates are rounded into
copies: a document keeps the whole part, and the rest is decided by thresholds on its
hash, from the longest documents of a source to the shortest, where each class of lengths makes up for
what the longer ones took too much or too little.

All of it is DataFrame expressions. Rates depend on source and size only, so the iterations run on counts of
documents by source and size, which a task combines before they are shuffled; no step gathers
a source. Sums are of decimals and integers, so they do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenreef.llm._scratch import Scratch

WEIGHTS = (1, 2, 3)
#: Copies of a document, and so tokens of a source, are at most so many times the given ones.
MOST = 3
#: Parts of the range of hashes at which a class of lengths can be cut.
PARTS = 1024
#: A multiplier is done when its source's tokens are within this part of the target, or a thousandth of a token.
TOLERANCE = 1e-7
ITERATIONS = 200
_ONE = 1 << 20  # parts of a copy are counted in these


def n_words(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null. Each word with the space after it becomes one character."""
    lead = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]++", "")
    return F.length(F.regexp_replace(lead, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")).cast("bigint")


def _key(source: Column) -> Column:
    """Text whose order is that of sources by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def _ranked(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """``sources`` with ``rank`` from 0 by ``key``, numbered by ranges of keys and not in one task."""
    ordered = scratch.keep(sources.orderBy("key").withColumn("_at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("_at", 33).alias("_part")
    sizes = ordered.groupBy(part).agg(F.count("*").alias("_n"))  # a row for each range
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("_part", before.alias("_start")))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.withColumn("_part", part).join(starts, "_part").withColumn("rank", F.col("_start") + place).drop("_at", "_part", "_start")


def source_targets(sources: DataFrame, most: float = MOST) -> DataFrame:
    """``sources(.., source_size, weight)`` with ``target``: shares of all sizes by weight, at most ``most`` times the source's.

    What a source cannot take is shared again among the others by weight, until none is above.
    Sources of size 0 have target 0; weights are above 0.
    """
    cap = F.col("source_size") * F.lit(float(most))
    level = 0.0
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        left, weight = sources.agg(
            (F.sum("source_size") - F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0))).alias("a"), F.sum(F.when(~full, F.col("weight"))).alias("b")
        ).first()
        if not weight:
            break
        higher = left / weight
        if higher <= level * (1 + 1e-13):
            break
        level = higher
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def _rate(multiplier: Column, size: Column, scale: Column, most: float) -> Column:
    """The tilt cut off at ``most``; a null multiplier stands for the cut-off itself."""
    return F.coalesce(F.least(F.exp(multiplier * size / scale), F.lit(float(most))), F.lit(float(most)))


def balance(sizes: DataFrame, targets: DataFrame, most: float, scratch: Scratch) -> DataFrame:
    """``targets(key, source_size, target, ..)`` with ``scale`` and ``multiplier``, so that rates times sizes meet each target.

    ``sizes`` has key, size and the number of documents ``n``. A source whose target is ``most`` times its size gets a
    null multiplier.
    """
    tokens = F.col("n") * F.col("size")
    scale = sizes.groupBy("key").agg((F.sum(tokens.cast("decimal(38,0)") * F.col("size")) / F.sum(tokens)).cast("double").alias("scale"))
    free = targets.join(scale, "key").where((F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * F.lit(float(most)) * (1 - 1e-12)))
    start = F.log(F.col("target") / F.col("source_size"))
    nothing = F.lit(None).cast("double")
    state = free.select("key", "target", "scale", start.alias("multiplier"), nothing.alias("low"), nothing.alias("high"), F.lit(False).alias("done"))
    state = scratch.keep(state, "multipliers")
    rate = _rate(F.col("multiplier"), F.col("size"), F.col("scale"), most)
    for _ in range(ITERATIONS):
        taken = tokens * rate
        slope = F.when(rate < most, taken * F.col("size") / F.col("scale")).otherwise(0.0)
        open_ = state.where(~F.col("done"))
        exact = [F.sum(x.cast("decimal(34,6)")).cast("double").alias(name) for x, name in ((taken, "taken"), (slope, "slope"))]
        sums = sizes.join(open_.select("key", "multiplier", "scale"), "key").groupBy("key").agg(*exact)
        gap = F.col("taken") - F.col("target")
        low = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("high"))
        moved = state.join(sums, "key", "left").withColumns({"_gap": gap, "_low": low, "_high": high})
        newton = F.col("multiplier") - F.col("_gap") / F.nullif(F.col("slope"), F.lit(0.0))
        inside = (newton > F.coalesce("_low", F.lit(float("-inf")))) & (newton < F.coalesce("_high", F.lit(float("inf"))))
        wider = F.col("multiplier") - F.signum("_gap") * (1 + 2 * F.abs("multiplier"))
        halved = F.coalesce((F.col("_low") + F.col("_high")) / 2, wider)
        done = F.col("done") | (F.abs("_gap") <= F.greatest(F.lit(0.001), F.col("target") * TOLERANCE))
        after = moved.select(
            "key", "target", "scale",
            F.when(done, F.col("multiplier")).when(inside, newton).otherwise(halved).alias("multiplier"),
            F.col("_low").alias("low"), F.col("_high").alias("high"), done.alias("done"),
        )
        before, state = state, scratch.keep(after, "multipliers")
        scratch.drop(before)
        if not state.where(~F.col("done")).head(1):
            break
    return targets.join(state.select("key", "scale", "multiplier"), "key", "left").withColumn("scale", F.coalesce("scale", F.lit(1.0)))


def _thresholds(docs: DataFrame, balanced: DataFrame, most: int) -> DataFrame:
    """``key, cuts, ups, downs``: for each class of lengths the last part of the hashes that gets one copy more, and
    the parts whose documents then get another copy more or less.

    A source has at most 64 classes of at most ``PARTS`` parts, whatever its number of documents.
    """
    rows = docs.where(F.col("size") > 0)

    def tokens(of: Column) -> Column:
        return F.sum(F.when(of, F.col("size")).otherwise(0))

    binned = rows.groupBy("key", "class", "part").agg(
        tokens(F.col("whole") < most).alias("tokens"), tokens(F.col("whole") < most - 1).alias("twice"), tokens(F.col("whole") > 0).alias("held"),
        F.sum((F.col("rest") * F.col("size")).cast("decimal(38,0)")).alias("planned"),
        F.sum(F.col("whole") * F.col("size")).alias("whole"),
    )
    bins = F.array_sort(F.collect_list(F.struct("part", "tokens", "twice", "held")))
    classes = binned.groupBy("key", "class").agg((F.sum("planned") / _ONE).cast("double").alias("planned"), F.sum("whole").alias("whole"), bins.alias("bins"))
    listed = F.sort_array(F.collect_list(F.struct("class", "planned", "bins")), asc=False).alias("classes")
    by_source = classes.groupBy("key").agg(listed, F.sum("planned").alias("planned"), F.sum("whole").alias("whole"))
    by_source = by_source.join(balanced.select("key", "target"), "key")

    def nearest(need: Column, bins: Column) -> Column:
        """The end of the bins from the first on that hold about ``need`` tokens, and their tokens."""
        start = F.struct(F.lit(-1).alias("cut"), F.lit(0).cast("bigint").alias("best"), F.lit(0).cast("bigint").alias("sum"))

        def add(acc: Column, bin_: Column) -> Column:
            total = acc["sum"] + bin_["tokens"]
            better = F.abs(total - need) < F.abs(acc["best"] - need)
            return F.struct(F.when(better, bin_["part"]).otherwise(acc["cut"]).alias("cut"), F.when(better, total).otherwise(acc["best"]).alias("best"), total.alias("sum"))

        return F.aggregate(bins, start, add)

    def empty(kind: str) -> Column:
        return F.array().cast(f"array<{kind}>")

    # Tokens owed when the class at hand begins: what the longer classes took too little.
    owed = (F.col("target") - F.col("whole") - F.col("planned")).cast("double")

    def deal(acc: Column, c: Column) -> Column:
        need = acc["owed"] + c["planned"]
        found = nearest(need, c["bins"])
        mine = F.struct(c["class"].alias("class"), found["cut"].alias("cut"))
        return F.struct((need - found["best"]).alias("owed"), F.concat(acc["cuts"], F.array(mine)).alias("cuts"))

    dealt = F.aggregate("classes", F.struct(owed.alias("owed"), empty("struct<class:int,cut:int>").alias("cuts")), deal)
    cut = by_source.select("key", "classes", dealt["owed"].alias("owed"), F.map_from_entries(dealt["cuts"]).alias("cuts"))

    # What is still owed in the end goes to single parts, or is taken from them, the longest documents first.
    def adjust(acc: Column, c: Column) -> Column:
        def one(acc: Column, bin_: Column) -> Column:
            raised = bin_["part"] <= F.element_at("cuts", c["class"])
            up = F.when(raised, bin_["twice"]).otherwise(bin_["tokens"])
            down = -F.when(raised, bin_["tokens"]).otherwise(bin_["held"])
            change = F.when(acc["owed"] > 0, up).otherwise(down)
            better = F.abs(acc["owed"] - change) < F.abs(acc["owed"])
            code = F.array(c["class"] * PARTS + bin_["part"])
            return F.struct(
                F.when(better, acc["owed"] - change).otherwise(acc["owed"]).alias("owed"),
                F.when(better & (change > 0), F.concat(acc["ups"], code)).otherwise(acc["ups"]).alias("ups"),
                F.when(better & (change < 0), F.concat(acc["downs"], code)).otherwise(acc["downs"]).alias("downs"),
            )

        return F.aggregate(c["bins"], acc, one)

    done = F.aggregate("classes", F.struct("owed", empty("int").alias("ups"), empty("int").alias("downs")), adjust)
    return cut.select("key", "cuts", done.alias("_d")).select("key", "cuts", "_d.ups", "_d.downs")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies`` for every row of ``docs``.

    Sources in the order of code points, null last, weigh ``weights``, repeating; the sum of all sizes is shared by
    weight, where no source takes more than ``most`` times its own. Size is the number of words. Null and
    empty texts have size 0 and one copy. Rows with one doc_id, source and text get the same number of copies, also without
    doc_id. Other columns are left out; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    sized = docs.select(
        "doc_id", "source", _key(F.col("source")).alias("key"), n_words(F.col("text")).alias("size"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(_ONE)).cast("int").alias("chance"),
    )
    sized = scratch.keep(sized, "sizes")
    counted = scratch.keep(sized.groupBy("key", "size").agg(F.count("*").alias("n")), "size-counts")
    sources = counted.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = _ranked(sources, scratch).select("key", "source_size", F.get(cycle, (F.col("rank") % len(weights)).cast("int")).alias("weight"))
    targets = scratch.keep(source_targets(scratch.keep(weighed, "weights"), most), "targets")
    balanced = scratch.keep(balance(counted, targets, most, scratch), "balanced")
    # The part of a copy beyond the whole ones, in units that add up exactly.
    units = F.floor(_rate(F.col("multiplier"), F.col("size"), F.col("scale"), most) * _ONE)
    rated = sized.join(balanced.select("key", "source_size", "target", "scale", "multiplier"), "key").withColumns({"rate": units / _ONE, "_units": units})
    rated = rated.withColumns({"whole": F.expr(f"_units div {_ONE}"), "rest": F.col("_units") % _ONE})
    rated = rated.withColumns(
        {
            "class": F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int"),
            "part": F.floor((F.col("chance") - F.col("rest") + _ONE) * PARTS / (2 * _ONE)).cast("int"),
        }
    )
    cuts = scratch.keep(_thresholds(rated, balanced, most), "cuts")
    raised = F.col("part") <= F.element_at("cuts", F.col("class"))
    code = F.col("class") * PARTS + F.col("part")
    given = F.least(F.col("whole") + F.when(raised, 1).otherwise(0) + F.when(F.array_contains("ups", code), 1).otherwise(0), F.lit(most))
    # A part that was raised gives back only what it got.
    back = F.array_contains("downs", code) & F.when(raised, F.col("whole") < most).otherwise(F.col("whole") > 0)
    copies = F.when(F.col("size") == 0, 1).otherwise(given - F.when(back, 1).otherwise(0)).cast("bigint")
    return rated.join(cuts, "key", "left").select("doc_id", "source", "size", "source_size", "target", "rate", copies.alias("copies"))


def mixing_report(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every document: the words that the mix takes of it."""
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
