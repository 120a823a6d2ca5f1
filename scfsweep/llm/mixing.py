"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Each source has a target in words. Among all document rates between 0 and ``CAP`` that meet the targets,
entropy balancing takes those closest (in relative entropy with an upper bound) to rate 1 for everyone:
rate = CAP / (1 + (CAP - 1) * exp(-t * x)), where x is the document's size over the mean size of the
source and t the source's multiplier, the one unknown of the convex dual. Newton's method finds all t at
once: a step is one aggregation of (source, size, rows), kept within a bracket so that it always converges.
Rates depend on source and size alone, so the iterations read that histogram and never the documents.

Rates become copies by systematic rounding: along the documents of a source in order of size, the n-th
carry of the summed fractions adds a copy. Neighbours have like sizes, so the words taken miss the target
by about one long document at most. Equal sizes are told apart by a hash and dealt to ``SALTS`` parts,
so a source or a size with a large share of all rows is never one task. Rows alike in id, text and source
are one row with a count until copies are given out.

A null text has size 0; documents of size 0 are never taken. A null source is a source, the last one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scfsweep.llm.common import ROW_KEYS, repeated, staged, table, with_row_keys

CAP = 2.0
WEIGHTS = (5, 2, 1)
SHARE = 1.5
SALTS = 256
OFFSETS = 32
MAX_STEPS = 40
TOLERANCE = 1e-9

#: a null source becomes '', any other gets a sign in front, so that sources can be joined by name
NAMED = "coalesce(concat('=', source), '') as source"
#: words of a text, a null having none
SIZE = r"cast(coalesce(regexp_count(text, r'[^\x20\x09-\x0D]+'), 0) as long)"


def targets(sources: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size) -> also target: ``share`` of all words dealt by repeating weights.

    No target exceeds cap times its source's size; what is over goes to the others by weight. That is a
    level L with target = min(cap * size, L * weight): sources fill in order of cap * size / weight, and
    the level is what is left for the first that doesn't fill, and all after it, by their weights.
    """
    by_name = Window.orderBy(F.col("source") == "", F.col("source").cast("binary"))
    order = Window.orderBy("full_at", "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    placed = (
        sources.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("most", cap * F.col("source_size"))
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("all_words", F.sum("source_size").over(everything) * share)
    )
    left = F.col("all_words") - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = placed.withColumn("level", left / weight_left)
    # the first source that the level doesn't fill fixes it
    level = F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "place", "level"))).over(everything)["level"]
    return levels.withColumn("target", F.least(F.col("most"), F.coalesce(level, F.col("full_at")) * F.col("weight"))).select("source", "source_size", "target")


def _rate(t: str, cap: float) -> str:
    return f"{cap} / (1 + {cap - 1} * exp(greatest(-700, least(700, -{t} * x))))"


def balance(spark: SparkSession, histogram: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, t) by Newton's method on (source, size, n) and (source, source_size, target)."""
    means = histogram.filter("size > 0").groupBy("source").agg((F.sum(F.expr("size * n")) / F.sum("n")).alias("mean_size"))
    bins = staged(
        spark,
        histogram.filter("size > 0").join(means, "source").select("source", F.col("size").cast("double").alias("size"), "n", (F.col("size") / F.col("mean_size")).alias("x")),
        "bins",
    )
    # full and empty sources need no multiplier; 50 stands for infinity in either direction
    state = goals.filter("source_size > 0").selectExpr(
        "source", "target", "source_size", "-1e6D as low", "1e6D as high", "0D as t", f"target >= {cap} * source_size or target <= 0 as done"
    )
    # decimal sums don't depend on the order of addition, so reruns agree to the last copy
    exact = lambda e: F.sum(F.expr(f"cast({e} as decimal(38, 9))")).cast("double")
    for _ in range(MAX_STEPS):
        state = staged(spark, state, "multipliers")
        if not state.filter("not done").limit(1).count():
            break
        rate = F.expr(_rate("t", cap))
        sums = (
            bins.join(state.filter("not done"), "source")
            .select("source", (F.col("size") * F.col("n")).alias("words"), "x", rate.alias("r"))
            .groupBy("source")
            .agg(exact("words * r").alias("got"), exact(f"words * x * r * (1 - r / {cap})").alias("slope"))
        )
        step = state.join(sums, "source", "left")
        step = step.withColumn("low", F.expr("if(not done and got < target, t, low)")).withColumn("high", F.expr("if(not done and got > target, t, high)"))
        step = step.withColumn("newton", F.expr("t + (target - got) / slope"))
        # where a step leaves the bracket, halve it, or double t while it has no other end yet
        inside = "newton > low and newton < high and abs(newton - t) <= 4 + 2 * abs(t)"
        other = "case when high >= 1e6 then 2 * abs(t) + 1 when low <= -1e6 then -2 * abs(t) - 1 else (low + high) / 2 end"
        state = step.selectExpr(
            "source", "target", "source_size", "low", "high",
            f"if(done or abs(got - target) <= {TOLERANCE} * target, t, if({inside}, newton, {other})) as t",
            f"done or abs(got - target) <= {TOLERANCE} * target or high - low < 1e-12 as done",
        )
    return state.select("source", "t")


def planned(spark: SparkSession, docs: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, cap: float = CAP, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for all rows of docs(doc_id, text, source) that are alike, ``n`` of them, with rate and carries.

    Its i-th row has place k + i among the rows of its source and size. docs' columns ``keep`` stay.
    """
    described = docs.select("doc_id", F.expr(NAMED), F.expr(SIZE).alias("size"), F.xxhash64("doc_id", "text", "source").alias("h"), *keep)
    alike = described.groupBy(*described.columns).agg(F.count("*").alias("n"))
    sized = staged(spark, alike.withColumn("salt", F.pmod("h", F.lit(SALTS)).cast("int")), "sizes")
    parts = staged(spark, sized.groupBy("source", "size", "salt").agg(F.sum("n").alias("n")), "parts")
    # read for sizes, means and rates: written, or each of these plans would hold the whole of those before it
    histogram = staged(spark, parts.groupBy("source", "size").agg(F.sum("n").alias("n")), "histogram")
    sources = histogram.groupBy("source").agg(F.sum(F.expr("size * n")).alias("source_size"))
    goals = staged(spark, targets(sources, share, weights, cap), "targets")
    found = balance(spark, histogram, goals, cap)
    x = histogram.filter("size > 0").groupBy("source").agg((F.sum(F.expr("size * n")) / F.sum("n")).alias("mean_size"))
    state = goals.join(found, "source", "left").join(x, "source", "left")
    rated = histogram.join(state, "source").select("source", "size", "n", "source_size", "target", "t", (F.col("size") / F.col("mean_size")).alias("x"))
    rated = rated.withColumn("rate", F.expr(f"case when size = 0 or target <= 0 then 0D when target >= {cap} * source_size then {cap}D else {_rate('t', cap)} end"))
    rated = rated.withColumn("whole", F.floor("rate")).withColumn("part", F.col("rate") - F.floor("rate"))
    along = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rated = staged(spark, rated.withColumn("before", F.coalesce(F.sum(F.expr("part * n")).over(along), F.lit(0.0))), "rated")
    # where the carries begin is free: of OFFSETS starts take the one that comes nearest to the target
    off = [
        F.struct(
            F.abs(F.sum(F.expr(f"size * (whole * n + floor(before + {k / OFFSETS} + part * n) - floor(before + {k / OFFSETS}))")) - F.first("target")).alias("off"),
            F.lit(k / OFFSETS).alias("offset"),
        )
        for k in range(OFFSETS)
    ]
    offsets = rated.groupBy("source").agg(F.least(*off)["offset"].alias("offset"))
    rated = staged(spark, rated.join(offsets, "source").withColumn("before", F.col("before") + F.col("offset")).drop("x", "t", "n", "offset"), "rates")
    within = Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("start", F.coalesce(F.sum("n").over(within), F.lit(0)))
    plan = starts.join(rated, ["source", "size"]).select(
        "source", "size", "salt", "source_size", "target", "rate", "whole", "part", "before", "start"
    )
    earlier = Window.partitionBy("source", "size", "salt").orderBy("h", "doc_id", *keep).rowsBetween(Window.unboundedPreceding, -1)
    ranked = sized.withColumn("k", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return ranked.join(plan, ["source", "size", "salt"]).select(
        "doc_id", "source", "size", "h", "source_size", "target", "rate", "whole", "part", "before", (F.col("start") + F.col("k")).alias("k"), "n", *keep
    )


def mix(spark: SparkSession, docs: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """docs(doc_id, text, source) -> doc_id, source, size, source_size, target, rate, copies, one row each."""
    each = repeated(planned(spark, docs, share, weights, cap), "n", "nth", "h").withColumn("k", F.col("k") + F.col("nth"))
    carry = F.expr("cast(floor(before + part * (k + 1)) - floor(before + part * k) as long)")
    return each.select("doc_id", F.expr("if(source = '', null, substr(source, 2))").alias("source"), "size", "source_size", "target", "rate", F.least(F.col("whole") + carry, F.lit(int(cap)).cast("long")).alias("copies"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents."""
    return mix(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies"
    )


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs, each row as often as the mix takes it; rows alike in id, text and source share their copies.

    Alike rows are counted where they are read (``__part``), and each such part starts where earlier ones
    end, so even the rows of one document are ranked by many tasks.
    """
    keyed = staged(spark, with_row_keys(docs, "doc_id", "text", "source").withColumn("__part", F.spark_partition_id()), "keyed")
    all_copies = F.expr("whole * n + cast(floor(before + part * (k + n)) - floor(before + part * k) as long)")
    plan = planned(spark, keyed.select("doc_id", "text", "source", *ROW_KEYS), keep=ROW_KEYS)
    taken = plan.groupBy(*ROW_KEYS).agg(F.sum(all_copies).alias("__copies"), F.sum("n").alias("__n")).filter("__copies > 0")
    earlier = Window.partitionBy(*ROW_KEYS).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy(*ROW_KEYS, "__part").agg(F.count("*").alias("__here"))
    starts = counts.withColumn("__start", F.coalesce(F.sum("__here").over(earlier), F.lit(0))).join(taken, list(ROW_KEYS)).drop("__here")
    found = keyed.join(starts, [*ROW_KEYS, "__part"])
    nth = F.row_number().over(Window.partitionBy(*ROW_KEYS, "__part").orderBy("doc_id")) - 1 + F.col("__start")
    own = F.floor((nth + 1) * F.col("__copies") / F.col("__n")) - F.floor(nth * F.col("__copies") / F.col("__n"))
    counted = found.withColumn("__own", own.cast("int")).filter("__own > 0")
    return counted.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__own")))).select(*docs.columns)
