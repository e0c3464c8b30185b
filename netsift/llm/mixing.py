"""Mix sources to target weights by entropy balancing; DataFrame functions only.

The token constraint of each source has one dual variable. Rates ``min(2, exp(lambda * size / mean size))`` are the
exponential tilt that meets it; Newton steps on the dual, guarded by a bracket, run as Spark aggregations over the
histogram (source, size, count), so that a source with a third of all rows is summed before it is shuffled.
Rates are then rounded into 0, 1 or 2 copies so that each source's words come near its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, forget, keep

MAX_COPIES = 2
NEWTON_STEPS = 60
TOLERANCE = 1e-7
#: Cells of the rounding margin in a source; a constant of the method, not of the data.
CELLS = 4096
FILL_PASSES = 6


def sized(docs: DataFrame) -> DataFrame:
    """Words of each text as ``size``; null text: 0."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, cap: float = MAX_COPIES) -> DataFrame:
    """Per source (by code point, null last): source_size, weight, target.

    The sources share ``share`` times all words by weight; a target stops at ``cap`` times its source's size and the
    excess goes to the others by weight until none is above: sources fill up in the order of cap over weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.lit(float(cap)) * F.col("source_size"))
    per = per.withColumn("fills_at", F.col("cap") / F.col("weight"))
    by = Window.orderBy("fills_at", F.col("source").isNull(), "source")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    rest = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    per = per.withColumn("level", level)
    open_level = F.min(F.when(F.col("level") <= F.col("fills_at"), F.struct("fills_at", "level"))).over(Window.partitionBy())["level"]
    target = F.when(open_level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), open_level * F.col("weight")))
    return per.withColumn("target", target).select("source", "source_size", "n_docs", "weight", "cap", "target")


def _rate(x: Column, tilt: Column) -> Column:
    return F.least(F.lit(float(MAX_COPIES)), F.exp(F.least(tilt * x, F.lit(50.0))))


def balance(sizes: DataFrame, goal: DataFrame) -> DataFrame:
    """Per source the dual variable ``tilt`` (null: every document at the highest rate), with the columns of goal.

    sizes: source, size. Each step is one aggregation of the histogram; the new state is written out, so that a step's
    plan never holds the plans of the steps before it.
    """
    hist = keep(sizes.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "hist")
    mean = F.col("source_size") / F.col("n_docs")
    least = hist.groupBy("source").agg(F.min("size").alias("least"))
    state = goal.join(least.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    x_min = F.col("least") / mean
    full = (F.col("target") >= F.col("cap") * (1 - 1e-12)) | F.col("least").isNull()
    state = state.withColumns(
        {
            "mean": mean,
            "full": full,
            "low": F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size")) / x_min),
            "high": F.log(F.lit(float(MAX_COPIES))) / x_min,
            "tilt": F.when(~full, F.lit(0.0)),
            "error": F.lit(1.0),
        }
    )
    state = keep(state, "dual")
    for _ in range(NEWTON_STEPS):
        s = state.where("not full").select(F.col("source").alias("_s"), "mean", "tilt")
        both = hist.join(s, F.col("source").eqNullSafe(F.col("_s")))
        x = F.col("size") / F.col("mean")
        rate, words = _rate(x, F.col("tilt")), F.col("n") * F.col("size")
        sums = both.groupBy("_s").agg(
            F.sum(words * rate).alias("taken"), F.sum(F.when(rate < MAX_COPIES, words * x * rate).otherwise(0.0)).alias("slope")
        )
        gap = F.col("taken") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("new_low")) & (newton < F.col("new_high"))
        following = (
            state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left")
            .withColumns({"new_low": low, "new_high": high})
            .withColumn("error", F.when(F.col("full") | gap.isNull(), 0.0).otherwise(F.abs(gap) / F.col("target")))
            .withColumn("tilt", F.when(F.col("error") > TOLERANCE, F.when(inside, newton).otherwise((F.col("new_low") + F.col("new_high")) / 2)).otherwise(F.col("tilt")))
            .withColumns({"low": F.col("new_low"), "high": F.col("new_high")})
            .select(state.columns)
        )
        following = keep(following, "dual")
        forget(state)
        state = following
        if (state.agg(F.max("error")).first()[0] or 0.0) <= TOLERANCE:
            break
    forget(hist)
    return state.select(*goal.columns, "tilt")


def copies(rows: DataFrame, duals: DataFrame) -> DataFrame:
    """Round rates into ``copies``; rows: doc_id, source, size. Adds rate, source_size, target, copies, taken.

    A document keeps the whole part of its rate and one copy more if its margin, the fractional part less a hash of its
    doc_id in [0, 1), lies above its source's cut. The cut is read from a histogram of margins, so that the words taken
    are at most the target; then single documents, the one nearest to what is left or over first, gain or lose a copy as long as that comes nearer.
    """
    d = duals.select(F.col("source").alias("_s"), "source_size", "n_docs", "target", "tilt")
    rows = rows.join(d, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    x = F.col("size") / (F.col("source_size") / F.col("n_docs"))
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("tilt").isNull(), float(MAX_COPIES)).otherwise(_rate(x, F.col("tilt")))
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    rows = rows.withColumn("rate", rate).withColumn("whole", F.floor("rate").cast("int"))
    rows = rows.withColumn("cell", F.when((F.col("whole") < MAX_COPIES) & (F.col("size") > 0), F.floor((F.col("rate") - F.col("whole") - u + 1) * (CELLS // 2)).cast("int")))
    rows = keep(rows, "rates")
    cells = rows.groupBy("source", "cell").agg(
        F.sum(F.col("whole") * F.col("size")).alias("base"), F.sum(F.when(F.col("cell").isNotNull(), F.col("size")).otherwise(0)).alias("extra"), F.first("target").alias("target")
    )
    one = Window.partitionBy("source")
    down = one.orderBy(F.desc_nulls_last("cell")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumns({"base_all": F.sum("base").over(one), "above": F.sum("extra").over(down)})
    fits = F.col("cell").isNotNull() & (F.col("base_all") + F.col("above") <= F.col("target"))
    cut = cells.groupBy("source").agg(F.coalesce(F.min(F.when(fits, F.col("cell"))), F.lit(CELLS + 1)).alias("cut"))
    cut = cut.withColumnRenamed("source", "_s")
    taken = rows.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    taken = taken.withColumn("copies", F.col("whole") + F.coalesce(F.col("cell") >= F.col("cut"), F.lit(False)).cast("int"))
    taken = keep(taken.select("doc_id", "source", "size", "source_size", "target", "rate", "copies"), "copies")
    forget(rows)
    for _ in range(FILL_PASSES):
        left = taken.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("left"))
        left = left.select(F.col("source").alias("_s"), "left")
        room = F.when(F.col("left") > 0, F.col("copies") < MAX_COPIES).otherwise(F.col("copies") > 0)
        miss = F.abs(F.abs("left") - F.col("size"))
        open_ = taken.join(left, F.col("source").eqNullSafe(F.col("_s"))).where(room & (F.col("size") > 0) & (miss < F.abs("left")))
        pick = open_.groupBy("_s").agg(F.min(F.struct(miss, "doc_id", F.signum("left").cast("int").alias("step"))).alias("pick")).select("_s", F.col("pick.doc_id").alias("_d"), F.col("pick.step").alias("_k"))
        same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("doc_id") == F.col("_d"))
        more = taken.join(pick, same, "left").withColumn("copies", F.col("copies") + F.coalesce("_k", F.lit(0))).select(taken.columns)
        more = keep(more, "copies")
        forget(taken)
        taken = more
    return taken.withColumn("taken", F.col("copies") * F.col("size"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken.

    docs needs doc_id, text, source; other columns are ignored, whatever their names. A null or empty text has size 0,
    rate 1 and takes nothing. Null is a source like any other, last in order. A doc_id is taken to name one row: rows
    that repeat a doc_id are rounded alike. An empty table gives an empty result. Reruns give the same rows.
    """
    sizes = keep(sized(docs).select("doc_id", "source", "size"), "sizes")
    out = copies(sizes, balance(sizes.select("source", "size"), targets(sizes, weights, share)))
    forget(sizes)
    return out
