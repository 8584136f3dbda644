"""Mixing sources to target weights by entropy balancing.

Every document gets a rate. Of all rates whose expected words meet each source's target, the
chosen ones are closest to 1 in relative entropy: exp(lambda_s * size / scale_s), an exponential
tilt, never above the repeat limit. The dual is convex and has one variable per source; Newton
steps, kept in a bracket, solve it for all sources at once. A step is one aggregation over
(source, size, documents), the exact sufficient statistic of the corpus, so texts are read once.

Rates become copies by a threshold on a hash of the id. What the rounding leaves over per source
is given to (or taken from) the documents nearest their rounding edge; a radix histogram finds
how far, so a source misses its target by at most about half of one document.

Nulls: a null text has size 0; a null source is a source of its own, last in order; null ids hash
alike. Documents of size 0 keep rate 1. Repeated rows count each, with equal copies. An empty
table gives an empty result. Extra columns are kept by `mixed`; helper columns begin with `_mix_`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import cut_lineage, quoted, word_count

WEIGHTS = (1, 2, 3)
REPEATS = 3
_TOLERANCE = 1e-9
_MAX_STEPS = 60
# Rounding keys have 30 bits, found 10 bits a pass.
_KEY_BITS, _PASS_BITS = 30, 10
# Places where the documents of one source meet its state.
SALTS = 64


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Adds `target` to rows (source, source_size): shares of all words by weight, none above
    `repeats` times its source, the excess given to the others by weight.

    Sources are ordered by how soon they fill up; the first that does not fill sets the level of
    all the rest. Both windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ring = F.array(*[F.lit(int(w)) for w in weights])
    rows = sources.withColumn("_n", F.row_number().over(by_name) - 1)
    rows = rows.withColumn("_w", F.element_at(ring, (F.col("_n") % len(weights) + 1).cast("int")).cast("long"))
    rows = rows.withColumn("_limit", F.col("source_size") * repeats)
    filling = Window.orderBy(F.col("_limit") / F.col("_w"), F.col("_n"))
    everything = Window.partitionBy()
    before = F.sum("_limit").over(filling) - F.col("_limit")
    rows = rows.withColumns({
        "_left": F.sum("source_size").over(everything) - before,
        "_weights": F.sum("_w").over(everything) - F.sum("_w").over(filling) + F.col("_w"),
    })
    open_ = F.col("_limit") * F.col("_weights") > F.col("_w") * F.col("_left")
    place = F.struct(F.col("_limit") / F.col("_w"), "_n")
    rows = rows.withColumn("_at", F.min_by(F.struct("_left", "_weights"), F.when(open_, place)).over(everything))
    level = F.col("_w") * F.col("_at._left") / F.col("_at._weights")
    target = F.when(F.col("_at").isNull(), F.col("_limit").cast("double")).otherwise(F.least(F.col("_limit").cast("double"), level))
    return rows.withColumn("target", F.coalesce(target, F.lit(0.0))).select("source", "source_size", "target")


def _rate(size: Column, repeats: int) -> Column:
    tilt = F.least(F.lit(700.0), F.col("lam") * size / F.col("scale"))
    free = F.least(F.lit(float(repeats)), F.exp(tilt))
    return F.when(size == 0, F.lit(1.0)).when(F.col("full"), F.lit(float(repeats))).otherwise(free)


def dual(sizes: DataFrame, goal: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Solves the dual: rows of `goal` with `lam`, `scale` and `full` (at the repeat limit).

    `sizes` has (source, size, docs), `goal` (source, source_size, target).
    """
    scale = sizes.groupBy("source").agg(F.try_divide(F.sum(F.col("docs") * F.col("size") * F.col("size")), F.sum(F.col("docs") * F.col("size"))).alias("scale"))
    state = goal.alias("g").join(scale.alias("c"), F.col("g.source").eqNullSafe(F.col("c.source"))).select("g.*", "c.scale")
    ratio = F.try_divide("target", "source_size")
    empty = F.col("source_size") == 0
    cap = F.log(F.lit(float(repeats)))
    state = state.select(
        "source", "source_size", "target",
        F.when(empty, F.lit(1.0)).otherwise(F.col("scale")).alias("scale"),
        (~empty & (F.col("target") >= F.col("source_size") * repeats)).alias("full"),
        # With sizes of at least one word these bounds bracket the solution.
        F.when(empty | (ratio >= 1), F.lit(0.0)).otherwise(F.col("scale") * F.log(ratio)).alias("low"),
        F.when(empty | (ratio < 1), F.lit(0.0)).otherwise(F.col("scale") * cap).alias("high"),
        F.when(empty, F.lit(0.0)).otherwise(F.log(ratio)).alias("lam"),
        F.when(empty, F.lit(0.0)).otherwise(F.lit(1.0)).alias("miss"),
    )
    state = cut_lineage(state)
    live = sizes.where("size > 0")
    keep = [c for c in state.columns if c != "miss"]
    for _ in range(_MAX_STEPS):
        r = _rate(F.col("size"), repeats)
        words = F.col("docs") * F.col("size") * r
        moving = F.col("lam") * F.col("size") / F.col("scale") < cap
        got = (
            live.alias("d").join(state.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
            .select("s.*", "d.size", "d.docs")
            .groupBy(*keep)
            .agg(F.sum(words).alias("f"), F.sum(F.when(moving, words * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope"))
        )
        short = F.col("f") < F.col("target")
        low, high = F.when(short, F.col("lam")).otherwise(F.col("low")), F.when(short, F.col("high")).otherwise(F.col("lam"))
        # Newton's step on log f, which is nearly linear; outside the bracket, its middle.
        newton = F.col("lam") - F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("slope")
        middle = (F.col("_low") + F.col("_high")) / 2
        stepped = F.when((F.col("_newton") > F.col("_low")) & (F.col("_newton") < F.col("_high")), F.col("_newton")).otherwise(middle)
        miss = F.abs(F.col("f") / F.col("target") - 1)
        settled = F.col("full") | (F.col("_miss") <= _TOLERANCE) | (F.col("_high") - F.col("_low") <= 1e-13 * F.greatest(F.lit(1.0), F.abs(F.col("_high"))))
        moved = got.withColumns({"_low": low, "_high": high, "_newton": F.when((F.col("slope") > 0) & (F.col("f") > 0), newton), "_miss": F.when(F.col("full"), F.lit(0.0)).otherwise(miss)})
        moved = moved.select(
            "source", "source_size", "target", "scale", "full",
            F.col("_low").alias("low"), F.col("_high").alias("high"),
            F.when(settled, F.col("lam")).otherwise(stepped).alias("lam"),
            F.when(settled, F.lit(0.0)).otherwise(F.col("_miss")).alias("miss"),
        )
        moved = cut_lineage(moved)
        if moved.where("miss > 0").isEmpty():
            break
        state = moved
    solved = moved.select("source", "lam", "scale", "full")
    out = goal.alias("g").join(solved.alias("s"), F.col("g.source").eqNullSafe(F.col("s.source")), "left")
    return out.select(
        "g.source", "g.source_size", "g.target",
        F.coalesce("lam", F.lit(0.0)).alias("lam"), F.coalesce("scale", F.lit(1.0)).alias("scale"), F.coalesce("full", F.lit(False)).alias("full"),
    )


def _rounding(key: Column, size: Column, repeats: int) -> dict[str, Column]:
    """Rate, copies before correction, and the keys that order documents by their rounding edge."""
    u = F.shiftrightunsigned(F.xxhash64(key, F.lit("mix")), 11) / F.lit(float(2**53))
    rate = _rate(size, repeats)
    raw = F.col("_mix_rate") + F.col("_mix_u")
    base = F.least(F.lit(repeats), F.floor(raw)).cast("long")
    top = 2**_KEY_BITS
    up = F.least(F.lit(top - 1), F.greatest(F.lit(0), F.floor((F.col("_mix_base") + 1 - raw) * top))).cast("long")
    down = F.least(F.lit(top - 1), F.greatest(F.lit(0), F.floor((raw - F.col("_mix_base")) * top))).cast("long")
    return {
        "_mix_rate": rate, "_mix_u": u, "_mix_base": base,
        "_mix_up": F.when(F.col("_mix_base") < repeats, up), "_mix_down": F.when(F.col("_mix_base") > 0, down),
    }


def _with_rounding(rows: DataFrame, key: str, size: str, repeats: int) -> DataFrame:
    for name, column in _rounding(F.col(key), F.col(size), repeats).items():
        rows = rows.withColumn(name, column)
    return rows


def _beside(docs: DataFrame, state: DataFrame) -> DataFrame:
    """Each (source, size, key) row with its source's state.

    State rows are repeated per salt, so that the documents of one source meet theirs in SALTS
    places, and an aggregation after the join combines before it shuffles.
    """
    salted = state.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).alias("s")
    dealt = docs.withColumn("_salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).alias("d")
    met = dealt.join(salted, F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d._salt") == F.col("s._salt")))
    return met.select("d.key", "d.size", *[f"s.{c}" for c in state.columns])


def decisions(sized: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """One row per source: size, target, dual variable and rounding threshold.

    `sized` has (key, source, size), one row per document, and is read several times.
    """
    sizes = cut_lineage(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")))
    goal = cut_lineage(targets(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size")), weights, repeats))
    if goal.isEmpty():
        return goal.select("*", F.lit(0.0).alias("lam"), F.lit(1.0).alias("scale"), F.lit(False).alias("full"), F.lit(0).alias("turn"), F.lit(0).cast("long").alias("edge"), F.lit(False).alias("at_edge"))
    solved = cut_lineage(dual(sizes, goal, repeats))
    docs = sized.where("size > 0")
    rounded = _with_rounding(_beside(docs, solved), "key", "size", repeats)
    taken = rounded.groupBy("source").agg(F.sum(F.col("_mix_base") * F.col("size")).alias("taken"))
    state = solved.alias("s").join(taken.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")), "left").select("s.*", "taken")
    gap = F.col("target") - F.coalesce("taken", F.lit(0))
    state = state.select(*solved.columns, F.signum(gap).cast("int").alias("turn"), F.abs(gap).alias("need"), F.lit(0).cast("long").alias("edge"))
    state = cut_lineage(state)
    for done in range(_PASS_BITS, _KEY_BITS + 1, _PASS_BITS):
        rest = _KEY_BITS - done
        key = F.when(F.col("turn") > 0, F.col("_mix_up")).when(F.col("turn") < 0, F.col("_mix_down"))
        near = _with_rounding(_beside(docs, state), "key", "size", repeats)
        near = near.withColumn("_k", key).where((F.shiftright("_k", rest + _PASS_BITS) == F.col("edge")) if done > _PASS_BITS else F.col("_k").isNotNull())
        bins = near.groupBy("source", "need", F.shiftright("_k", rest).alias("bin")).agg(F.sum("size").alias("words"))
        run = Window.partitionBy("source").orderBy("bin")
        bins = bins.withColumn("_to", F.sum("words").over(run))
        # The bin in which the need is met; where all of them fall short, past the last one.
        cut = bins.groupBy("source").agg(
            F.min(F.when(F.col("_to") >= F.col("need"), F.struct("bin", (F.col("_to") - F.col("words")).alias("passed"), "words"))).alias("hit"),
            F.max(F.struct("bin", F.col("_to").alias("passed"))).alias("last"),
        )
        state = state.alias("s").join(cut.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")), "left").select("s.*", "hit", "last")
        final = rest == 0
        edge = F.coalesce(F.col("hit.bin"), F.col("last.bin") + 1, F.col("edge") * 2**_PASS_BITS)
        need = F.col("need") - F.coalesce(F.col("hit.passed"), F.col("last.passed"), F.lit(0))
        extra = [(F.coalesce(F.col("hit.words"), F.lit(0)) <= 2 * need).alias("at_edge")] if final else []
        state = cut_lineage(state.select(*solved.columns, "turn", need.alias("need"), edge.cast("long").alias("edge"), *extra))
    return state.drop("need")


def apply(docs: DataFrame, plan: DataFrame, key: str, source: str, size: str, repeats: int = REPEATS) -> DataFrame:
    """Adds source_size, target, rate and copies to each row of `docs`, which has a size column."""
    mine = plan.select(F.col("source").alias("_mix_source"), *[c for c in plan.columns if c != "source"])
    clash = [c for c in mine.columns if c in docs.columns]
    rows = docs.drop(*clash).join(mine, F.col(source).eqNullSafe(F.col("_mix_source")), "left")
    rows = _with_rounding(rows, key, size, repeats)
    k = F.when(F.col("turn") > 0, F.col("_mix_up")).when(F.col("turn") < 0, F.col("_mix_down"))
    moves = (k < F.col("edge")) | ((k == F.col("edge")) & F.col("at_edge"))
    copies = F.col("_mix_base") + F.when(F.coalesce(moves, F.lit(False)) & (F.col(size) > 0), F.col("turn")).otherwise(0)
    return rows.withColumns({"rate": F.col("_mix_rate"), "copies": copies.cast("long")}).drop("_mix_source", "_mix_rate", "_mix_u", "_mix_base", "_mix_up", "_mix_down", "lam", "scale", "full", "turn", "edge", "at_edge")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken."""
    sized = cut_lineage(docs.select(F.col("doc_id").alias("key"), "source", word_count(F.col("text")).alias("size")))
    plan = decisions(sized, weights, repeats)
    out = apply(sized.withColumnRenamed("key", "doc_id"), plan, "doc_id", "source", "size", repeats)
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The mix itself: every document as often as it is copied, in the columns of `docs`.

    The decisions are one small row per source, so texts meet them where they are read.
    """
    sized = cut_lineage(docs.select(F.col("doc_id").alias("key"), "source", word_count(F.col("text")).alias("size")))
    plan = decisions(sized, weights, repeats)
    packed = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_mix_row"), F.col("doc_id").alias("_mix_key"), F.col("source").alias("_mix_from"), word_count(F.col("text")).alias("_mix_size"))
    rows = apply(packed, plan, "_mix_key", "_mix_from", "_mix_size", repeats).where("copies > 0")
    return rows.select("_mix_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_mix_row.*")
