"""Mixing sources to target weights by entropy balancing.

Each source gets a target number of words. Of all document rates that meet it, those closest to one copy each (in
relative entropy, none above ``CAP``) are min(CAP, exp(lambda * size)); the convex dual's one unknown for each source is
found by distributed Newton iterations over the counts of (source, size), and the rates are then rounded to copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: Copies of a document, and words of a source against its size, at most.
CAP = 3
WORDS = r"[^\x20\x09-\x0D]+"
STEPS = 60
TOLERANCE = 1e-6
#: Values between the ends of a bracket that guard a Newton step, parts of a source's sizes, and where brackets end at most.
GUARDS, PARTS, FURTHEST = 8, 32, 2.0**21
#: Bins of each pass that finds a rounding offset, and passes that fill up what is left of a target.
BINS = 4096
FILLS = 3


def size_of(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``sid, source, source_size, target`` for every source: weights 1, 2, 3, repeating, in order of the sources' code
    points (null last), share all words; a target stops at ``CAP`` times its source's size and the excess is shared again.

    The windows run over one row for each source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("sid", F.row_number().over(order) - 1).withColumn("w", F.pmod("sid", F.lit(3)) + 1)
    per = per.withColumn("cap", (CAP * F.col("source_size")).cast("double")).withColumn("ratio", F.col("cap") / F.col("w"))
    fill = Window.orderBy("ratio", "sid")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weights = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    # the water level once the sources before this one are full; the first source below its cap has the true level
    per = per.withColumn("level", F.when(left / weights <= F.col("ratio"), left / weights))
    per = per.withColumn("level", F.max_by("level", F.when(F.col("level").isNotNull(), -F.col("ratio"))).over(everything))
    return per.select("sid", "source", "source_size", F.least("cap", F.coalesce(F.col("w") * F.col("level"), F.col("cap"))).alias("target"))


def _rate(size: Column, mean: Column, lam: Column) -> Column:
    """min(CAP, exp(lam * size / mean)); a null lam stands for sources at their cap."""
    return F.when(lam.isNull(), F.lit(float(CAP))).otherwise(F.least(F.lit(float(CAP)), F.exp(F.least(lam * size / mean, F.lit(50.0)))))


def _summed(counts: DataFrame, tried: DataFrame) -> DataFrame:
    """``sid, target, lam, words, slope``: the dual's gradient (words at ``lam``, less the target) and curvature for every source and
    value tried. A source's counts are summed in parts of its sizes, map-side first; sums are exact, so no order changes them."""
    parts = tried.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    rows = counts.join(parts, ["sid", "part"])
    rate, exact = _rate(F.col("size"), F.col("mean"), F.col("lam")), lambda x: F.sum(x.cast("decimal(32,8)")).cast("double")
    words = F.col("n") * F.col("size") * rate
    bent = F.when(rate < CAP, words * F.col("size") / F.col("mean")).otherwise(0.0)
    return rows.groupBy("sid", "target", "lam").agg(exact(words).alias("words"), exact(bent).alias("slope"))


def _stepped(sums: DataFrame) -> DataFrame:
    """``sid, target, lo, hi, lam, gap, step``: of each source's values the bracket round the root, the best one, its gap, and its
    Newton step inside the bracket."""
    gap = F.col("words") - F.col("target")
    best = F.min_by(F.struct("lam", gap.alias("gap"), "slope"), F.struct(F.abs(gap).alias("g"), F.col("lam")))
    out = sums.groupBy("sid", "target").agg(F.max(F.when(gap < 0, F.col("lam"))).alias("lo"), F.min(F.when(gap >= 0, F.col("lam"))).alias("hi"), best.alias("b")).select("sid", "target", "lo", "hi", "b.lam", "b.gap", "b.slope")
    out = out.withColumn("lo", F.coalesce("lo", F.lit(-FURTHEST))).withColumn("hi", F.coalesce("hi", F.lit(FURTHEST)))
    newton = F.when(F.col("slope") > 0, F.col("lam") - F.col("gap") / F.col("slope"))
    return out.withColumn("step", F.greatest("lo", F.least("hi", F.coalesce(newton, (F.col("lo") + F.col("hi")) / 2)))).drop("slope")


def solved(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target, mean, lam`` for every source, its dual solved by distributed Newton iterations.

    The dual has one unknown for each source. An iteration is one job for all sources: it sums gradient and curvature at the
    Newton step and at some guards inside the bracket, over the counts of (source, size), in parts, so that a source with most of
    the documents is ``PARTS`` keys. The first one tries powers of two of both signs. Sources whose words are within
    ``TOLERANCE`` of the target are done; the state is a row a source.
    """
    wanted = written(targets(sizes), "targets")
    free = (F.col("target") > 0) & (F.col("target") < CAP * F.col("source_size") * (1 - 1e-12))
    counts = sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.join(wanted.select("sid", F.col("source").alias("_source")), F.col("source").eqNullSafe(F.col("_source"))).select("sid", "size", "n", F.pmod(F.xxhash64("size"), F.lit(PARTS)).cast("int").alias("part"))
    counts = written(counts, "size-counts")
    means = counts.groupBy("sid").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    known = written(wanted.where(free).select("sid", "target").join(means, "sid"), "means")
    powers = [0.0, *[s * 2.0**k for k in range(-3, 21) for s in (-1, 1)]]
    tried = known.withColumn("lam", F.explode(F.array(*map(F.lit, powers))))
    done = None
    for _ in range(STEPS):
        now = written(_stepped(_summed(counts, tried)), "newton")
        # a bracket that rounding has closed is done too
        ready = (F.abs("gap") <= TOLERANCE * F.col("target")) | (F.col("hi") - F.col("lo") <= 1e-14 * F.greatest(F.abs("lo"), F.abs("hi")))
        own = now.where(ready).select("sid", "lam")
        done = own if done is None else done.unionByName(own)
        left = now.where(~ready)
        if not left.limit(1).count():
            break
        guards = [F.col("lo") + (F.col("hi") - F.col("lo")) * k / GUARDS for k in range(1, GUARDS)]
        near = [F.greatest("lo", F.least("hi", F.col("step") + s * (F.col("hi") - F.col("lo")) * 2.0**-k)) for k in (8, 14) for s in (-1, 1)]
        tried = left.select("sid", "target", F.explode(F.array_distinct(F.array("lo", "hi", "step", *near, *guards))).alias("lam")).join(known.select("sid", "mean"), "sid")
    else:
        done = done.unionByName(left.select("sid", "lam"))
    state = wanted.join(done, "sid", "left").join(means, "sid", "left").withColumn("mean", F.coalesce("mean", F.lit(1.0)))
    return written(state.select("sid", "source", "source_size", "target", "mean", "lam"), "state")


def _coin(doc_id: Column, text_key: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, text_key, F.lit(29)), F.lit(1 << 40)) / float(1 << 40)


def _rated(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows (doc_id, source, size) with their source's plan, rate, whole copies and rank for one more copy."""
    own = plan.withColumnRenamed("source", "_source")
    out = rows.join(own, rows["source"].eqNullSafe(own["_source"])).drop("_source")
    out = out.withColumn("rate", F.when((F.col("target") <= 0) | (F.col("size") == 0), F.lit(0.0)).otherwise(_rate(F.col("size"), F.col("mean"), F.col("lam"))))
    out = out.withColumn("whole", F.floor("rate").cast("long"))
    return out.withColumn("rank", F.when((F.col("whole") < CAP) & (F.col("rate") > 0), _coin(F.col("doc_id"), F.col("size")) - (F.col("rate") - F.col("whole"))))


def _offsets(plan: DataFrame, taken: DataFrame, lo: Column, span: Column) -> DataFrame:
    """The plan with ``edge``: the rank up to which (sid, rank, size) rows, in bins of the span, fit into ``need``, and
    ``got``, their words."""
    bin_ = F.floor((F.col("rank") - F.col("_lo")) / F.col("_span") * BINS).cast("long")
    at = plan.select("sid", "need", lo.alias("_lo"), span.alias("_span"))
    sums = taken.join(at, "sid").where((bin_ >= 0) & (bin_ < BINS)).groupBy("sid", bin_.alias("bin")).agg(F.sum("size").alias("words"), F.first("need").alias("need"))
    upto = Window.partitionBy("sid").orderBy("bin")  # at most BINS rows for each source
    sums = sums.withColumn("total", F.sum("words").over(upto))
    fits = F.col("total") <= F.col("need")
    sums = sums.groupBy("sid").agg(F.min(F.when(~fits, F.col("bin"))).alias("over"), F.max(F.when(fits, F.col("total"))).alias("got"))
    return plan.join(sums, "sid", "left").withColumn("edge", lo + span * F.coalesce("over", F.lit(BINS)) / BINS).withColumn("got", F.coalesce("got", F.lit(0))).drop("over")


def planned(sizes: DataFrame) -> DataFrame:
    """The plan of every source: rates (``mean, lam``) and the ``extras`` that round them, (offset, limit) pairs.

    A document is ranked by a hash of its id less the fraction of its rate, so an offset of 0 rounds without bias. It
    gets one more copy for each pair whose offset its rank lies below and whose limit its size does not exceed, up to
    ``CAP`` copies. The first offset is the last at which the words taken stay within the target, found in two passes of
    ``BINS`` bins; the other pairs fill what is left with documents no larger than that, so a source ends within a small
    document of its target. Every pass sees all documents.
    """
    plan = solved(sizes)
    # what each pass needs of a document, worked out once
    rated = written(_rated(sizes, plan).select("sid", "size", "whole", "rank"), "rated")
    base = rated.groupBy("sid").agg(F.sum(F.col("whole") * F.col("size")).alias("base"))
    none = F.array().cast("array<struct<offset:double,limit:double>>")
    plan = written(plan.join(base, "sid", "left").withColumn("need", F.col("target") - F.coalesce("base", F.lit(0))).drop("base").withColumn("extras", none), "plan")
    kept = ["sid", "source", "source_size", "target", "mean", "lam", "need", "extras"]
    everything, unlimited = (F.lit(-1.0), F.lit(float(2 + FILLS))), F.lit(float("inf"))
    for turn in range(1 + FILLS):
        free = rated.where("rank is not null").join(plan.select("sid", "need", "extras"), "sid").withColumn("_n", _extra()).where(F.col("whole") + F.col("_n") < CAP)
        free = free.select("sid", (F.col("rank") + F.col("_n")).alias("rank"), "size", "need")
        limit = unlimited if turn == 0 else F.greatest("need", F.lit(0.0))
        free = free.where(F.col("size") <= limit).drop("need")
        at = written(_offsets(plan, free, *everything), "plan")
        if turn == 0:
            at = at.withColumn("need", F.col("need") - F.col("got")).withColumn("lo", F.col("edge")).drop("got", "edge")
            at = written(_offsets(at, free, F.col("lo"), F.lit((2.0 + FILLS) / BINS)), "plan")
        extra = F.array(F.struct(F.col("edge").alias("offset"), limit.alias("limit")))
        plan = written(at.withColumn("extras", F.concat("extras", extra)).withColumn("need", F.col("need") - F.col("got")).select(*kept), "plan")
    return plan.drop("need")


def _extra() -> Column:
    """How many more copies a rated row gets; each one taken moves its rank up by one, behind rows without."""
    fits = lambda n, e: (F.col("rank") + n < e["offset"]) & (F.col("size") <= e["limit"]) & (F.col("whole") + n < CAP)
    return F.aggregate("extras", F.lit(0), lambda n, e: n + F.when(fits(n, e), F.lit(1)).otherwise(F.lit(0)))


def mixed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with ``doc_id, source, size`` and any others, each with its copies (0 to ``CAP``) and ``taken`` words."""
    out = _rated(rows, plan)
    copies = F.col("whole") + F.when(F.col("rank").isNotNull(), _extra()).otherwise(0)
    return out.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))


def balanced(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, taken`` for every document.

    Null texts and texts without words have size 0 and are taken 0 times; a null source is a source; repeated rows are
    rounded alike; an empty table gives no rows. Reruns agree, as ranks are hashes. Only doc_id, source and text are read.
    """
    sizes = written(docs.select("doc_id", "source", size_of(F.col("text")).alias("size")), "doc-sizes")
    return mixed(sizes, planned(sizes)).select("doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken")


def repeated(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it was taken, with the columns of ``docs``. Documents without words go.

    A row travels as one struct beside what the mix needs, so columns of any name (``size``, ``target``, ``mean``) keep their
    values; ``_mix_row`` and ``_mix_copy`` are names of the operator's own.
    """
    rows = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_mix_row"))
    sizes = written(rows.drop("_mix_row"), "doc-sizes")
    out = mixed(rows, planned(sizes)).where("copies > 0").select("copies", "_mix_row")
    return out.select(F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_mix_copy"), "_mix_row").select("_mix_row.*")
