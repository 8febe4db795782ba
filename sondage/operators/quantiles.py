"""Exact quantiles of groups of any size, by counting: no task holds a group's values.

Approximate quantiles, of known rank error, bracket the ranks in question; another pass counts the values below the
bracket and each distinct value inside it, which is a few thousandths of a large group. Small groups are all bracket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sondage.scratch import written

#: Relative accuracy of the bracket; its margin is four times the error that this allows.
ACCURACY = 10_000
MARGIN = 4 / ACCURACY
#: Groups of at most so many values are counted whole.
SMALL = 50_000


def key_of(strata: list[str]) -> Column:
    """One struct of the strata's columns, in which nulls are equal to nulls."""
    return F.struct(*[F.col(s).alias(f"k{i}") for i, s in enumerate(strata)]) if strata else F.struct(F.lit(0).alias("k0"))


def narrow(df: DataFrame, strata: list[str], values: dict[str, Column], settled: bool = False) -> DataFrame:
    """``_k`` and the named values as doubles (NaN as null), written once: what quantiles read instead of ``df``. A ``settled``
    table, which is no more than read, isn't written again."""
    number = lambda x: F.nanvl(x.cast("double"), F.lit(None).cast("double"))
    rows = df.select(key_of(strata).alias("_k"), *[number(v).alias(n) for n, v in values.items()])
    return rows if settled else written(rows, "values")


def quantiles(df: DataFrame, strata: list[str], values: dict[str, Column], q: float | list[float], settled: bool = False) -> DataFrame:
    """``_k, <name>...``: for each group (``_k``, see ``key_of``) the quantile ``q`` of each named value (or one of its own for
    each), linearly interpolated between neighbours as ``percentile`` does; null for a group without values. Null and NaN
    values don't count. ``df`` runs once (twice if it is ``settled``); the result is a written table with a row a group."""
    return quantiles_of(narrow(df, strata, values, settled), {n: F.col(n) for n in values}, q)


def quantiles_of(df: DataFrame, values: dict[str, Column], q: float | list[float]) -> DataFrame:
    """``quantiles`` of a table with ``_k`` that is cheap to read, and is read twice."""
    names = list(values)
    qs = list(q) if isinstance(q, list) else [q] * len(names)
    rows = df.select("_k", *[v.alias(f"v{i}") for i, v in enumerate(values.values())])
    edges, many = [[max(0.0, x - MARGIN), min(1.0, x + MARGIN)] for x in qs], range(len(names))
    facts = [x for i in many for x in (F.count(f"v{i}").alias(f"n{i}"), F.min(f"v{i}").alias(f"a{i}"), F.max(f"v{i}").alias(f"b{i}"), F.percentile_approx(f"v{i}", edges[i], ACCURACY).alias(f"e{i}"))]
    # written: of few groups it is a small file, which joins the rows without a shuffle by group, so a hot group stays spread
    sizes = written(rows.groupBy("_k").agg(*facts), "sizes")
    found = written(_ranked(rows, sizes, names, qs, SMALL), "quantiles")
    lost = found.where("lost")
    if lost.limit(1).count():  # a bracket that missed its rank: these groups are counted whole
        again = _ranked(rows.join(lost.select("_k"), "_k", "left_semi"), sizes.join(lost.select("_k"), "_k", "left_semi"), names, qs, None)
        found = written(found.where("not lost").unionByName(again), "quantiles")
    return found.drop("lost")


def _ranked(rows: DataFrame, sizes: DataFrame, names: list[str], qs: list[float], small: int | None) -> DataFrame:
    """``_k, <name>..., lost``: quantiles from the counts of the values inside each group's bracket; groups of at most ``small`` values
    (None: all groups) are all bracket. ``lost``: a rank lies outside its bracket."""
    many = range(len(names))
    edge = lambda i, at, whole: F.when(F.col(f"n{i}") <= small, F.col(f"{whole}{i}")).otherwise(F.col(f"e{i}")[at]) if small is not None else F.col(f"{whole}{i}")
    bracket = sizes.select("_k", *[x for i in many for x in (f"n{i}", edge(i, 0, "a").alias(f"lo{i}"), edge(i, 1, "b").alias(f"hi{i}"))])
    # a value below its bracket counts as null, one above is left out
    each = F.array(*[F.struct(F.lit(i).alias("i"), F.when(F.col(f"v{i}") >= F.col(f"lo{i}"), F.col(f"v{i}")).alias("v"), (F.col(f"v{i}") <= F.col(f"hi{i}")).alias("in"), F.col(f"n{i}").alias("n")) for i in many])
    counts = rows.join(bracket, "_k").select("_k", F.inline(F.filter(each, lambda s: s["in"]))).groupBy("_k", "i", "v").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n"))
    # at most SMALL values, or twice the margin's share of a group, in one window
    upto = F.sum("c").over(Window.partitionBy("_k", "i").orderBy(F.col("v").asc_nulls_first()))
    place = (F.col("n") - 1) * F.element_at(F.array(*map(F.lit, qs)), F.col("i") + 1)
    ranked = counts.select("_k", "i", "v", upto.alias("upto"), place.alias("place"))
    # the values at the two ranks round the place: the first of which more than so many are reached
    at = lambda r: F.min_by(F.struct("v"), F.when(F.col("upto") > r, F.col("upto")))
    pair = ranked.groupBy("_k", "i").agg(F.max("place").alias("place"), at(F.floor("place")).alias("x"), at(F.ceil("place")).alias("y"))
    lost = F.col("x").isNull() | F.col("y").isNull() | F.col("x.v").isNull()
    x, y, low, high = F.col("x.v"), F.col("y.v"), F.floor("place"), F.ceil("place")
    value = F.when((low == high) | (x == y), x).otherwise((high - F.col("place")) * x + (F.col("place") - low) * y)
    wide = pair.groupBy("_k").agg(*[F.max(F.when(F.col("i") == i, value)).alias(n) for i, n in enumerate(names)], F.bool_or(lost).alias("lost"))
    return sizes.select("_k").join(wide, "_k", "left").withColumn("lost", F.coalesce("lost", F.lit(False)))


def joined(df: DataFrame, strata: list[str], stats: DataFrame) -> DataFrame:
    """``df`` with the columns of its group's row in ``stats`` (see ``quantiles``), null where there is none."""
    return df.withColumn("_k", key_of(strata)).join(stats, "_k", "left").drop("_k")
