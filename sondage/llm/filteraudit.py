"""Filter interaction audit: what filters remove in every order, by counting paths through the lattice of their subsets.

A document's failures are a set of filters. A state of the lattice is the set of filters applied so far; the edge that adds filter
``f`` in state ``S`` removes the documents that fail ``f`` and nothing in ``S``, whatever the order inside ``S``. So a table of
2**n failure sets for each part of the corpus tells all n! orders: an order's steps are edges, and a filter's Shapley sum is the
edges' removals, each weighed by the orders that reach its state (forward) times those that leave its end (backward).

Defined results: a null text is the empty text; a null part is the empty string; a null id equals no other document's elder; rows
that repeat an id with the same text aren't copies of each other; of several labels of one document each that holds counts once; an
empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

WORD_GAP = r"[\x20\x09-\x0D]+"


def lattice(n: int) -> list[tuple[int, int, int, int]]:
    """The edges (state, filter, forward, backward) of the subsets of n filters, as bit masks: ``forward`` orders lead from the
    empty set to the state, ``backward`` ones from the edge's end to the full set; both are counted edge by edge."""
    full = (1 << n) - 1
    ways, left = {0: 1}, {full: 1}
    by_size = sorted(range(1 << n), key=lambda s: (s.bit_count(), s))
    for s in by_size[1:]:
        ways[s] = sum(ways[s ^ (1 << f)] for f in range(n) if s >> f & 1)
    for s in by_size[-2::-1]:
        left[s] = sum(left[s | 1 << f] for f in range(n) if not s >> f & 1)
    return [(s, f, ways[s], left[s | 1 << f]) for s in range(1 << n) for f in range(n) if not s >> f & 1]


def text_failures(text: Column) -> list[Column]:
    """The conditions A to D on a text: few words, few distinct ones, many capitals, odd characters."""
    words = F.filter(F.split(text, WORD_GAP, -1), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return [n < 50, 100 * F.size(F.array_distinct(words)) < 65 * n, 100 * capitals > 5 * F.length(text), text.rlike("[#$%&*|]")]


def bits(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)])


def failure_sets(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the set of filters they fail (A is bit 0), of which ``quality`` or ``toxic`` is 1.

    Texts are read once and leave as a digest and four bits. Repeated rows are counted together first, so an id, a text or a part
    with most of the rows is a few rows after each map side; of each text, the rows at its least id are told from the others by
    counts, not by a join of its copies.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), t.alias("t"))
    rows = rows.select("id", "part", F.unhex(F.sha2("t", 256)).alias("digest"), bits(text_failures(F.col("t"))).alias("own"))
    rows = rows.groupBy("id", "part", "digest", "own").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.groupBy(F.col(key).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("q"), F.max((F.col("toxic") == 1).cast("int")).alias("x"))
    marked = rows.join(marks.where("id is not null and (q = 1 or x = 1)"), "id", "left")
    kind = ["digest", "part", "own", F.coalesce("q", F.lit(0)).alias("q"), F.coalesce("x", F.lit(0)).alias("x")]
    # of each text by part and labels: all rows, those without an id, the least id and its rows
    sums = marked.groupBy(*kind).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("bare"), F.min("id").alias("least"), F.min_by("n", "id").alias("at"))
    sums = written(sums, "audit")  # narrow rows, read for the least ids and for the counts: texts are read once
    # the same id may stand in several parts: the rows at the text's least id, wherever they are, have no elder
    eldest = sums.groupBy("digest").agg(F.min("least").alias("eldest"))
    sums = sums.join(eldest, "digest")
    elder = F.col("bare") + F.when(F.col("least") == F.col("eldest"), F.col("at")).otherwise(0)
    each = F.array(F.struct(F.col("own").alias("mask"), elder.alias("n")), F.struct((F.col("own") + 16).alias("mask"), (F.col("n") - elder).alias("n")))
    out = sums.select("part", "q", "x", F.inline(each)).groupBy("part", "mask")
    return out.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("q")).alias("good"), F.sum(F.col("n") * F.col("x")).alias("toxic"))


def audit(sets: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """One row for each part, order of the filters and step; counts within the part (see the module).

    ``sets`` has at most 2**n rows a part, each of which meets the n * 2**(n - 1) edges; the steps of the n! orders pick theirs
    from a table that depends on n alone.
    """
    n, spark = len(filters), sets.sparkSession
    rows = sets.select("part", "mask", "n", "good", "toxic", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("f"))
    rows = rows.withColumn("state", F.explode(F.sequence(F.lit(0), F.lit(2**n - 1)))).withColumn("bit", F.expr("shiftleft(1, f)")).where(F.col("state").bitwiseAND(F.col("bit")) == 0)
    fails, passed = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("state")) == 0
    total = lambda cond, c="n": F.sum(F.when(cond, F.col(c)).otherwise(0)).cast("long")
    edges = rows.groupBy("part", "f", "state").agg(
        total(passed & ~fails).alias("kept"), total(passed & fails).alias("removed"), total(~passed & fails).alias("redundant"), total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(passed & fails, "good").alias("good_lost"), total(passed & fails, "toxic").alias("toxic_lost"),
    )
    paths = spark.createDataFrame([(s, f, a * b) for s, f, a, b in lattice(n)], "state int, f int, paths long")
    own = Window.partitionBy("part", "f")  # the 2**(n - 1) edges of a filter
    edges = edges.join(F.broadcast(paths), ["state", "f"]).withColumn("shapley", F.sum(F.col("removed") * F.col("paths")).over(own))
    steps = [("".join(filters[i] for i in order), k + 1, sum(1 << i for i in order[:k]), order[k]) for order in permutations(range(n)) for k in range(n)]
    orders = spark.createDataFrame(steps, "filter_order string, step int, state int, f int")
    return edges.join(F.broadcast(orders), ["state", "f"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
