"""Hard-negative mining by exact inner products: anchor clusters share candidate lists, sorted once by an angular upper bound.

Anchors are clustered by direction. For a cluster with centroid c, whose members lie within the angle t of c, a candidate x scores at
most |x| cos(max(0, angle(x, c) - t)) with any member of length 1. The cluster sorts candidates by this bound once; every member
walks down the list until the bound, times its own length, is below the last score that it still needs: no later candidate can
count, so results are exact whatever the clusters are.

Candidates are dealt by a hash into blocks, anchors into groups of whole packs; a task takes one block and one group, so it holds
``BLOCK_ROWS`` and ``GROUP_ANCHORS`` vectors at most, and a frequent vector or label is spread over all blocks. A cluster of more
than ``PACK`` anchors is split by a hash into packs with bounds of their own. Blocks' best lists are merged by anchor.

Components are integers, floor(256 x), and scores are integers. Defined results: rows with a null label, a null vector or a null or
non-finite component take no part, nor do vectors whose squared integer length reaches 2**62, as scores have to fit a long; missing
components of shorter vectors are 0; rows that repeat an id are rows of their own (a row is only never its own positive); null ids come
last among ties; an empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90
BLOCK_ROWS, GROUP_ANCHORS, PACK = 65_536, 16_384, 256
#: Anchors that the centroids are fitted on, and centroids. They steer the work only, never the result.
SAMPLE, CENTROIDS = 16_384, 64
LIMIT = 2.0**62
BIG = 2**62


def integers(rows: DataFrame, anchor: Column, vector: str = "embedding", label: str = "label", key: str = "vec_id") -> DataFrame:
    """``uid, id, label, x, is_anchor`` of the rows that take part; ``x`` holds the integers as little-endian int32 bytes."""
    v = F.col(vector).cast("array<double>")
    fine = F.col(label).isNotNull() & v.isNotNull() & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = F.transform(v, lambda e: F.floor(e * SCALE).cast("double"))
    short = F.aggregate(whole, F.lit(0.0), lambda a, e: a + e * e) < LIMIT
    rows = rows.where(fine).select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), whole.alias("v"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"), short.alias("short"))
    rows = rows.where("short").select("id", "label", F.transform("v", lambda e: e.cast("int")).alias("v"), "is_anchor").withColumn("uid", F.monotonically_increasing_id())

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            v = rb.column("v")
            ends, flat = v.offsets.to_numpy(), v.values.to_numpy(zero_copy_only=False).astype("<i4")
            x = pa.array([flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([rb.column("uid"), rb.column("id"), rb.column("label"), x, rb.column("is_anchor")], names=["uid", "id", "label", "x", "is_anchor"])

    return rows.mapInArrow(packed, "uid long, id long, label string, x binary, is_anchor boolean")


def matrix(x: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows of float64, which hold the integers; short ones end in zeros."""
    if all(len(b) == 4 * width for b in x):
        return np.frombuffer(b"".join(x), "<i4").reshape(len(x), width).astype(float)
    return np.stack([np.pad(np.frombuffer(b, "<i4").astype(float), (0, width - len(b) // 4)) for b in x]) if len(x) else np.zeros((0, width))


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """All inner products as int64; in floats where these hold every partial sum (``exact``)."""
    return (a @ b.T).astype(np.int64) if exact else a.astype(np.int64) @ b.astype(np.int64).T


def directions(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids of a spherical k-means, from evenly spaced rows on."""
    unit = x / np.maximum(lengths(x), 1e-300)[:, None]
    c = unit[np.linspace(0, len(unit) - 1, min(k, len(unit))).astype(int)]
    for _ in range(rounds):
        own = np.argmax(unit @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, unit)
        size = lengths(sums)
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], c)
    return c


def bounds(members: np.ndarray, x: np.ndarray) -> np.ndarray:
    """For each candidate the largest score with any member, for a member of length 1: never too small, as both angles are widened
    by more than rounding."""
    unit = members[lengths(members) > 0]
    unit = unit / lengths(unit)[:, None]
    c = unit.sum(axis=0)
    size, own = lengths(c[None])[0], lengths(x)
    if not len(unit) or size < 1e-9:
        return own
    c = c / size
    spread = np.arccos(np.clip((unit @ c).min(), -1, 1)) + 1e-7
    angle = np.arccos(np.clip(x @ c / np.maximum(own, 1e-300), -1, 1)) - 1e-7
    return own * np.cos(np.clip(angle - spread, 0, np.pi))


class Best:
    """The best ``k`` candidates of each of n slots: higher scores first, then smaller ids (null last), then rows."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.last = k, np.full(n, -BIG, np.int64)
        self.slot = self.score = self.order = self.place = np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, order: np.ndarray, place: np.ndarray) -> None:
        """``order`` ranks the candidates among equal scores, ``place`` tells them."""
        slot, score, order, place = (np.concatenate([a, b]) for a, b in zip((self.slot, self.score, self.order, self.place), (slot, score, order, place), strict=True))
        by = np.lexsort((order, -score, slot))
        slot, score, order, place = slot[by], score[by], order[by], place[by]
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.zeros(0, np.int64)
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = rank < self.k
        full = rank == self.k - 1
        self.last[slot[full]] = score[full]
        self.slot, self.score, self.order, self.place = slot[keep], score[keep], order[keep], place[keep]


def walk(members: np.ndarray, low: np.ndarray, high: np.ndarray, admitted: Callable[[np.ndarray, np.ndarray], np.ndarray], x: np.ndarray, order: np.ndarray, k: int, exact: bool) -> tuple[Best, int]:
    """(the best k of every member and slot, scores computed). Members x slots hold the bounds ``low`` and ``high`` of wanted scores;
    ``admitted(members, candidates)`` tells the pairs that may count. The list is walked in growing steps, by those members
    whose next bound can still change a slot."""
    n, slots = low.shape
    best, upper = Best(n * slots, k), bounds(members, x)
    by, size = np.argsort(-upper, kind="stable"), lengths(members)
    at, step, done = 0, 64, 0
    active = np.flatnonzero((low <= high).any(axis=1))
    while len(active) and at < len(by):
        cand = by[at : at + step]
        score = products(members[active], x[cand], exact)
        done += score.size
        may = admitted(active, cand)
        for j in range(slots):
            need = np.maximum(low[active, j], best.last[active * slots + j])
            m, c = np.nonzero(may & (score >= need[:, None]) & (score <= high[active, j][:, None]))
            if len(m):
                best.add(active[m] * slots + j, score[m, c], order[cand[c]], cand[c])
        at, step = at + step, min(2 * step, 4096)
        if at < len(by):
            need = np.maximum(low[active], best.last.reshape(n, slots)[active]).astype(float)
            need = np.where(low[active] <= high[active], need, np.inf).min(axis=1)
            reach = size[active] * upper[by[at]]
            active = active[reach + 1e-9 * np.abs(reach) + 1e-6 >= need]
    return best, done


def met(anchors: DataFrame, blocks: DataFrame, find: Callable[[pd.DataFrame, pd.DataFrame, np.ndarray, np.ndarray, np.ndarray, bool], list[tuple]], width: int, schema: str) -> DataFrame:
    """Every group of anchors with every block of candidates, each pair one task; ``find`` gets a pack's rows, the block's, both
    matrices, the candidates' order among ties and whether floats are exact."""

    def run(own: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        names = [c.split(" ")[0] for c in schema.split(", ")]
        if not len(own) or not len(block):
            return pd.DataFrame(columns=names)
        x, a = matrix(block["x"], width), matrix(own["x"], width)
        exact = bool(lengths(x).max() * lengths(a).max() < 2**52)
        order = np.empty(len(block), np.int64)
        order[np.lexsort((block["uid"].to_numpy(), block["id"].fillna(0).to_numpy(), block["id"].isna().to_numpy()))] = np.arange(len(block))
        out = []
        for _, at in own.groupby("pack", sort=True).indices.items():
            out += find(own.iloc[at], block, a[at], x, order, exact)
        return pd.concat([pd.DataFrame(dict(zip(names, cols, strict=True))) for cols in out]) if out else pd.DataFrame(columns=names)

    return anchors.groupBy("part", "block").cogroup(blocks.groupBy("part", "block")).applyInPandas(run, schema)


def _positives(pack: pd.DataFrame, block: pd.DataFrame, a: np.ndarray, x: np.ndarray, order: np.ndarray, exact: bool) -> list[tuple]:
    same, uid, own = block["label"].to_numpy(), block["uid"].to_numpy(), pack["uid"].to_numpy()
    label = pack["label"].to_numpy()
    free = np.full((len(pack), 1), BIG, np.int64)
    best, _ = walk(a, -free, free, lambda m, c: (label[m][:, None] == same[c][None]) & (own[m][:, None] != uid[c][None]), x, order, POSITIVES, exact)
    return [(own[best.slot], block["id"].to_numpy()[best.place], uid[best.place], best.score)]


def _negatives(pack: pd.DataFrame, block: pd.DataFrame, a: np.ndarray, x: np.ndarray, order: np.ndarray, exact: bool) -> list[tuple]:
    other, uid, own, label = block["label"].to_numpy(), block["uid"].to_numpy(), pack["uid"].to_numpy(), pack["label"].to_numpy()
    low, high = np.full((len(pack), POSITIVES), BIG, np.int64), np.full((len(pack), POSITIVES), -BIG, np.int64)
    for i, scores in enumerate(pack["scores"]):
        for j, s in enumerate(map(int, scores)):
            low[i, j], high[i, j] = -(-LOW * s // 100), HIGH * s // 100
    best, _ = walk(a, low, high, lambda m, c: label[m][:, None] != other[c][None], x, order, NEGATIVES, exact)
    return [(own[best.slot // POSITIVES], (best.slot % POSITIVES).astype(np.int32), block["id"].to_numpy()[best.place], uid[best.place], best.score)]


def mined(rows: DataFrame, anchor: Column, vector: str = "embedding", label: str = "label", key: str = "vec_id") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` (see the module): of every row for which
    ``anchor`` holds the first ``POSITIVES`` rows of its label, and for each of them the first ``NEGATIVES`` rows of other labels
    whose score is ``LOW`` to ``HIGH`` hundredths of the positive's."""
    spark = rows.sparkSession
    vectors = written(integers(rows, anchor, vector, label, key), "vectors")
    facts = vectors.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("anchors"), F.max(F.octet_length("x")).alias("bytes")).first()
    width = max(1, (facts["bytes"] or 0) // 4)
    cores = max(spark.sparkContext.defaultParallelism, 2)
    n_blocks, n_parts = max(-(-facts["n"] // BLOCK_ROWS), min(cores, -(-facts["n"] // 1024)), 1), max(1, -(-facts["anchors"] // GROUP_ANCHORS))

    own = vectors.where("is_anchor").select("uid", "id", "label", "x")
    fit = own.orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).select("x").toPandas()["x"]
    centroids = directions(matrix(fit, width), CENTROIDS) if len(fit) else np.zeros((1, width))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(cluster=np.argmax(matrix(pdf["x"], width) @ centroids.T, axis=1).astype(np.int32))

    clustered = written(own.mapInPandas(placed, "uid long, id long, label string, x binary, cluster int"), "anchors")
    sizes = F.broadcast(clustered.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / PACK).cast("int").alias("packs")))  # at most CENTROIDS rows
    packed = clustered.join(sizes, "cluster").withColumn("_p", F.pmod(F.xxhash64("uid"), F.col("packs")).cast("int"))
    packed = packed.withColumn("pack", F.struct("cluster", "_p").cast("string")).withColumn("part", F.pmod(F.xxhash64("pack"), F.lit(n_parts)).cast("int"))
    every = packed.drop("cluster", "packs", "_p").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    blocks = vectors.select("uid", "id", "label", "x", F.pmod(F.xxhash64("uid"), F.lit(n_blocks)).cast("int").alias("block")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))

    found = met(every, blocks, _positives, width, "uid long, p_id long, p_uid long, score long")
    rank = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("p_id"), "p_uid"))
    first = written(found.withColumn("slot", rank - 1).where(F.col("slot") < POSITIVES), "positives")
    scores = first.groupBy("uid").agg(F.transform(F.sort_array(F.collect_list(F.struct("slot", "score"))), lambda s: s["score"]).alias("scores"))
    hits = met(every.join(scores, "uid"), blocks, _negatives, width, "uid long, slot int, n_id long, n_uid long, score long")
    rank = F.row_number().over(Window.partitionBy("uid", "slot").orderBy(F.desc("score"), F.asc_nulls_last("n_id"), "n_uid"))
    hits = hits.withColumn("rank", rank).where(F.col("rank") <= NEGATIVES)
    out = hits.join(first.select("uid", "slot", "p_id", F.col("score").alias("positive_score")), ["uid", "slot"]).join(own.select("uid", F.col("id").alias("anchor_id")), "uid")
    return out.select("anchor_id", F.col("p_id").alias("positive_id"), "rank", F.col("n_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
