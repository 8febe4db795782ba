"""Isolation forests per stratum: axis-parallel, or with random hyperplanes over two features.

Each tree's subsample is drawn by hashes of the row key, so any partitioning gives the same forest. Trees are grown by
tasks, one for each (stratum, tree) with at most ``psi`` rows; rows are scored where they lie.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sondage.scratch import written

from .quantiles import joined, key_of, quantiles

TOGETHER = 64
#: Bytes of a forest that is broadcast, and rows of a group that meets a larger forest.
BROADCAST_BYTES = 128 << 20
GROUP_ROWS = 50_000
#: Rows that a task gathers before it scores them by stratum, so that each stratum's share is long; and rows that walk a tree at once.
GATHER_ROWS = 131_072
WALK_ROWS = 10_000
NODES = "stratum string, tree int, node int, coef array<double>, threshold double, left int, right int, size int, depth int"


@dataclass(frozen=True)
class Forest:
    trees: int = 200
    psi: int = 256
    ndim: int = 1
    max_depth: int | None = None
    seed: int = 42
    least_rows: int = 10


def path_length(n: float) -> float:
    """The mean path length of an unsuccessful search among n points."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def subsamples(rows: DataFrame, forest: Forest, budget: bool = False) -> DataFrame:
    """``stratum, tree, _k, x``: of every stratum with enough rows (``_key, stratum, x``) at most ``psi`` rows a tree, drawn by hashes.

    In each round a row falls into one of n / (1.2 psi) pools by a hash, and each pool is a tree: a large stratum takes one
    hash a row, a small one as many rounds as its trees need. The draw is some 1.2 psi rows a tree before its exact cut.
    """
    # written: of few strata it is a small file, which joins the rows without a shuffle by stratum, so a large one stays spread
    sizes = written(rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") >= forest.least_rows) & F.col("stratum").isNotNull()), "strata")
    rows = rows.select("stratum", F.xxhash64("_key").alias("_k"), "x").join(sizes, "stratum")
    trees = F.greatest(F.lit(48), F.least(F.lit(forest.trees), F.col("_n"))).cast("int") if budget else F.lit(forest.trees)
    pools = F.greatest(F.lit(1), F.floor(F.col("_n") / (1.2 * F.least(F.lit(forest.psi), F.col("_n")))))
    rounds = F.sequence(F.lit(0), (F.ceil(trees / pools) - 1).cast("int"))
    own = F.transform(rounds, lambda r: (r * pools + F.pmod(F.xxhash64(F.col("_k"), r, F.lit(forest.seed)), pools) + 1).cast("int"))
    hit = F.filter(own, lambda t: t <= trees)
    # where one round is enough, most rows are in no tree's pool: told by the first round's hash alone
    rows = rows.where((trees > pools) | (F.pmod(F.xxhash64("_k", F.lit(0), F.lit(forest.seed)), pools) < trees))
    rows = rows.select("stratum", F.explode(hit).alias("tree"), "_k", "x")
    order = Window.partitionBy("stratum", "tree").orderBy(F.xxhash64("_k", "tree", F.lit(forest.seed)), "_k", "x")
    return rows.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= forest.psi).drop("_r")


def _uniform(seed: int, *parts: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on the seed and the parts alone (rounds of a 64-bit finaliser)."""
    x = np.full(np.broadcast(*parts).shape, seed, np.uint64)
    with np.errstate(over="ignore"):
        for p in parts:
            x = (x ^ np.asarray(p).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def grow(x: np.ndarray, tree: np.ndarray, salt: int, forest: Forest) -> dict[str, np.ndarray]:
    """Nodes of several trees, all of a level at once: columns of ``NODES`` after the stratum. Rows are those of ``x``, dealt to trees
    by ``tree`` (ascending). A node is split at a random place of a random feature, or of a random weighing of ``ndim`` features."""
    names, first = np.unique(tree, return_index=True)
    size = np.diff(np.append(first, len(tree)))
    cap = np.full(len(names), forest.max_depth) if forest.max_depth else np.maximum(1, np.ceil(np.log2(np.maximum(size, 2)))).astype(int)
    p, out, depth = x.shape[1], [], 0
    owner, node, count = np.arange(len(names)), np.zeros(len(names), int), np.ones(len(names), int)  # of the level's nodes; nodes of a tree so far
    starts = first
    while len(owner):
        ends = np.append(starts, len(x))
        n = np.diff(ends)
        at = np.repeat(np.arange(len(n)), n)
        spread = np.maximum.reduceat(x, starts) - np.minimum.reduceat(x, starts)
        own = lambda k, j=0: _uniform(forest.seed, np.uint64(salt), names[owner][:, None], node[:, None], np.asarray(j), np.uint64(k))  # noqa: B023, E731
        order = np.where(spread > 0, own(1, np.arange(p)), 2.0)
        pick = np.argsort(order, axis=1, kind="stable")[:, : min(forest.ndim, p)]
        live = np.take_along_axis(order, pick, 1) < 2.0
        if forest.ndim == 1:
            weight = live.astype(float)
        else:
            u, v = own(2, np.arange(pick.shape[1])), own(3, np.arange(pick.shape[1]))
            mean = np.add.reduceat(x, starts) / n[:, None]
            std = np.sqrt(np.add.reduceat((x - mean[at]) ** 2, starts) / n[:, None])
            weight = live * np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v) / np.maximum(np.take_along_axis(std, pick, 1), 1e-12)
        value = (np.take_along_axis(x, pick[at], 1) * weight[at]).sum(axis=1)
        low, high = np.minimum.reduceat(value, starts), np.maximum.reduceat(value, starts)
        cut = low + own(4)[:, 0] * (high - low)
        left = value <= cut[at]
        n_left = np.add.reduceat(left.astype(int), starts)
        split = (n > 1) & (depth < cap[owner]) & live.any(axis=1) & (n_left > 0) & (n_left < n)
        coef = np.zeros((len(n), p))
        np.put_along_axis(coef, pick, weight, 1)
        grows = np.flatnonzero(split)
        rank = np.arange(len(grows)) - np.searchsorted(owner[grows], owner[grows])  # place among the tree's splits of this level
        child = count[owner[grows]] + 2 * rank
        sides = np.full((2, len(n)), -1)
        sides[0, grows], sides[1, grows] = child, child + 1
        out.append((names[owner], node, coef, np.where(split, cut, np.nan), sides[0], sides[1], n, np.full(len(n), depth), split))
        count = count + 2 * np.bincount(owner[grows], minlength=len(names))
        keep = split[at]
        place = 2 * (np.cumsum(split) - 1)[at[keep]] + ~left[keep]
        by = np.argsort(place, kind="stable")
        x, place = x[keep][by], place[by]
        starts = np.searchsorted(place, np.arange(2 * len(grows)))
        owner, node, depth = np.repeat(owner[grows], 2), np.stack([child, child + 1], 1).ravel(), depth + 1
    columns = [np.concatenate(c) for c in zip(*out, strict=True)]
    return dict(zip(("tree", "node", "coef", "threshold", "left", "right", "size", "depth", "split"), columns, strict=True))


def grown(samples: DataFrame, forest: Forest) -> DataFrame:
    """The forest as a table of nodes; a leaf has null children."""

    def several(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tree", "_k"], kind="stable")
        stratum = pdf["stratum"].iloc[0]
        salt = int.from_bytes(hashlib.blake2b(str(stratum).encode(), digest_size=8).digest(), "little")
        got = grow(np.vstack(pdf["x"].to_numpy()), pdf["tree"].to_numpy(), salt, forest)
        split = got.pop("split")
        nodes = pd.DataFrame({k: v for k, v in got.items() if k != "coef"}).astype({"left": "Int32", "right": "Int32"})
        nodes["coef"] = [c if s else None for c, s in zip(got["coef"].tolist(), split, strict=True)]
        nodes.loc[~split, ["left", "right", "threshold"]] = None
        return nodes.assign(stratum=stratum)[[c.split(" ")[0] for c in NODES.split(", ")]]

    # a group of trees is a task's worth of work: at most TOGETHER * psi rows
    return samples.groupBy("stratum", F.floor(F.col("tree") / TOGETHER).alias("_g")).applyInPandas(several, NODES)


def _packed(own: pd.DataFrame, p: int, ndim: int) -> tuple:
    """One tree as arrays by node: its features and their weights (None for a single feature, whose weight is 1), the cut, both
    children (a leaf's are itself), the path length, and the tree's depth."""
    n = len(own)
    leaf = own["left"].isna().to_numpy()
    coef = np.array([c if c is not None else np.zeros(p) for c in own["coef"]], float)
    order = np.argsort(-np.abs(coef), axis=1, kind="stable")[:, : min(ndim, p)]
    pick = [np.ascontiguousarray(order[:, j]) for j in range(order.shape[1])]
    weight = [coef[np.arange(n), k] for k in pick] if ndim > 1 else None
    child = np.repeat(np.arange(n), 2)
    for side, column in enumerate(("left", "right")):
        child[2 * np.flatnonzero(~leaf) + side] = own[column].to_numpy(float, na_value=-1)[~leaf].astype(np.intp)
    length = np.array([d + path_length(m) for d, m in zip(own["depth"], own["size"], strict=True)])
    return pick, weight, own["threshold"].fillna(0).to_numpy(float), child, length, int(own["depth"].max())


def _packs(nodes: pd.DataFrame, p: int, ndim: int) -> tuple[list[tuple], int]:
    """(trees as arrays, the largest tree's rows) of one stratum."""
    packs = [_packed(own.sort_values("node"), p, ndim) for _, own in nodes.groupby("tree")]
    return packs, int(nodes["size"].max())


def _score(x: np.ndarray, packs: list[tuple], psi: int) -> np.ndarray:
    """Scores of rows (n x features) under one stratum's trees."""
    total = np.zeros(len(x))
    for first in range(0, len(x), WALK_ROWS):
        _walk(np.ascontiguousarray(x[first : first + WALK_ROWS]), packs, total[first : first + WALK_ROWS])
    return 2.0 ** (-total / len(packs) / max(path_length(psi), 1e-12))


def _walk(x: np.ndarray, packs: list[tuple], total: np.ndarray) -> None:
    """Adds to ``total`` the path length of each row in every tree. Its arrays are used again at every step (with mode "clip", which
    never applies, numpy takes into them directly)."""
    n = len(x)
    flat, base = x.ravel(), np.arange(n) * x.shape[1]
    at, place, value, side, right = np.empty(n, np.intp), np.empty(n, np.intp), np.empty(n), np.empty(n), np.empty(n, bool)
    take = lambda array, i, out: array.take(i, out=out, mode="clip")
    for pick, weight, cut, child, length, depth in packs:
        at.fill(0)
        for _ in range(depth):
            np.add(take(pick[0], at, place), base, out=place)
            take(flat, place, value)
            if weight:
                np.multiply(value, take(weight[0], at, side), out=value)
                for p, w in zip(pick[1:], weight[1:], strict=True):
                    np.add(value, flat.take(base + p.take(at)) * w.take(at), out=value)
            np.greater(value, take(cut, at, side), out=right)
            np.add(at, at, out=at)
            np.add(at, right, out=at)
            at, place = take(child, at, place), at
        total += length.take(at)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' rows in batches of about ``GATHER_ROWS``."""
    own, n = [], 0
    for rb in batches:
        own.append(rb)
        n += rb.num_rows
        if n >= GATHER_ROWS:
            yield pa.Table.from_batches(own).combine_chunks().to_batches()[0]
            own, n = [], 0
    if n:
        yield pa.Table.from_batches(own).combine_chunks().to_batches()[0]


def scored(rows: DataFrame, nodes: DataFrame, p: int, forest: Forest) -> DataFrame:
    """``rows`` (``_key, stratum, x``: the p features) with ``iso_score`` in (0, 1), higher for rows that are isolated sooner; null in
    strata without a forest and where the stratum is null. No row is lost.

    A forest of at most ``BROADCAST_BYTES`` goes to all tasks. A larger one (it grows with strata and trees) stays
    distributed: rows meet their stratum's trees in groups of about ``GROUP_ROWS`` rows.
    """
    schema = rows.select("_key", "stratum", F.lit(None).cast("double").alias("iso_score")).schema
    if nodes.count() * (64 + 8 * p) <= BROADCAST_BYTES:
        packs = {s: _packs(own, p, forest.ndim) for s, own in nodes.toPandas().groupby("stratum")}
        shared = rows.sparkSession.sparkContext.broadcast(packs)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packs = shared.value
            for rb in _gathered(batches):
                score = np.full(rb.num_rows, np.nan)
                x = np.asarray(rb.column("x").flatten().to_numpy(zero_copy_only=False), float).reshape(rb.num_rows, p)
                strata = rb.column("stratum").dictionary_encode()
                codes = pc.fill_null(strata.indices, len(strata.dictionary)).to_numpy()
                order = np.argsort(codes, kind="stable")
                ends = np.searchsorted(codes[order], np.arange(len(strata.dictionary) + 1))
                for s, a, b in zip(strata.dictionary.to_pylist(), ends[:-1], ends[1:], strict=True):
                    if s in packs:
                        score[order[a:b]] = _score(x[order[a:b]], *packs[s])
                yield pa.RecordBatch.from_arrays([rb.column("_key"), rb.column("stratum"), pa.array(score, from_pandas=True)], names=["_key", "stratum", "iso_score"])

        return rows.select("_key", "stratum", "x").mapInArrow(run, schema)
    sizes = written(rows.where("stratum is not null").groupBy("stratum").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int").alias("_groups")), "strata")
    dealt = rows.join(sizes, "stratum", "left").withColumn("_group", F.coalesce(F.pmod(F.xxhash64("_key"), F.col("_groups")), F.lit(0)).cast("int")).drop("_groups")
    trees = nodes.join(sizes, "stratum").withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))).drop("_groups")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        score = np.full(left.num_rows, np.nan)
        if left.num_rows and right.num_rows:
            x = np.vstack([np.asarray(v, float) for v in left.column("x").to_pylist()])
            score = _score(x, *_packs(right.to_pandas(), p, forest.ndim))
        return pa.table({"_key": left.column("_key"), "stratum": left.column("stratum"), "iso_score": pa.array(score, pa.float64(), from_pandas=True)})

    return dealt.groupBy("stratum", "_group").cogroup(trees.groupBy("stratum", "_group")).applyInArrow(meet, schema)


def narrow_features(df: DataFrame, features: list[str], stratum: Column, key: list[str]) -> DataFrame:
    """``_key`` (a struct of the key's columns), ``stratum`` and the features as doubles, NaN as null: the one table, written once, that
    imputing, sampling, growing and scoring read instead of ``df``. It is dealt by key, so that scoring has rows for all cores."""
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    number = lambda f: F.nanvl(F.col(f).try_cast("double"), F.lit(None).cast("double"))
    return written(df.select(key_of(key).alias("_key"), stratum.cast("string").alias("stratum"), *[number(f).alias(f"f{i}") for i, f in enumerate(features)]).repartition(parts, "_key"), "narrow")


def narrow_scores(rows: DataFrame, p: int, forest: Forest = Forest(), budget: bool = False) -> DataFrame:
    """``_key, stratum, iso_score`` of ``narrow_features`` rows, written; a missing feature takes its stratum's median (0 without
    one), whose counts are exact (see ``quantiles``). Medians are counted for features that are missing somewhere, and only those."""
    lacks = rows.agg(*[F.count_if(F.col(f"f{i}").isNull()).alias(f"f{i}") for i in range(p)]).first()
    gaps = [i for i in range(p) if lacks[f"f{i}"]]
    full = joined(rows, ["stratum"], quantiles(rows, ["stratum"], {f"m{i}": F.col(f"f{i}") for i in gaps}, 0.5, settled=True)) if gaps else rows
    filled = lambda i: F.coalesce(f"f{i}", f"m{i}", F.lit(0.0)) if i in gaps else F.coalesce(f"f{i}", F.lit(0.0))
    full = full.select("_key", "stratum", F.array(*[filled(i) for i in range(p)]).alias("x"))
    nodes = written(grown(subsamples(full, forest, budget), forest), "forest")
    return written(scored(full, nodes, p, forest), "scores")


def isolation_scores(df: DataFrame, features: list[str], stratum: str, key: list[str], forest: Forest = Forest(), budget: bool = False) -> DataFrame:
    """``df`` with ``iso_score``; ``key`` tells rows apart, and of rows that share one each gets the highest score among them."""
    return with_scores(df, narrow_scores(narrow_features(df, features, F.col(stratum), key), len(features), forest, budget), key)


def with_scores(df: DataFrame, scores: DataFrame, key: list[str]) -> DataFrame:
    """``df`` with the score columns of its key's row: only what is asked for of ``df`` is shuffled, and no row is lost. Both sides are
    sorted by a hash of the key, a number, and by the key only where hashes agree; scores, mostly one a key, are shuffled as they are."""
    names, hashed = [c for c in scores.columns if c not in ("_key", "stratum")], F.xxhash64("_key").alias("_h")
    best = lambda n: F.max_by(n, F.coalesce("iso_score", F.lit(-1.0))).alias(n)
    scores = scores.select(hashed, "_key", *names).repartition("_h", "_key").groupBy("_h", "_key").agg(*[best(n) for n in names])
    return df.drop(*names).withColumn("_key", key_of(key)).select("*", hashed).join(scores, ["_h", "_key"], "left").drop("_h", "_key")
