"""A quality classifier by compression: zstandard dictionaries of good and of bad text, and which of them a text suits better.

Texts are compressed in blocks of ``BLOCK`` bytes under both dictionaries, so a long text is judged along its whole length. The
difference of the compressed sizes, divided by the text's bytes (and ``PRIOR`` more, so a few bytes don't weigh much in a
short text), is calibrated to a probability by a logistic line fitted on documents that the dictionaries haven't seen.

The fit takes a bounded sample: of each class at most ``SAMPLE_DOCS`` labelled documents in the order of a hash of their ids, and
of these, in that order, texts while they fit into ``SAMPLE_BYTES``. Every text is scored, and whole.

Defined results: null and empty texts have difference 0 and the score that belongs to it; rows without an id aren't learned from;
ids with labels of both kinds, or none, aren't either; with a class that has no sample every score is 1 or 0 after the only class
there is, or 0.5 without any.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import steps

SAMPLE_DOCS = 4_000
SAMPLE_BYTES = 8 << 20
DICT_BYTES = 64 << 10
BLOCK = 512
PRIOR = 64
LEVEL = 3
#: One in so many sample documents calibrates; the others make the dictionaries.
FOLD = 3


@dataclass(frozen=True)
class Model:
    """Dictionaries (None: no sample of a class) and the line from differences to log odds."""

    good: bytes | None
    bad: bytes | None
    slope: float
    offset: float


def blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]


class Sizes:
    """Compressed bytes of a text under one dictionary, all its blocks together."""

    def __init__(self, dictionary: bytes) -> None:
        data = zstandard.ZstdCompressionDict(dictionary)
        data.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False)

    def __call__(self, text: bytes) -> int:
        return sum(len(self.compressor.compress(b)) for b in blocks(text))


def difference(good: int, bad: int, size: int) -> float:
    return (bad - good) / (size + PRIOR)


def dictionary(texts: list[bytes]) -> bytes:
    """A dictionary of the texts' blocks; with too little text for the trainer, the text itself."""
    samples = [b for t in texts for b in blocks(t)]
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(256, sum(map(len, samples)) // 4)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICT_BYTES] or b" "


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of P(y = 1) = 1 / (1 + exp(-(slope x + offset))) by Newton steps, with Platt's targets and a slight pull
    of the slope to 0, so separable samples have an answer too."""
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = float(np.abs(x).max()) or 1.0
    design, w = np.stack([x / scale, np.ones(len(x))], 1), np.array([0.0, np.log((n1 + 1) / (n0 + 1))])
    pull = np.diag([1e-3, 0.0])
    loss = lambda w: float(np.logaddexp(0, design @ w).sum() - target @ (design @ w) + w @ pull @ w / 2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        grad, hess = design.T @ (p - target) + pull @ w, (design * (p * (1 - p))[:, None]).T @ design + pull + 1e-9 * np.eye(2)
        step, rate = np.linalg.solve(hess, grad), 1.0
        while rate > 1e-6 and loss(w - rate * step) > loss(w):
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-10:
            break
    return float(w[0]) / scale, float(w[1])


def sampled(docs: DataFrame, labels: DataFrame, allowed: Column, text: str = "text") -> dict[int, list[bytes]]:
    """The texts of each class that are learned from, in the order of their ids' hashes (see the module for the bounds).

    Only ids and lengths are looked at before the texts are chosen; the texts that reach the driver are at most ``SAMPLE_BYTES`` a class.
    """
    marks = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
    place = F.xxhash64(F.col("doc_id").cast("long"), F.lit(12))
    marks = marks.select("doc_id", "quality", allowed.alias("allowed"), place.alias("place")).where("allowed")
    chosen = {q: marks.where(F.col("quality") == q).orderBy("place", "doc_id").limit(SAMPLE_DOCS).collect() for q in (0, 1)}
    order = {r.doc_id: (q, i) for q, rows in chosen.items() for i, r in enumerate(rows)}
    if not order:
        return {0: [], 1: []}
    spark = docs.sparkSession
    ids = F.broadcast(spark.createDataFrame([(k,) for k in order], "doc_id long"))  # at most 2 * SAMPLE_DOCS ids
    # of rows that repeat an id the least text by its digest stands for all
    first = lambda ids: docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).where("text is not null").join(ids, "doc_id", "left_semi")
    sizes = first(ids).groupBy("doc_id").agg(F.min_by(F.octet_length("text"), F.sha2("text", 256)).alias("size"), F.min(F.sha2("text", 256)).alias("digest")).collect()
    room, wanted = {0: SAMPLE_BYTES, 1: SAMPLE_BYTES}, {}
    for r in sorted(sizes, key=lambda r: order[r.doc_id]):
        q = order[r.doc_id][0]
        if 0 < r["size"] <= room[q]:
            room[q] -= r["size"]
            wanted[r.doc_id] = r.digest
    if not wanted:
        return {0: [], 1: []}
    keys = F.broadcast(spark.createDataFrame(list(wanted.items()), "doc_id long, digest string"))
    texts = first(keys.select("doc_id")).withColumn("digest", F.sha2("text", 256)).join(keys, ["doc_id", "digest"]).dropDuplicates(["doc_id"]).collect()
    out: dict[int, list[bytes]] = {0: [], 1: []}
    for r in sorted(texts, key=lambda r: order[r.doc_id]):
        out[order[r.doc_id][0]].append(r.text.encode())
    return out


def fitted(texts: dict[int, list[bytes]]) -> Model:
    """Dictionaries from two folds of three of each class's texts, the line from the third (from all, where a class has under six)."""
    if not texts[0] or not texts[1]:
        return Model(None, None, 0.0, 50.0 if texts[1] else -50.0 if texts[0] else 0.0)
    few = min(map(len, texts.values())) < 2 * FOLD
    learn, rest = ({q: [t for i, t in enumerate(ts) if few or (i % FOLD == 0) == fold] for q, ts in texts.items()} for fold in (False, True))
    good, bad = dictionary(learn[1]), dictionary(learn[0])
    size1, size0 = Sizes(good), Sizes(bad)
    x = np.array([difference(size1(t), size0(t), len(t)) for q in (0, 1) for t in rest[q]])
    return Model(good, bad, *logistic(x, np.repeat([0, 1], [len(rest[0]), len(rest[1])])))


def train(docs: DataFrame, labels: DataFrame, allowed: Column) -> Model:
    """The model of ``labels`` (``doc_id, quality``; 1 is good) on the documents for which ``allowed`` (of ``doc_id``) holds."""
    return fitted(sampled(docs, labels, allowed))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``score`` (0 to 1, higher: good is likelier), ``predicted`` (1 from 0.5 on) and the compressed
    sizes ``size_good, size_bad``. Columns of these names are replaced. No shuffle; a batch is a bounded number of rows."""
    new = ("score", "predicted", "size_good", "size_bad")
    keep = [c for c in docs.columns if c not in (*new, text)]
    held = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICT_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        one, two = (Sizes(m.good), Sizes(m.bad)) if m.good is not None else ((lambda t: 0), (lambda t: 0))
        for rb in steps(batches, text):
            texts = [(t or "").encode() for t in rb.column(text).to_pylist()]
            good, bad = np.array([one(t) for t in texts], np.int64), np.array([two(t) for t in texts], np.int64)
            size = np.array([len(t) for t in texts], np.int64)
            score = 1 / (1 + np.exp(-np.clip(m.slope * (bad - good) / (size + PRIOR) + m.offset, -50, 50)))
            columns = [*[rb.column(c) for c in keep], pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(good), pa.array(bad)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *new])

    schema = ", ".join([*[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep], "score double, predicted int, size_good long, size_bad long"])
    return docs.select(*keep, text).mapInArrow(run, schema)
