"""Near-duplicate documents by BagMinHash signatures, banding and exact verification of multiset overlap.

A text is the multiset of its 5-word shingles. Every unit of weight of a shingle is a Poisson process whose points carry a
register; a register keeps its earliest point, and two texts agree in one with the probability of their weighted Jaccard
similarity. Weights are discretised in dyadic layers [0,1), [1,2), [2,4), ...: a layer that lies inside the weight is one
process of its whole rate; in the layer that the weight ends in, a point counts if its place in the hierarchy of halved
intervals lies below the weight: the binary digits of one uniform number are the halves that the point falls into, so all
texts see the same path. A process stops once its next point is later than all of its text's registers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import frugal, mix, run_starts, steps, utf8, word_hashes, words, written

SHINGLE = 5
THRESHOLD = 0.8
#: At similarity 0.8 a pair shares no band with probability (1 - 0.8 ** 7) ** 48, about 1 in 80,000.
BANDS, ROWS = 48, 7
#: Rounds in which buckets (after the first, those of more than a block) compare with one member before the rest is compared
#: in blocks, and members for each copy of that one's text.
STARS = 2
TOGETHER = 256
#: Rounds of star steps at most; a graph of 2**64 nodes needs fewer.
MOST_ROUNDS = 200
#: Members and shingles of a block at most (about), and the share of equal registers below which a pair can't overlap by the threshold: four and a half
#: standard errors below it, so a pair at the threshold is passed over once in 300,000 times.
BLOCK = 256
BLOCK_SHINGLES = 256_000
LEAST_EQUAL = THRESHOLD - 4.5 * (THRESHOLD * (1 - THRESHOLD) / (BANDS * ROWS)) ** 0.5


def shingles(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (text << 52 | shingle hash) keys of a step's texts, and the number of shingles of each text. A text with
    fewer than ``SHINGLE`` words has one shingle of all its words, one without words none."""
    starts, stops, at = words(data, ends)
    n = np.diff(at)
    doc = np.repeat(np.arange(len(n)), n)
    own = word_hashes(data, starts, stops)
    width = max(len(own) - SHINGLE + 1, 0)
    h = np.zeros(width, np.uint64)
    for j in range(SHINGLE):
        h = h * np.uint64(0xD1342543DE82EF95) + own[j : j + width]
    inside = np.flatnonzero(doc[: len(h)] == doc[SHINGLE - 1 :]) if len(h) else np.zeros(0, np.int64)
    key_doc, key = doc[inside], h[inside]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        rest = np.zeros(len(short), np.uint64)
        for j in range(SHINGLE - 1):
            has = n[short] > j
            rest[has] = rest[has] * np.uint64(0xD1342543DE82EF95) + own[at[short[has]] + j]
        key_doc, key = np.concatenate([key_doc, short]), np.concatenate([key, rest])
    keys = np.sort((key_doc.astype(np.uint64) << np.uint64(52)) | (mix(key) >> np.uint64(12)))
    return keys, np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))


def signatures(keys: np.ndarray, texts: int, m: int = BANDS * ROWS) -> np.ndarray:
    """The registers (``texts`` x ``m`` times of earliest points) of the multisets that ``shingles`` gives."""
    reg = np.full(texts * m, np.inf)
    runs = run_starts(keys)
    weight = np.diff(np.append(runs, len(keys)))
    doc = (keys[runs] >> np.uint64(52)).astype(np.int64)
    element = keys[runs] & np.uint64((1 << 52) - 1)
    todo = [(doc, mix(element), np.ones(len(doc)), np.ones(len(doc)))]  # the layer [0, 1)
    low = 1
    while len(more := np.flatnonzero(weight > low)):  # the layers [low, 2 * low)
        seed = mix(element[more] ^ np.uint64((low * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        todo.append((doc[more], seed, np.full(len(more), float(low)), np.minimum(weight[more] - low, low) / low))
        low *= 2
    doc, seed, rate, share = (np.concatenate(x) for x in zip(*todo, strict=True))
    t = np.zeros(len(doc))
    turn = 0
    while len(doc):
        turn += 1
        a = mix(seed + np.uint64((turn * 0xBF58476D1CE4E5B9) & (2**64 - 1)))
        t = t - np.log(((a >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        b = mix(a)
        place = doc * m + ((b >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        if (share < 1).any():
            hit = (mix(b) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < share
            np.minimum.at(reg, place[hit], t[hit])
        else:
            np.minimum.at(reg, place, t)
        last = reg.reshape(texts, m).max(axis=1)
        go = t < last[doc]
        doc, seed, rate, share, t = doc[go], seed[go], rate[go], share[go], t[go]
    return reg.reshape(texts, m)


def bands(reg: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band of ``ROWS`` registers, the band's number worked in."""
    bits = reg.view(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x94D049BB133111EB), (len(reg), BANDS)).copy()
    for r in range(ROWS):
        out = mix(out ^ bits[:, r * BANDS : (r + 1) * BANDS])
    return out.view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_shingles, bands, sketch`` for every document; bands and sketch (a byte of each register) are
    null for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in steps(batches):
            data, ends = utf8(rb.column("text"))
            keys, n = shingles(data, ends)
            reg = signatures(keys, len(n))
            found, some = bands(reg), n > 0
            sketch = (mix(reg.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)
            sketches = pa.array([x.tobytes() if y else None for x, y in zip(sketch, some, strict=True)], pa.binary())
            at = np.zeros(len(n) + 1, np.int32)
            np.cumsum(some * BANDS, out=at[1:])
            lists = pa.ListArray.from_arrays(pa.array(at, mask=np.append(~some, False)), pa.array(found[some].ravel()))
            yield pa.RecordBatch.from_pydict({"doc_id": rb.column("doc_id"), "text_key": rb.column("text_key"), "n_shingles": pa.array(n), "bands": lists, "sketch": sketches})

    rows = docs.select("doc_id", "text", F.coalesce(F.sha2("text", 256), F.lit("null")).alias("text_key"))
    return rows.mapInArrow(frugal(run), "doc_id long, text_key string, n_shingles long, bands array<long>, sketch binary")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each group of equal keys, which lie together, as a table; a group may span batches."""
    rest = None
    for rb in batches:
        if not rb.num_rows:
            continue
        t = pa.Table.from_batches([rb])
        t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
        columns = [t[k].to_numpy() for k in keys]
        begins = np.concatenate([[0], np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1])
        for x, y in zip(begins[:-1], begins[1:], strict=True):
            yield t.slice(x, y - x).combine_chunks()
        rest = t.slice(begins[-1])
    if rest is not None:
        yield rest.combine_chunks()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b``: the pairs (``centre, node, size``) whose texts overlap by ``THRESHOLD`` or more.

    A centre's members are dealt by a hash into parts of about ``TOGETHER`` (``size`` is the number of its bucket's
    members); each part gets the centre's text once, ahead of its members', and goes through a task as a stream.
    So neither a join nor a task meets a centre with all of its members.
    """
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / TOGETHER)).cast("int"))
    heads = dealt.select("centre", "part").distinct().join(texts.withColumnRenamed("node", "centre"), "centre").withColumn("node", F.lit(None).cast("long"))
    rows = heads.unionByName(dealt.select("centre", "part", "node").join(texts, "node")).select("centre", "part", "node", "text")
    rows = rows.repartition(parts, "centre", "part").sortWithinPartitions("centre", "part", F.col("node").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for rb in steps(batches):
            sets = _multisets(rb.column("text"))
            a, b = [], []
            for centre, node, own in zip(rb.column("centre").to_pylist(), rb.column("node").to_pylist(), sets, strict=True):
                if node is None:
                    head = own
                elif _similarity(head, own) >= THRESHOLD:
                    a.append(min(centre, node))
                    b.append(max(centre, node))
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return written(rows.mapInArrow(frugal(run), "a long, b long"), "links")


def _multisets(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each of a step's texts the distinct shingles, sorted, and how often each occurs."""
    keys, n = shingles(*utf8(texts))
    runs = run_starts(keys)
    counts, own = np.diff(np.append(runs, len(keys))), keys[runs]
    cut = np.searchsorted(own, np.arange(len(n) + 1, dtype=np.uint64) << np.uint64(52))
    plain = own & np.uint64((1 << 52) - 1)
    return [(plain[x:y], counts[x:y]) for x, y in zip(cut[:-1], cut[1:], strict=True)]


def _similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The Jaccard similarity of two multisets."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    inter = np.minimum(a[1], b[1][at])[b[0][at] == a[0]].sum()
    return float(inter / (a[1].sum() + b[1].sum() - inter))


def _in_blocks(members: DataFrame) -> DataFrame:
    """Members (bucket, node, n, class_id) of buckets, once for each pair of blocks that they are compared in:
    ``bucket, low, high, own, node, n, class_id``.

    A block has about ``BLOCK`` members and ``BLOCK_SHINGLES`` shingles. A class that fills half a block or more has blocks of
    its own, which are never paired with each other; the members of smaller classes share the other blocks by a hash. So a
    large class costs one pair of blocks for each block of the others, not its square.
    """
    blocks = lambda n, sh: F.greatest(F.ceil(n / BLOCK), F.ceil(sh / BLOCK_SHINGLES)).cast("int")
    per = members.groupBy("bucket", "class_id").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("sh"))
    per = per.withColumn("own_blocks", F.when((F.col("c") * 2 >= BLOCK) | (F.col("sh") * 2 >= BLOCK_SHINGLES), blocks(F.col("c"), F.col("sh"))))
    before = Window.partitionBy("bucket").orderBy("class_id").rowsBetween(Window.unboundedPreceding, -1)
    large = per.where("own_blocks is not null").select("bucket", "class_id", "own_blocks", F.coalesce(F.sum("own_blocks").over(before), F.lit(0)).cast("int").alias("first"))
    small = F.col("own_blocks").isNull()
    total = per.groupBy("bucket").agg(
        F.coalesce(F.sum("own_blocks"), F.lit(0)).cast("int").alias("taken"), F.coalesce(blocks(F.sum(F.when(small, F.col("c"))), F.sum(F.when(small, F.col("sh")))), F.lit(0)).alias("shared")
    )
    rows = members.join(total, "bucket").join(large, ["bucket", "class_id"], "left")
    place = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    rows = rows.withColumn("own", F.when(F.col("first").isNull(), F.col("taken") + place(F.greatest("shared", F.lit(1)))).otherwise(F.col("first") + place(F.col("own_blocks"))))
    every = F.sequence(F.lit(0), F.col("taken") + F.col("shared") - 1)
    others = F.filter(every, lambda x: F.coalesce((x < F.col("first")) | (x >= F.col("first") + F.col("own_blocks")), F.lit(True)))
    rows = rows.withColumn("other", F.explode(others))
    return rows.select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "n", "class_id")


def _candidates(members: DataFrame, signs: DataFrame) -> DataFrame:
    """``bucket, low, high, node, partners``: within each pair of blocks the members of different classes whose sketches and
    numbers of shingles allow a link, with those they are held against; a partner that has none of its own has an empty list.

    Ids and sketches alone are shuffled. A pair that shares several buckets is compared in the first of its bands.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _in_blocks(members).join(signs, "node").select("bucket", "low", "high", "own", "node", "n", "class_id", "bands", "sketch")
    rows = rows.repartition(parts, "bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "node")
    floor = LEAST_EQUAL - 1 / 256

    def compare(t: pa.Table) -> dict[int, list[int]]:
        own, low, high = (t[c].to_numpy() for c in ("own", "low", "high"))
        left, right = np.flatnonzero(own == low[0]), np.flatnonzero(own == high[0])
        node, n, label = (t[c].to_numpy() for c in ("node", "n", "class_id"))
        found: dict[int, list[int]] = {}
        if not len(left) or not len(right) or label.min() == label.max():
            return found
        sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(len(node), -1)
        bucket = t["bucket"][0].as_py()
        band = t["bands"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        for i in left:
            ok = right[(label[right] != label[i]) & (np.minimum(n[right], n[i]) >= THRESHOLD * np.maximum(n[right], n[i]))]
            ok = ok[node[ok] > node[i]] if low[0] == high[0] else ok[node[ok] != node[i]]
            if len(ok):
                ok = ok[(sketch[ok] == sketch[i]).mean(axis=1) >= floor]
                first = (band[ok] == band[i]).argmax(axis=1)
                ok = ok[band[i, first] == bucket]
            if len(ok):
                found.setdefault(int(node[i]), []).extend(node[ok].tolist())
                for k in node[ok].tolist():
                    found.setdefault(k, [])
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, ["bucket", "low", "high"]):
            found = compare(t) if len(t) > 1 else {}
            if found:
                k = len(found)
                same = {c: pa.array([t[c][0].as_py()] * k, t.schema.field(c).type) for c in ("bucket", "low", "high")}
                yield pa.RecordBatch.from_pydict(same | {"node": pa.array(list(found), pa.int64()), "partners": pa.array(list(found.values()), pa.list_(pa.int64()))})

    return rows.mapInArrow(frugal(run), "bucket long, low int, high int, node long, partners array<long>")


def _linked(members: DataFrame, signs: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b``: the links (overlap of ``THRESHOLD`` or more) between different classes within buckets.

    ``members``: bucket, node, n, class_id; ``signs``: node, bands, sketch; ``texts``: node, text. Pairs of blocks are compared
    by sketches first; the texts of those that can overlap enough, and only theirs, then go to their pair of blocks, where
    the multisets decide. Only links come out, so neither a task nor the result holds all pairs of a large bucket.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(_candidates(members, signs), "candidates").join(texts, "node").select("bucket", "low", "high", "node", "partners", "text")
    rows = rows.repartition(parts, "bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, ["bucket", "low", "high"]):
            node = t["node"].to_pylist()
            sets, a, b = {}, [], []
            for rb in steps(t.select(["text"]).to_batches()):
                for own in _multisets(rb.column("text")):
                    sets[node[len(sets)]] = own
            for i, partners in zip(node, t["partners"].to_pylist(), strict=True):
                for j in partners:
                    if _similarity(sets[i], sets[j]) >= THRESHOLD:
                        a.append(min(i, j))
                        b.append(max(i, j))
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.mapInArrow(frugal(run), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, class_id`` for every node of ``a, b`` links (a written table): the smallest node it is connected to.

    Large-star and small-star steps in turn until nothing changes; each is an aggregation and a join on the node, so the
    links of a node with many of them are spread, and the number of rounds grows with the logarithm of the graph. A round is
    written once: its two steps are one job, as a written table costs more than the steps of a small graph.
    """
    now = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v")
    for _ in range(MOST_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lower = F.when(F.col("v") < F.col("u"), F.col("v"))
        # settled when every node has one link (or that one again) and no centre has one
        unsettled = (F.min(lower) < F.max(lower)) | (F.min(lower).isNotNull() & (F.max("v") > F.first("u")))
        if not both.groupBy("u").agg(unsettled.alias("unsettled")).where("unsettled").limit(1).count():
            break
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        joined = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        now = written(small.distinct(), "star")
    else:
        raise RuntimeError("components haven't settled")
    return written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("class_id")).withColumnRenamed("u", "node"), "classes")


def merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` (``components`` of earlier links) after more ``links``: only links between different classes are followed, from
    class to class. The same as ``components`` of all links together."""
    of = lambda side: classes.select(F.col("node").alias(side), F.col("class_id").alias(f"_{side}"))
    met = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    met = written(met.where("a <> b"), "met")
    if not met.limit(1).count():
        return classes
    joint = components(met)
    moved = classes.join(joint.select(F.col("node").alias("class_id"), F.col("class_id").alias("_to")), "class_id", "left").select("node", F.coalesce("_to", "class_id").alias("class_id"))
    return written(moved.unionByName(joint.join(classes, "node", "left_anti")), "classes")


def _mixed(labels: DataFrame, star: int) -> DataFrame:
    """``bucket, size, c``: the buckets whose members (bucket, node, n, class_id) are of several classes, with one of them by a hash."""
    centre = F.min_by(F.struct("node", "class_id", "n"), F.struct(F.xxhash64("node", F.lit(star)), F.col("node")))
    per = labels.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("class_id").alias("least"), F.max("class_id").alias("most"), centre.alias("c"))
    return per.where("least < most").select("bucket", "size", "c")


def classed(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, n_shingles`` for every row: the class is the smallest doc_id that the row's text is linked
    to, through equal texts and through pairs of texts whose shingle multisets overlap by ``THRESHOLD`` or more.

    Equal texts are one node, the smallest of their doc_ids. Texts that share a band meet in its bucket; a bucket's members
    are compared with one of them, and then, in blocks, only those of a bucket that are not yet in one class and whose sketches
    allow a link, so a large group of copies costs one comparison for each member and no bucket becomes a list of pairs. Texts without
    words (null ones too) are alike only if they are equal. A null doc_id takes no part in links, and has the class of an equal
    text or null. Rows that share a doc_id share a node. Only doc_id and text are read.
    """
    signs = written(signed(docs), "signatures")
    nodes = signs.groupBy("text_key").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    nodes = written(nodes, "nodes")
    linked = nodes.where("node is not null and bands is not null")
    members = linked.select(F.explode("bands").alias("bucket"), "node", "n")
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("centre")).where("size > 1")
    members = written(members.join(shared, "bucket"), "members")

    need = members.select("node").distinct()
    # one row for each node: repeated rows are left out by the group, which the join's partitioning serves
    texts = docs.select(F.col("doc_id").alias("node"), "text").where("node is not null").join(need, "node", "left_semi")
    texts = written(texts.groupBy("node").agg(F.min("text").alias("text")), "texts")

    tested = classes = None
    for star in range(STARS):
        if star == 0:
            met = members.where("node <> centre")
        else:
            labels = members.select("bucket", "node", "n").join(classes, "node", "left").withColumn("class_id", F.coalesce("class_id", "node"))
            large = _mixed(labels, star).where(F.col("size") > BLOCK)  # others are one or two blocks, which decide at once
            met = labels.join(large, "bucket").where("c.class_id <> class_id")
            met = met.where(F.least("n", "c.n") >= THRESHOLD * F.greatest("n", "c.n")).withColumn("centre", F.col("c.node"))
        pairs = met.select("centre", "node", "size")
        pairs = pairs.groupBy("centre", "node").agg(F.max("size").alias("size")).select("*", F.least("centre", "node").alias("x"), F.greatest("centre", "node").alias("y"))
        pairs = written(pairs if tested is None else pairs.join(tested, ["x", "y"], "left_anti"), "pairs")
        tested = pairs.select("x", "y") if tested is None else tested.unionByName(pairs.select("x", "y"))
        if star and not pairs.limit(1).count():
            continue
        found = _verified(pairs, texts)
        classes = components(found) if classes is None else merged(classes, found)
    labels = members.select("bucket", "node", "n").join(classes, "node", "left").withColumn("class_id", F.coalesce("class_id", "node"))
    rest = written(labels.join(_mixed(labels, STARS).select("bucket"), "bucket"), "mixed")
    if rest.limit(1).count():
        classes = merged(classes, written(_linked(rest, linked.select("node", "bands", "sketch"), texts), "links"))
    out = nodes.join(classes, "node", "left").select("text_key", F.coalesce("class_id", "node").alias("class_id"), "copies", F.col("class_id").isNotNull().alias("in_links"))
    several = out.where("copies > 1 or in_links").select("text_key", "class_id")
    alone = signs.select("doc_id", "text_key", "n_shingles").join(several, "text_key", "left")
    return alone.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "n_shingles")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest doc_id (of rows that share it, the one whose text is
    least, then whose other columns are by their JSON, so columns of any type may stand beside). Rows without a doc_id stay, as
    nothing tells them apart."""
    keep = classed(docs).where("doc_id = class_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(keep, "doc_id", "left_semi")
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    order = F.struct("text", F.to_json(F.struct(*rest)) if rest else F.lit(""))
    named = named.groupBy("doc_id").agg(F.min_by(every, order).alias("_row")).select("_row.*")
    return named.unionByName(docs.where("doc_id is null"))
