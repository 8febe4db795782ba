"""Homomorphic multiset fingerprints of documents. Built-ins only.

A passage (a sentence of a line, with a character that is no white space) hashes to a wide vector of ``LANES`` 16-bit
values; a text's fingerprint is the sum of its passages' vectors, with their number as one more lane. So the order of
passages doesn't matter, and inserting or deleting one, or a paragraph of them, is adding or subtracting its vector. Sums
are exact (of fewer than 2**47 passages); printed, they are modulo 2**32.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 128
#: Mean of a 16-bit value: lanes less so much for each passage are centred.
MEAN = 65535 / 2
MODULUS = 1 << 32
#: Passages whose packed sums stay apart: of 2**15, a half of 64 bits less the sign holds 16-bit values.
CHUNK_BITS = 15
#: Where passages part: at line feeds, after a stop before white space, and after these stops.
STOPS, WIDE_STOPS = ".!?…", "。！？"


def parted(text: Column) -> Column:
    """A text with a line feed wherever a passage ends; plain replacements, as a pattern tried at every place is much slower."""
    for stop in STOPS:
        for blank in " \t":
            text = F.replace(text, F.lit(stop + blank), F.lit(f"{stop}\n{blank}"))
    for stop in WIDE_STOPS:
        text = F.replace(text, F.lit(stop), F.lit(stop + "\n"))
    return text


def passages(text: Column) -> Column:
    """The sentences of a text's lines that have a character other than white space; null has none."""
    return F.filter(F.split(parted(F.coalesce(text, F.lit(""))), "\n"), lambda p: F.length(F.trim(F.translate(p, "\t\r\x0b\x0c", "    "))) > 0)


def _vector(passage: Column) -> Column:
    """A passage's lanes: four from each 64-bit hash of its SHA-256 digest under a seed of its own, and a one."""
    digest = F.sha2(passage, 256)
    seeds = F.sequence(F.lit(0), F.lit(LANES // 4 - 1))
    words = F.transform(seeds, lambda i: F.xxhash64(digest, i))
    lanes = F.flatten(F.transform(words, lambda w: F.array(*[F.shiftrightunsigned(w, 16 * k).bitwiseAND(F.lit(0xFFFF).cast("long")) for k in range(4)])))
    return F.concat(lanes, F.array(F.lit(1).cast("long")))


def add(a: Column, b: Column) -> Column:
    """The fingerprint of two texts' passages together."""
    return F.zip_with(a, b, lambda x, y: x + y)


def remove(a: Column, b: Column) -> Column:
    """The fingerprint of a's passages without b's."""
    return F.zip_with(a, b, lambda x, y: x - y)


def lanes(text: Column) -> Column:
    """The fingerprint of a text as an array of longs; null and blank texts have all zeros."""
    zero = F.array_repeat(F.lit(0).cast("long"), LANES + 1)
    return F.aggregate(F.transform(passages(text), _vector), zero, add)


def printed(fingerprint: Column) -> Column:
    """A fingerprint as lower-case hexadecimal, eight digits a lane, each modulo 2**32."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x.bitwiseAND(F.lit(MODULUS - 1))), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """How alike two texts' passages are, 0 to 1, from their fingerprints alone.

    The cosine of the centred lanes estimates the cosine of the passage multisets with a standard error of
    1/sqrt(LANES), whatever their number. Equal fingerprints give 1, a blank text against another 0; negative estimates
    are of unrelated texts and count as 0.
    """
    na, nb = F.element_at(a, LANES + 1).cast("double"), F.element_at(b, LANES + 1).cast("double")
    pairs = F.arrays_zip(F.slice(a, 1, LANES).cast("array<double>").alias("x"), F.slice(b, 1, LANES).cast("array<double>").alias("y"))
    names = ["xx", "xy", "yy", "x", "y"]
    terms = lambda p: [p["x"] * p["x"], p["x"] * p["y"], p["y"] * p["y"], p["x"], p["y"]]
    named = lambda xs: F.struct(*[x.alias(n) for x, n in zip(xs, names, strict=True)])
    sums = F.aggregate(pairs, named([F.lit(0.0)] * 5), lambda s, p: named([s[n] + t for n, t in zip(names, terms(p), strict=True)]))

    def cosine_of(s: Column) -> Column:
        # lanes less their mean for each passage, multiplied out
        centred = lambda product, x, y, n, m: s[product] - F.lit(MEAN) * (n * s[x] + m * s[y]) + LANES * F.lit(MEAN) ** 2 * n * m
        return centred("xy", "y", "x", na, nb) / F.sqrt(centred("xx", "x", "x", na, na) * centred("yy", "y", "y", nb, nb))

    cosine = F.get(F.transform(F.array(sums), cosine_of), F.lit(0))  # the sums are taken once
    told = F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(0.0)))
    return F.when(a == b, F.lit(1.0)).otherwise(told)


def vectors(rows: DataFrame, keys: list[str], texts: dict[str, Column]) -> DataFrame:
    """``keys`` and, for each named text, its fingerprint (as ``lanes`` gives it); ``keys`` tell the rows apart.

    Passages become rows and lanes columns of plain sums, two lanes to a 64-bit number whose halves can't overflow
    within ``CHUNK`` passages; longer texts are sums of chunks. Rows that are partitioned by some of the keys stay where they are.
    """
    names = list(texts)
    each = F.array(*[F.struct(F.lit(i).alias("_which"), F.coalesce(t, F.lit("")).alias("_text")) for i, t in enumerate(texts.values())])
    rows = rows.select(*keys, F.inline(each)).select(*keys, "_which", F.posexplode(F.split(parted(F.col("_text")), "\n")).alias("_pos", "_passage"))
    solid = F.length(F.trim(F.translate("_passage", "\t\r\x0b\x0c", "    "))) > 0
    rows = rows.select(*keys, "_which", F.shiftright("_pos", CHUNK_BITS).alias("_chunk"), F.sha2("_passage", 256).alias("_digest"), solid.alias("_solid"))
    rows = rows.withColumn("_halves", F.when(F.col("_solid"), F.lit(0x0000FFFF0000FFFF)).otherwise(F.lit(0).cast("long")))
    words = [F.xxhash64("_digest", F.lit(i)) for i in range(LANES // 4)]
    sums = [F.sum(F.shiftrightunsigned(w, s).bitwiseAND(F.col("_halves"))).alias(f"_s{i}_{s}") for i, w in enumerate(words) for s in (0, 16)]
    chunks = rows.groupBy(*keys, "_which", "_chunk").agg(F.count_if("_solid").alias("_n"), *sums)
    low, high = lambda c: F.col(c).bitwiseAND(F.lit(MODULUS - 1)), lambda c: F.shiftrightunsigned(c, 32)
    own = F.array(*[x(f"_s{i}_{s}") for i in range(LANES // 4) for x in (low, high) for s in (0, 16)], F.col("_n"))
    chunks = chunks.select(*keys, "_which", own.alias("_lanes"))
    whole = chunks.groupBy(*keys).agg(*[F.collect_list(F.when(F.col("_which") == i, F.col("_lanes"))).alias(n) for i, n in enumerate(names)])
    total = lambda n: F.aggregate(F.slice(n, 2, F.greatest(F.size(n) - 1, F.lit(1))), F.get(F.col(n), F.lit(0)), add)
    return whole.select(*keys, *[total(n).alias(n) for n in names])


def placed(docs: DataFrame, key: str) -> DataFrame:
    """Rows in buckets (``_bucket``) of ascending ``key``, nulls first; rows at the head of a bucket once more, with ``_extra``
    1, at the end of the one before (the first rows at the end of the last).

    Buckets lie between quantiles of the key, a few for each shuffle partition. The quantiles are keys that occur, so the row
    after a bucket's last is the first at the next quantile. No bucket holds more than its share unless one key
    repeats as often.
    """
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = docs.agg(F.percentile_approx(key, [i / n for i in range(n)], 50 * n).alias("q"), F.min(key).alias("least"), F.count_if(F.col(key).isNull()).alias("nulls")).first()
    bounds = sorted(set(found["q"] or []) - {found["least"]})
    # places of a key among the bounds: first among every step-th of them, then inside that step
    step = max(1, int(len(bounds) ** 0.5))
    coarse, fine = bounds[::step], [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= F.col(key)))

    if bounds:
        kind = F.lit(coarse).cast("array<bigint>")
        parts = F.lit(fine).cast("array<array<bigint>>")
        c = below(kind)
        inside = F.when(c == 0, F.lit(0)).otherwise((c - 1) * step + below(F.get(parts, c - 1)))
        bucket = F.when(F.col(key).isNull(), F.lit(0)).otherwise(inside)
        head = F.coalesce(F.array_contains(F.get(parts, c - 1), F.col(key)), F.lit(False))
    else:
        bucket, head = F.lit(0), F.lit(False)
    first = F.col(key).isNull() if found["nulls"] else F.coalesce(F.col(key) == F.lit(found["least"]), F.lit(False))
    none = F.array().cast("array<struct<bucket:int,extra:int>>")
    place = lambda b, extra: F.array(F.struct(b.cast("int").alias("bucket"), F.lit(extra).alias("extra")))
    rows = docs.withColumn("_b", bucket)
    places = F.concat(place(F.col("_b"), 0), F.when(head, place(F.col("_b") - 1, 1)).otherwise(none), F.when(first, place(F.lit(len(bounds)), 1)).otherwise(none))
    rows = rows.withColumn("_p", F.explode(places)).select("*", F.col("_p.bucket").alias("_bucket"), F.col("_p.extra").alias("_extra")).drop("_p", "_b")
    return rows


def compared(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for every document.

    A document's edited text has its last half (rounded down, in code points) replaced by as many code points, or all,
    from the start of the next document by doc_id. Null texts are empty; null doc_ids come first; rows with equal
    doc_ids are ordered by text; a single document is its own next. Only doc_id and text are read.
    """
    text, half = F.col("text"), F.floor(F.length("text") / 2).cast("int")
    rows = placed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id")
    order = Window.partitionBy("_bucket").orderBy("_extra", F.col("doc_id").asc_nulls_first(), "text")
    rows = rows.select("_bucket", "_extra", "doc_id", "text", F.row_number().over(order).alias("_rank"), F.lead("text").over(order).alias("next_text"))
    edited = F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("_bucket", "_rank", "_extra", "doc_id", F.length(text).cast("long").alias("n_chars"), "text", F.when(F.col("_extra") == 0, edited).alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    told = vectors(rows, ["_bucket", "_rank", "_extra", "doc_id", "n_chars", "edited_sha256"], {"lanes": text, "edited_lanes": F.col("edited")})
    told = told.withColumn("next_lanes", F.lead("lanes").over(Window.partitionBy("_bucket").orderBy("_rank"))).where("_extra = 0")
    return told.select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("lanes")).alias("fingerprint"), printed(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"), likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"),
    )
