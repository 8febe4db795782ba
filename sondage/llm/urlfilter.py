"""URL filters: host and path rules, then a list of canonical URLs behind a blocked Bloom filter. Built-ins only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Listed URLs for each block of 256 bits, and bits set for each: about one unlisted URL in a thousand passes.
PER_BLOCK = 16
BITS = 8
#: Blocks (40 bytes a row) up to which the filter is broadcast; a larger one meets the pages in a join by block.
BROADCAST_BLOCKS = 1 << 18
#: Query parameters that don't change a page: a prefix, and whole names.
TRACKING_PREFIX = "utm_"
TRACKING = ("ref", "fbclid", "gclid")


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` and default ports, path without trailing slashes, sorted query without tracking parameters;
    scheme and fragment go. Null or no ``://``: null."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.filter(
        F.split(query, "&"),
        lambda p: (F.length(p) > 0) & ~F.startswith(p, F.lit(TRACKING_PREFIX)) & ~F.substring_index(p, "=", 1).isin(*TRACKING),
    )
    tail = F.array_join(F.array_sort(kept), "&")
    whole = F.concat(host, path, F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(F.lit("")))
    return F.when(F.contains(url, F.lit("://")), whole)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, null without one; of equally long rules the first by text."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def _masks(key: Column) -> list[Column]:
    """The four 64-bit words of a key's bits inside its block."""
    bits = F.xxhash64(key, F.lit(1))
    places = [F.shiftrightunsigned(bits, 8 * j).bitwiseAND(255) for j in range(BITS)]
    one = F.lit(1).cast("long")
    return [
        reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.shiftright(p, 6) == w, F.call_function("shiftleft", one, p.bitwiseAND(63).cast("int"))).otherwise(F.lit(0).cast("long")) for p in places])
        for w in range(4)
    ]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(2)), F.lit(blocks)).cast("int")


def blocks_for(n: int) -> int:
    """Blocks of the filter of a list of ``n``: a power of two with at most ``PER_BLOCK`` of them in each on average."""
    return 1 << max(0, -(-n // PER_BLOCK) - 1).bit_length()


def bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The non-empty blocks of the filter of a list: ``block, w0 .. w3``; at most ``blocks`` rows."""
    each = listed.where(F.col(key).isNotNull()).select(_block(F.col(key), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))])
    return each.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def judged(pages: DataFrame, rules: list[Rule], listed: DataFrame, broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """``page_id, host, path, rule, verdict, maybe_listed, listed`` for every page.

    ``listed`` is a table of canonical URLs (column ``canonical``; repeats and nulls are harmless). A page without a
    rule is blocked if its canonical URL is listed, else allowed. Pages that the Bloom filter passes, and only those,
    meet the list in an exact hash join, which removes the false positives. The filter grows with the list; up to
    ``broadcast_blocks`` blocks it is broadcast, beyond that filter and pages are partitioned by block, with the same rows. Null
    urls have empty host and path and are never listed. Repeated rows are each judged. Only page_id and url are read, so
    other columns can't clash.
    """
    listed = written(listed.select(F.col("canonical").alias("_canon")).where("_canon is not null").distinct(), "listed")
    blocks = blocks_for(listed.count())
    filter_ = bloom(listed, "_canon", blocks)
    blocks_table = F.broadcast(filter_) if blocks <= broadcast_blocks else filter_.hint("merge")
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("_canon"))
    text, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", text).withColumn("_verdict", verdict).withColumn("block", _block(F.col("_canon"), blocks))
    probed = rows.join(blocks_table, "block", "left")
    hit = reduce(lambda a, b: a & b, [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col("_canon")))])
    probed = probed.withColumn("maybe_listed", F.coalesce(hit & F.col("_canon").isNotNull(), F.lit(False))).drop("block", "w0", "w1", "w2", "w3")
    sure = probed.where(~F.col("maybe_listed")).withColumn("listed", F.lit(False))
    possible = probed.where("maybe_listed").join(listed.withColumn("_found", F.lit(True)), "_canon", "left")
    possible = possible.withColumn("listed", F.coalesce("_found", F.lit(False))).drop("_found")
    out = sure.unionByName(possible)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("_verdict", own).alias("verdict"), "maybe_listed", "listed")
