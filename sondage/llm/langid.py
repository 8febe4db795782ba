"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays.

For each language, fourgram counts of a bounded sample of labelled documents give an interpolated Kneser-Ney model
over letters (lower case; each run of other characters is one space). The models are merged: for every n-gram that
any language has, one row holds its log probability under all of them, with their own backing off worked in, so most
characters need one lookup. A document gets the language of the lowest cross-entropy per character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import before, frugal, mix, run_starts, steps, utf8

ORDER = 4
UNDETERMINED = "und"
#: Characters a language at most gives to its model, and half as many to its rejection threshold (expected, as whole
#: documents are drawn). A model has at most as many n-grams of each order, which bounds what is collected and broadcast.
SAMPLE_CHARS = 3_000_000
#: The confidence uses at most so many characters' worth of evidence, as characters of one text are not independent.
EVIDENCE_CHARS = 50
#: Least standard deviations above the usual cross-entropy at which a text is rejected.
LEAST_Z = 6.0
#: Rejection begins at so many times the 90 % quantile of z, which for an exponential tail is 1.5 times the 99.9 % one.
TAIL = 4.5


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """For every code point its lower-case letter in 16 bits, or a space where it is no letter."""
    out = np.full(0x110000, 0x20, np.uint16)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = ord(c.lower()[0])
            out[cp] = low if low < 0x10000 else 0xF000 | (low & 0x0FFF)
    return out


def _letters(rb: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed fourgram for every kept character, offsets by text, number of letters by text)."""
    data, ends = utf8(rb.column("text"), after="\n")
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    text_ends = before(data & 0xC0 != 0x80)[ends]
    x = _folded()[points]
    gap = x == 0x20
    # every text begins after a space, the first of a step like the others, which follow a line feed
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    kept = before(keep)[text_ends]
    letters = before(~gap)[text_ends]
    x = x[keep].astype(np.uint64)
    # the line feed that ends every text is a space, so a text starts after one and never looks beyond it
    key = x.copy()
    for j in range(1, ORDER):
        part = np.full(len(x), 0x20, np.uint64)
        part[j:] = x[:-j]
        begin = kept[:-1]
        for k in range(j):
            at = begin + k
            part[at[at < np.append(kept[1:], 0)[: len(at)]]] = 0x20
        key |= part << np.uint64(16 * j)
    return key, kept, np.diff(letters)


def _sums(rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the rows of every text; a text that keeps no character has 0, wherever in a step it stands."""
    out = np.zeros((len(ends) - 1, *rows.shape[1:]))
    some = np.flatnonzero(np.diff(ends))
    if len(some):
        out[some] = np.add.reduceat(rows, ends[some], axis=0, dtype=np.float64)
    return out


class HashArray:
    """Sorted hashes of n-grams with a directory over their leading bits; ``find`` gives places or -1."""

    def __init__(self, keys: np.ndarray) -> None:
        h = mix(keys)
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        self.bits = max(1, int(2 * len(keys)).bit_length())
        self.first = np.searchsorted(self.hashes, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)).astype(np.int32)
        self.hashes = np.append(self.hashes, np.zeros(1, np.uint64))

    def find(self, keys: np.ndarray) -> np.ndarray:
        h = mix(keys)
        at = self.first.take((h >> np.uint64(64 - self.bits)).astype(np.int64))
        got = self.hashes.take(at)
        out = np.where(got == h, at, -1)
        left = np.flatnonzero((got < h) & (at < len(self.hashes) - 1))
        while len(left):
            at[left] += 1
            got = self.hashes.take(at[left])
            out[left[got == h[left]]] = at[left[got == h[left]]]
            left = left[(got < h[left]) & (at[left] < len(self.hashes) - 1)]
        return out


@dataclass
class Model:
    """Merged models: for each order the n-grams' rows of log probabilities, and the contexts' rows of log back-off weights."""

    langs: list[str]
    grams: list[HashArray] = field(default_factory=list)
    logp: list[np.ndarray] = field(default_factory=list)
    contexts: list[HashArray] = field(default_factory=list)
    backoff: list[np.ndarray] = field(default_factory=list)
    unseen: np.ndarray | None = None
    mean: np.ndarray | None = None
    between: np.ndarray | None = None
    within: np.ndarray | None = None
    limit: np.ndarray | None = None

    def rows(self, keys: np.ndarray, n: int = ORDER) -> np.ndarray:
        """Log probabilities (one column a language) of the last characters of n-grams."""
        if n == 0:
            return np.broadcast_to(self.unseen, (len(keys), len(self.langs)))
        at = self.grams[n - 1].find(keys)
        out = self.logp[n - 1].take(np.maximum(at, 0), axis=0)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            lower = self.rows(keys[miss] & np.uint64((1 << 16 * (n - 1)) - 1), n - 1)
            if n > 1:
                c = self.contexts[n - 1].find(keys[miss] >> np.uint64(16))
                lower = lower + np.where((c >= 0)[:, None], self.backoff[n - 1].take(np.maximum(c, 0), axis=0), 0)
            out[miss] = lower
        return out

    def totals(self, key: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Summed log probabilities of texts, one column a language."""
        return _sums(self.rows(key), ends)

    def z(self, entropy: np.ndarray, n: np.ndarray, best: np.ndarray) -> np.ndarray:
        return (entropy - self.mean[best]) / np.sqrt(self.between[best] ** 2 + self.within[best] ** 2 / np.maximum(n, 1))


def _levels(keys: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(n-grams, counts) of orders 1 to ORDER; below the highest, counts are of distinct left extensions."""
    out = [(keys, counts.astype(np.float64))]
    for n in range(ORDER - 1, 0, -1):
        suffix = np.sort(out[0][0] & np.uint64((1 << 16 * n) - 1))
        runs = run_starts(suffix)
        out.insert(0, (suffix[runs], np.diff(np.append(runs, len(suffix))).astype(np.float64)))
    return out


def _at(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted table, -1 where absent."""
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return np.where(table[at] == keys, at, -1) if len(table) else np.full(len(keys), -1)


def fit(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The merged model of languages' fourgram counts (sorted packed fourgrams, counts)."""
    langs = sorted(counts)
    model = Model(langs)
    levels = {x: _levels(*counts[x]) for x in langs}
    lower, lower_keys = None, None
    for n in range(1, ORDER + 1):
        union = np.unique(np.concatenate([levels[x][n - 1][0] for x in langs]))
        contexts = np.unique(np.concatenate([levels[x][n - 1][0] >> np.uint64(16) for x in langs])) if n > 1 else np.zeros(1, np.uint64)
        logp = np.zeros((len(union), len(langs)))
        backoff = np.zeros((len(contexts), len(langs)))
        unseen = np.zeros(len(langs))
        for j, x in enumerate(langs):
            keys, c = levels[x][n - 1]
            once, two = (c == 1).sum(), (c == 2).sum()
            discount = min(0.95, max(0.1, once / (once + 2 * two))) if once else 0.5
            ctx = keys >> np.uint64(16) if n > 1 else np.zeros(len(keys), np.uint64)
            runs = run_starts(ctx)
            total = np.add.reduceat(c, runs)
            distinct = np.diff(np.append(runs, len(ctx)))
            weight = discount * distinct / total
            backoff[_at(contexts, ctx[runs]), j] = np.log(weight)
            base = np.exp(lower[_at(lower_keys, union & np.uint64((1 << 16 * (n - 1)) - 1)), j]) if n > 1 else np.full(len(union), 1 / (len(keys) + 1))
            where = _at(ctx[runs], union >> np.uint64(16) if n > 1 else np.zeros(len(union), np.uint64))
            p = np.where(where >= 0, weight[np.maximum(where, 0)], 1.0) * base
            seen = _at(keys, union)
            own = np.flatnonzero(seen >= 0)
            p[own] += (c[seen[own]] - discount) / total[where[own]]
            logp[:, j] = np.log(p)
            if n == 1:
                unseen[j] = np.log(weight[0] / (len(keys) + 1))
        if n == 1:
            model.unseen = unseen
        lower, lower_keys = logp, union
        grams, ctxs = HashArray(union), HashArray(contexts)
        model.grams.append(grams)
        model.logp.append(logp[grams.order].astype(np.float32))
        model.contexts.append(ctxs)
        model.backoff.append(backoff[ctxs.order].astype(np.float32))
    return model


def _fold(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4


def _coin() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / (1 << 30)


def _shares(learn: DataFrame) -> dict[tuple[str, bool], tuple[int, float]]:
    """(characters, least coin of a document) by language and whether the fold sets rejection, of documents with a letter."""
    some = learn.where(F.col("text").rlike(r"\p{L}")).groupBy("lang", (_fold(F.col("doc_id")) == 3).alias("sets"))
    rows = some.agg(F.sum(F.length("text")).alias("chars"), F.min(_coin()).alias("least")).collect()  # two rows a language, as the model has
    return {(r["lang"], r["sets"]): (r["chars"], r["least"]) for r in rows}


def _sampled(learn: DataFrame, shares: dict[str, tuple[int, float]], most: int) -> DataFrame:
    """Whole documents of each language, with probability ``most`` over the language's characters, by a hash of their
    ids; the one of the least hash at least, so that no language is lost."""
    share = F.lit(-1.0)
    for lang, (chars, least) in shares.items():
        share = F.when(F.col("lang") == lang, F.lit(max(min(1.0, most / max(chars, 1)), least))).otherwise(share)
    return learn.where(_coin() <= share).select("doc_id", "lang", "text")


def _counts(sample: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in steps(batches):
            key, ends, _ = _letters(rb)
            langs = rb.column("lang").dictionary_encode()
            code = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(ends))
            for c, x in enumerate(langs.dictionary.to_pylist()):
                own = np.sort(key[code == c])
                runs = run_starts(own)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([x] * len(runs), pa.string()), "gram": pa.array(own[runs].view(np.int64)), "n": pa.array(np.diff(np.append(runs, len(own))))})

    rows = sample.mapInArrow(frugal(run), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    out = {}
    for x, own in rows.groupby("lang"):
        keys, n = own["gram"].to_numpy().view(np.uint64), own["n"].to_numpy()
        order = np.argsort(keys)
        out[x] = (keys[order], n[order])
    return out


def _calibrate(model: Model, sample: DataFrame) -> None:
    """Sets the usual cross-entropy of each language, its spread, and where rejection begins, from documents that the
    model has not seen and whose best language is their label: ``TAIL`` times the 90 % quantile of their standardised
    cross-entropies, ``LEAST_Z`` at least. Up to a tenth of junk among them can't carry the limit beyond itself."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for rb in steps(batches):
            key, ends, letters = _letters(rb)
            rows = model.rows(key) if len(key) else np.zeros((0, len(model.langs)))
            lang = np.array([model.langs.index(x) if x in model.langs else -1 for x in rb.column("lang").to_pylist()])
            n = np.diff(ends)
            own = rows[np.arange(len(rows)), np.repeat(lang, n)].astype(np.float64)
            total, square = _sums(own, ends), _sums(own**2, ends)
            some = (letters > 0) & (lang >= 0) & (lang == _sums(rows, ends).argmax(axis=1))
            yield pa.RecordBatch.from_pydict({"lang": pa.array(lang[some], pa.int32()), "n": pa.array(n[some]), "total": pa.array(total[some]), "square": pa.array(square[some])})

    rows = sample.mapInArrow(frugal(run), "lang int, n long, total double, square double").toPandas()
    k = len(model.langs)
    model.mean, model.between, model.within, model.limit = np.full(k, 3.0), np.full(k, 0.5), np.full(k, 2.0), np.full(k, LEAST_Z)
    for j in range(k):
        own = rows[rows["lang"] == j]
        if len(own) < 20:
            continue
        entropy, n = -(own["total"] / own["n"]).to_numpy(), own["n"].to_numpy()
        model.mean[j] = np.median(entropy)
        usual = (entropy <= np.quantile(entropy, 0.9)).nonzero()[0]
        total, square = own["total"].to_numpy()[usual].sum(), own["square"].to_numpy()[usual].sum()
        model.within[j] = np.sqrt(max(square / n[usual].sum() - (total / n[usual].sum()) ** 2, 0.01))
        model.between[j] = max(0.05, 1.4826 * np.median(np.abs(entropy - model.mean[j])))
        z = model.z(entropy, n, np.full(len(n), j))
        model.limit[j] = max(LEAST_Z, TAIL * np.quantile(z, 0.9))


def train(docs: DataFrame) -> Model | None:
    """A model from the text and lang of labelled documents outside the held-out fold; None without any.

    Folds are crc32(doc_id as text) mod 4: 2 is held out, 3 sets rejection, 0 and 1 train; a language that has rows in fold 3 only trains on these. Rows whose doc_id, lang
    or text is null, and texts without letters, teach nothing.
    """
    learn = docs.select("doc_id", "lang", "text").where("lang is not null and text is not null and doc_id is not null").where(_fold(F.col("doc_id")) != 2)
    shares = _shares(learn)
    if not shares:
        return None
    sets = _fold(F.col("doc_id")) == 3
    trains = {x: v for (x, third), v in shares.items() if not third}
    rejects = {x: v for (x, third), v in shares.items() if third}
    sample = _sampled(learn.where(~sets), trains, SAMPLE_CHARS)
    if rest := {x: v for x, v in rejects.items() if x not in trains}:
        sample = sample.unionByName(_sampled(learn.where(sets), rest, SAMPLE_CHARS))
    counts = _counts(sample)
    if not counts:
        return None
    model = fit(counts)
    _calibrate(model, _sampled(learn.where(sets), rejects, SAMPLE_CHARS // 2))
    return model


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, cross_entropy, rejected`` for every document, from its whole text alone.

    A null text or one without letters is ``und`` with score 0 and is not rejected. ``rejected`` texts are further
    from their best language than calibration allows; they keep the prediction. A null doc_id is not held out.
    Equal cross-entropies go to the language first in order. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for rb in steps(batches):
            key, ends, letters = _letters(rb)
            n = np.diff(ends)
            some = (letters > 0) & (model is not None)
            lang, score, entropy, rejected = np.full(len(n), UNDETERMINED, object), np.zeros(len(n)), np.full(len(n), np.nan), np.zeros(len(n), bool)
            if some.any():
                mean = model.totals(key, ends) / np.maximum(n, 1)[:, None]
                best = mean.argmax(axis=1)
                gap = (mean - mean.max(axis=1)[:, None]) * np.minimum(n, EVIDENCE_CHARS)[:, None]
                ce = -mean.max(axis=1)
                lang = np.where(some, np.array(model.langs, object)[best], lang)
                score, entropy = np.where(some, 1 / np.exp(gap).sum(axis=1), 0.0), np.where(some, ce, np.nan)
                rejected = some & (model.z(ce, n, best) > model.limit[best])
            yield pa.RecordBatch.from_pydict(
                {"doc_id": rb.column("doc_id"), "lang_pred": pa.array(lang.tolist(), pa.string()), "score": pa.array(score), "cross_entropy": pa.array(entropy, mask=np.isnan(entropy)), "rejected": pa.array(rejected)}
            )

    rows = docs.select("doc_id", "text").mapInArrow(frugal(run), "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")
    return rows.select("doc_id", F.coalesce(_fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` without the texts that are rejected or undetermined (null, no letters); a null lang gets the prediction.

    All columns pass through, under their own names; no shuffle. Without a model nothing is rejected.
    """
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for rb in steps(batches):
            key, ends, letters = _letters(rb)
            n = np.diff(ends)
            mean = model.totals(key, ends) / np.maximum(n, 1)[:, None]
            best = mean.argmax(axis=1)
            keep = pa.array((letters > 0) & (model.z(-mean.max(axis=1), n, best) <= model.limit[best]))
            at = rb.schema.get_field_index("lang")
            if at >= 0:
                rb = rb.set_column(at, rb.schema.field(at), pc.coalesce(rb.column(at), pa.array([model.langs[b] for b in best], pa.string()).cast(rb.schema.field(at).type)))
            yield rb.filter(keep)

    return docs.mapInArrow(frugal(run), schema)
