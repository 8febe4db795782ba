"""Quality rules by tokeniser fertility: public vocabularies measure every text, and bands per language
or script, taken from the whole corpus, part odd texts from ordinary ones."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.operators.quantiles import joined, key_of, quantiles

from .shared import SPACE, before, coded, gather, mix, run_starts, steps, strings, utf8, words, written
from .wavelet import LEAD, SHOWN, ChunkIds

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Texts with fewer words are judged by the base rules alone.
LEAST_WORDS = 20
#: Robust standard deviations from a group's median at which a band ends, and the least that counts as one.
SPREAD = 6.0
LEAST_SD = {"chars_per_token": 0.06, "byte_share": 0.02, "entropy_gap": 0.25}
#: Groups with fewer judged texts than this take the band of the whole corpus.
LEAST_GROUP = 50
#: Distinct words that one Python worker remembers; the memory is emptied when it is full.
REMEMBERED = 400_000

MEASURES = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, script string"
#: What each vocabulary measures; columns of the second and further ones end in ``_2`` and so on.
PER_VOCABULARY = "n_tokens{0} long, chars_per_token{0} double, byte_share{0} double, token_entropy{0} double"
SCRIPTS = ("none", "latin", "cyrillic", "greek", "arabic", "hebrew", "han", "kana", "other")


class WordTokens:
    """Ids of distinct words under a public vocabulary, remembered up to a bound.

    A ``.model`` file is a SentencePiece model; its byte pieces and unknowns count as bytes. A ``.json`` file is a byte-level
    vocabulary, which sees a word after a space; ids that stand for one byte of a longer character count as bytes.
    """

    def __init__(self, model: str) -> None:
        self.known: dict[str, bytes] = {}
        if model.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=model)
            self.is_byte = np.array([sp.is_byte(i) or sp.is_unknown(i) for i in range(sp.get_piece_size())])
            self.encode = lambda part: sp.encode(part, num_threads=1)
        else:
            chunks = ChunkIds(model)
            bpe = chunks.tokenizer
            shown = {chr(SHOWN.get(b, b)) for b in range(0x80, 0x100)}
            self.is_byte = np.zeros(bpe.get_vocab_size(), bool)
            self.is_byte[[i for piece, i in bpe.get_vocab().items() if piece.removeprefix(LEAD) in shown]] = True

            def encode(part: list[str]) -> list[np.ndarray]:
                marked = [" " + w for w in part]
                chunks.known.clear()
                chunks.learn(marked)
                return [np.frombuffer(chunks.known[w], np.uint32) for w in marked]

            self.encode = encode

    def of(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known = self.known
        new = [w for w in distinct if w not in known]
        if new:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = distinct
            for at in range(0, len(new), 20_000):
                part = new[at : at + 20_000]
                for w, ids in zip(part, self.encode(part), strict=True):
                    known[w] = np.array(ids, np.uint32).tobytes()
        own = [known[w] for w in distinct]
        lengths = np.fromiter(map(len, own), np.int64, len(own)) // 4
        return np.frombuffer(b"".join(own), np.uint32), np.cumsum(lengths) - lengths, lengths


@lru_cache(maxsize=4)
def word_tokens(model: str) -> WordTokens:
    """The vocabulary of a Python worker, kept for its next tasks."""
    return WordTokens(model)


def _script(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The script of most letters of each text, by the lead bytes of UTF-8 sequences; ties go to the earlier name."""
    kind = np.zeros(256, np.int8)
    kind[0x41:0x5B] = kind[0x61:0x7B] = kind[0xC3:0xCA] = 1
    kind[0xD0:0xD4] = 2
    kind[0xCE:0xD0] = 3
    kind[0xD8:0xDC] = 4
    kind[0xD6:0xD8] = 5
    kind[0xE4:0xEA] = 6
    kind[0xE3] = 7
    kind[[0xD4, 0xD5, 0xE0, 0xE1, *range(0xEA, 0xF5)]] = 8
    each = kind[data]
    best, most = np.zeros(len(ends) - 1, np.int64), np.zeros(len(ends) - 1, np.int64)
    for k in range(1, len(SCRIPTS)):
        hit = each == k
        if hit.any():
            n = before(hit)
            n = n[ends[1:]] - n[ends[:-1]]
            best, most = np.where(n > most, k, best), np.maximum(n, most)
    return best


def _repeat_words(codes: np.ndarray, at: np.ndarray, width: int = 8) -> np.ndarray:
    """For each text, its words inside windows of ``width`` words that occur twice or more in it."""
    out = np.zeros(len(at) - 1, np.int64)
    n = len(codes)
    if n < width:
        return out
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    g = mix(codes)
    h = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        h = h * np.uint64(0xD1342543DE82EF95) + g[j : n - width + 1 + j]
    inside = doc[: n - width + 1] == doc[width - 1 :]
    place = np.flatnonzero(inside)
    # 12 bits for the text's place in the step (at most 4000 texts), 52 for the window
    keys = (doc[place].astype(np.uint64) << np.uint64(52)) | (mix(h[place]) >> np.uint64(12))
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return out
    hit = np.zeros(len(at) - 1, bool)
    hit[(twice >> np.uint64(52)).astype(np.int64)] = True
    some = hit[doc[place]]
    place, keys = place[some], keys[some]
    twice = twice[run_starts(twice)]
    found = twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, place[found], 1)
    np.add.at(edge, place[found] + width, -1)
    covered = before(np.cumsum(edge[:-1]) > 0)
    return covered[at[1:]] - covered[at[:-1]]


def _dup_lines(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each text (each ends in a line feed here), lines with a word that equal an earlier line."""
    stops = np.flatnonzero(data == 0x0A) + 1
    starts = np.concatenate([[0], stops[:-1]]) if len(stops) else np.zeros(0, np.int64)
    solid = before(~SPACE[data])
    has = solid[stops] > solid[starts]
    doc = np.searchsorted(ends, starts, side="right") - 1
    codes = strings(data, starts).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    keys = np.sort((doc[has].astype(np.uint64) << np.uint64(32)) | codes[has].astype(np.uint64))
    again = keys[1:][keys[1:] == keys[:-1]]
    return np.bincount((again >> np.uint64(32)).astype(np.int64), minlength=len(ends) - 1)


def _told(codes: np.ndarray, at: np.ndarray, distinct: list[str], vocabulary: WordTokens, word_chars: np.ndarray) -> dict[str, np.ndarray]:
    """What one vocabulary makes of a step's texts."""
    n = len(at) - 1
    flat, first, lengths = vocabulary.of(distinct)
    tokens, token_at = gather(flat, first, lengths, codes)
    token_at = token_at[at]
    n_tokens = np.diff(token_at)
    bytes_before = before(vocabulary.is_byte[tokens])
    n_bytes = bytes_before[token_at[1:]] - bytes_before[token_at[:-1]]
    doc = np.repeat(np.arange(n, dtype=np.uint64), n_tokens)
    keys = np.sort((doc << np.uint64(32)) | tokens.astype(np.uint64))
    runs = run_starts(keys)
    counts = np.diff(np.append(runs, len(keys)))
    plogp = np.bincount((keys[runs] >> np.uint64(32)).astype(np.int64), weights=counts * np.log2(counts), minlength=n)
    some = np.maximum(n_tokens, 1)
    return {"n_tokens": n_tokens, "chars_per_token": word_chars / some, "byte_share": n_bytes / some, "token_entropy": np.maximum(np.log2(some) - plogp / some, 0.0)}


def _suffix(k: int) -> str:
    return f"_{k + 1}" if k else ""


def _measured(rb: pa.RecordBatch, vocabularies: list[WordTokens]) -> pa.RecordBatch:
    data, ends = utf8(rb.column("text"), after="\n")
    starts, stops, at = words(data, ends)
    n_words = np.diff(at)
    n = len(ends) - 1
    lead = before((data & 0xC0 != 0x80) & ~SPACE[data])
    word_chars = lead[ends[1:]] - lead[ends[:-1]]
    table = np.zeros(256, bool)
    table[list(SYMBOLS.encode())] = True
    marks = before(table[data])
    n_symbols = marks[ends[1:]] - marks[ends[:-1]]

    packed = data[~SPACE[data]]
    distinct, codes = coded(packed, np.cumsum(stops - starts) - (stops - starts))
    columns = {
        "doc_id": rb.column("doc_id"), "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": _dup_lines(data, ends), "n_repeat_words": _repeat_words(codes, at),
        "script": pa.array([SCRIPTS[k] for k in _script(data, ends)]),
    }
    for k, vocabulary in enumerate(vocabularies):
        columns |= {f"{c}{_suffix(k)}": v for c, v in _told(codes, at, distinct, vocabulary, word_chars).items()}
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def measures(docs: DataFrame, *models: str) -> DataFrame:
    """One row of measures for every document: words, symbols, repeats, and what each vocabulary makes of its words.

    Null texts count as empty. The work is a scan without a shuffle; memory is bounded by ``STEP_BYTES`` or the
    longest text. Of the input's columns only doc_id, lang and text are read, so others can't clash; without a column
    lang it counts as null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = [word_tokens(m) for m in models]
        for rb in steps(batches):
            out = _measured(rb, vocabularies)
            yield pa.RecordBatch.from_arrays([*out.columns, rb.column("lang")], names=[*out.schema.names, "lang"])

    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    return docs.select("doc_id", "text", lang.cast("string").alias("lang")).mapInArrow(run, ", ".join([MEASURES, *[PER_VOCABULARY.format(_suffix(k)) for k in range(len(models))], "lang string"]))


def judged(docs: DataFrame, *models: str) -> DataFrame:
    """Every document with its measures under each vocabulary, and the verdict ``kept``.

    A group is the language, or the script where the language is null. A band is the median of the group's
    texts that pass the base rules, plus and minus ``SPREAD`` robust standard deviations (the quartiles' distance over
    1.349, never less than ``LEAST_SD``), over all documents, exact and so the same in every run; entropy is held against the
    logarithm of the number of tokens, as short texts have less of it. Groups of fewer than ``LEAST_GROUP`` texts take the
    corpus's band, and a corpus without such texts rejects by the base rules alone. Texts outside a band of any vocabulary are
    rejected; so are those that fail the base rules (fewer than 20 words; over 30 % of words in repeated windows).
    """
    table = written(measures(docs, *models), "fertility")
    table = table.withColumn("grp", F.coalesce("lang", "script")).withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    for k in range(len(models)):
        x = _suffix(k)
        table = table.withColumn(f"entropy_gap{x}", F.log2(F.greatest(F.col(f"n_tokens{x}"), F.lit(1))) - F.col(f"token_entropy{x}"))
    banded = [(f"{c}{_suffix(k)}", c) for k in range(len(models)) for c in LEAST_SD]
    base = table.where(~F.col("base_failed"))
    quartiles, qs = {f"{c}_q{i}": F.col(c) for c, _ in banded for i in (1, 2, 3)}, [0.25, 0.5, 0.75] * len(banded)
    enough = base.groupBy(key_of(["grp"]).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= LEAST_GROUP)
    own = written(quantiles(base, ["grp"], quartiles, qs, settled=True).join(enough, "_k"), "bands")  # a small file, which joins without a shuffle of the texts' rows
    whole = quantiles(base, [], quartiles, qs, settled=True).select(*[F.col(q).alias(f"all_{q}") for q in quartiles])
    out = joined(table, ["grp"], own).join(F.broadcast(whole), F.lit(True), "left")  # one row
    odd = F.lit(False)
    for c, kind in banded:
        low_q, mid, high_q = (F.coalesce(F.when(F.col("_n").isNotNull(), F.col(f"{c}_q{i}")), F.col(f"all_{c}_q{i}")) for i in (1, 2, 3))
        half = SPREAD * F.greatest((high_q - low_q) / 1.349, F.lit(LEAST_SD[kind]))
        high, low = F.coalesce(F.col(c) > mid + half, F.lit(False)), F.coalesce(F.col(c) < mid - half, F.lit(False))
        # more bytes or less variety than usual is odd, fewer bytes and more variety are not
        odd = odd | (high | low if kind == "chars_per_token" else high)
    kept = out.withColumn("odd", odd).withColumn("kept", ~F.col("base_failed") & ~F.col("odd"))
    return kept.drop("_n", *quartiles, *[f"all_{q}" for q in quartiles])
