"""SentencePiece encoding and decoding by shared-prefix Viterbi.

Distinct marked words of a step are sorted, which makes them the leaves of a trie in depth-first order; walking
them, the forward scores of every prefix that a word shares with its predecessor are kept and only the rest is
computed. Documents are then put together from the words' pieces.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import coded, frugal, gather, steps, utf8

MARK = "▁"
#: Distinct words whose pieces one Python worker remembers; the memory is emptied when it is full.
REMEMBERED = 400_000
#: Characters of a word from which on its scores are kept as plain numbers.
LONG = 1 << 16
ID_BITS = 24
#: How far below the least piece score a character stands that no piece covers (SentencePiece's own figure).
UNKNOWN_PENALTY = 10.0


class Lexicon:
    """The pieces of a SentencePiece model as a unigram lexicon: best-scoring segmentation, byte fallback.

    The model file gives pieces and scores. Models of the unigram kind are segmented as SentencePiece does; of
    a model of another kind the pieces and scores are taken in the same way, so ids are those of SentencePiece's
    unigram search over that vocabulary, not of its merges.
    """

    def __init__(self, model: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        self.unknown = sp.unk_id()
        self.pieces: dict[str, tuple[float, int]] = {}
        self.byte_id: dict[int, int] = {}
        raw: list[bytes] = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b" \xe2\x81\x87 " if i == self.unknown else b"")
            else:
                self.pieces[piece.replace(MARK, " ")] = (sp.get_score(i), i)
                raw.append(piece.replace(MARK, " ").encode())
        self._index(raw)

    def _index(self, raw: list[bytes]) -> None:
        self.longest = max(map(len, self.pieces), default=1)
        self.unknown_score = min((s for s, _ in self.pieces.values()), default=0.0) - UNKNOWN_PENALTY
        # a text may be cut before a run of spaces, and round a line feed, only where no piece spans the cut
        self.cut_space = not any(" " in p.lstrip(" ") for p in self.pieces)
        self.cut_line = not any("\n" in p for p in self.pieces)
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_len = np.array([len(x) for x in raw], np.int64)
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len

    def segment(self, distinct: list[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) for distinct words, in sorted order; forward scores of shared prefixes are reused.

        Of equal scores the segmentation with the longer last piece wins at every prefix.
        """
        pieces, longest, unknown_score = self.pieces, self.longest, self.unknown_score
        best, back = [0.0], [0]  # by prefix length: score, where the last piece begins with its id + 1 in the low bits
        path = ""
        for word in sorted(distinct):
            text = word.replace(MARK, " ")
            if len(text) > LONG and isinstance(best, list):  # numbers without objects: 16 bytes a character
                best, back = array("d", best), array("q", back)
            same = 0
            for a, b in zip(path, text, strict=False):
                if a != b:
                    break
                same += 1
            del best[same + 1 :], back[same + 1 :]
            for end in range(same + 1, len(text) + 1):
                top, where = -1e300, -1
                for begin in range(max(0, end - longest), end):
                    got = pieces.get(text[begin:end])
                    if got is not None:
                        score = best[begin] + got[0]
                        if score > top:
                            top, where = score, begin << ID_BITS | got[1] + 1
                if where < 0 or text[end - 1] not in pieces and best[end - 1] + unknown_score > top:
                    top, where = best[end - 1] + unknown_score, end - 1 << ID_BITS
                best.append(top)
                back.append(where)
            path = text
            ids, end = [], len(text)
            while end:
                begin, i = back[end] >> ID_BITS, (back[end] & (1 << ID_BITS) - 1) - 1
                if i >= 0:
                    ids.append(i)
                else:
                    ids += [self.byte_id.get(b, self.unknown) for b in reversed(text[begin:end].encode())]
                end = begin
            yield word, ids[::-1]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of one document's ids, without the space that marks its first word."""
        flat, _ = gather(self.raw, self.raw_at, self.raw_len, ids)
        return flat[1:].tobytes() if len(flat) and flat[0] == 0x20 else flat.tobytes()


@lru_cache(maxsize=1)
def lexicon(model: str) -> tuple[Lexicon, dict[str, bytes]]:
    """The lexicon of a Python worker and the words it remembers, kept for its next tasks."""
    return Lexicon(model), {}


def _units(data: np.ndarray, ends: np.ndarray, lex: Lexicon) -> np.ndarray:
    """Where the marked words begin; they cover the data without gaps and never span two texts."""
    cut = np.zeros(len(data) + 1, bool)
    cut[ends[:-1]] = True
    if lex.cut_space:
        space = data == 0x20
        cut[1:-1] |= space[1:] & ~space[:-1]
    if lex.cut_line:
        line = np.flatnonzero(data == 0x0A)
        cut[line] = True
        cut[line + 1] = True
    return np.flatnonzero(cut[:-1])


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, exact, ids`` for every document: its ids and whether they decode to its text.

    ids_crc32 is the CRC-32 of the ids as little-endian 32-bit integers. Null and empty texts have no ids and are
    exact. A text is not exact only if it holds the mark U+2581 itself, which SentencePiece reads as a space.
    Repeated rows are encoded alike; other columns are left out, so their names can't clash. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, known = lexicon(model)
        for rb in steps(batches):
            col = rb.column("text")
            plain, plain_ends = utf8(col)
            data, ends = utf8(col, before=" ")  # the mark of the first word
            lengths = np.diff(plain_ends)
            starts = _units(data, ends, lex)
            distinct, codes = coded(data, starts)
            new = [w for w in distinct if w not in known]
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = distinct
            for word, ids in lex.segment(new):
                known[word] = np.array(ids, np.int32).tobytes()
            own = [known[w] for w in distinct]
            n_own = np.fromiter(map(len, own), np.int64, len(own)) // 4
            flat = np.frombuffer(b"".join(own), np.int32)
            ids, at = gather(flat, np.cumsum(n_own) - n_own, n_own, codes)
            # an empty text is the mark alone, which is left out
            at = at[np.searchsorted(starts, ends)]
            empty = lengths == 0
            if empty.any():
                keep = np.ones(len(ids), bool)
                for k in np.flatnonzero(empty):
                    keep[at[k] : at[k + 1]] = False
                n = np.where(empty, 0, np.diff(at))
                ids, at = ids[keep], np.concatenate([[0], np.cumsum(n)])
            back, back_at = gather(lex.raw, lex.raw_at, lex.raw_len, ids)
            back_at = back_at[at]
            exact = np.diff(back_at) - ~empty == lengths
            for k in np.flatnonzero(exact & ~empty):
                exact[k] = np.array_equal(back[back_at[k] + 1 : back_at[k + 1]], plain[plain_ends[k] : plain_ends[k + 1]])
            little = ids.astype("<u4")
            crcs = [crc32(little[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": rb.column("doc_id"), "n_tokens": pa.array(np.diff(at)), "ids_crc32": pa.array(crcs, pa.int64()), "exact": pa.array(exact), "ids": pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))}
            )

    return docs.select("doc_id", "text").mapInArrow(frugal(run), "doc_id long, n_tokens long, ids_crc32 long, exact boolean, ids array<int>")


def decoded(df: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``doc_id, text`` from ``doc_id`` and a column of ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, _ = lexicon(model)
        for rb in batches:
            texts = [None if x is None else lex.decode(np.array(x, np.int64)).decode("utf-8", "replace") for x in rb.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": rb.column(0), "text": pa.array(texts, pa.string())})

    return df.select("doc_id", ids).mapInArrow(frugal(run), "doc_id long, text string")
