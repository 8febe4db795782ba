"""Token ids in binary shards, each a wavelet matrix: bit planes with rank directories.

A shard is one row of the Parquet output. Its codes are the ranks of its ids by frequency, so it has only as many
planes as its own vocabulary needs; ``alphabet`` maps codes back to ids. Plane k holds bit k (from the highest) of
every code after a stable partition by the bits above it. ``ranks`` counts the ones before each block of 512 bits.
Access, counting and occurrence lookup (``Shard``) read these planes and nothing else.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import SPACE, coded, gather, shared_dir, steps, utf8

#: Tokens after which a shard is closed; a single longer document makes a larger one.
SHARD_TOKENS = 1_500_000
BLOCK = 512
#: Bytes of text that are encoded at a time.
STEP = 4 << 20
#: Distinct pieces that one Python worker remembers; the memory is emptied when it is full.
REMEMBERED = 700_000
#: Letters below this code point are the same to all versions of Unicode.
PLAIN = "\u0250"
#: How a byte-level vocabulary shows bytes: printable ones as themselves, the others in order from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SHOWN = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}
LEAD = chr(SHOWN[0x20])
SHARD = (
    "part int, seq int, n_tokens long, doc_ids binary, null_ids binary, doc_ends binary, alphabet binary, "
    "zeros binary, planes array<binary>, ranks array<binary>"
)
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class ChunkIds:
    """Ids of texts under a byte-level BPE of the tokenizers library.

    A text is cut only before a space or line feed that stands alone between other characters; there the
    vocabulary's own splitting cuts too, so the ids of the pieces are those of the whole text. Each distinct piece
    is encoded once and remembered. A piece of plain letters, which that splitting leaves whole but for stops and commas
    at its end, goes to the library's merges directly; any other piece goes through the library's whole encoding.
    """

    def __init__(self, model: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(model)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}

    def _one(self, word: str) -> bytes:
        """Ids of one word of the vocabulary's own splitting, from its merges alone."""
        ids = self.known.get(word)
        if ids is None:
            if word.isascii():  # letters show as themselves, the space before them as one character
                shown = LEAD + word[1:] if word[0] == " " else word
            else:
                shown = word.encode().decode("latin-1").translate(SHOWN)
            ids = self.known[word] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return ids

    def learn(self, new: list[str]) -> None:
        """Adds pieces to the memory."""
        known, rest = self.known, []
        for w in new:
            word = w.rstrip(".,")
            letters = word[1:] if word[:1] == " " else word
            if letters.isalpha() and max(letters) < PLAIN:
                known[w] = self._one(word) + (self._one(w[len(word) :]) if len(word) < len(w) else b"")
            else:
                rest.append(w)
        for at in range(0, len(rest), 20_000):
            part = rest[at : at + 20_000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[w] = np.array(e.ids, np.uint32).tobytes()

    def of(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by text)."""
        cut = np.zeros(len(data) + 1, bool)
        if len(data):
            space = SPACE[data]
            single = (data == 0x20) | (data == 0x0A)
            cut[1 : len(data) - 1] = single[1:-1] & ~space[:-2] & ~space[2:]
        cut[ends] = True
        starts = np.flatnonzero(cut[:-1])
        distinct, codes = coded(data, starts)
        known = self.known
        new = [w for w in distinct if w not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = distinct
        self.learn(new)
        own = [known[w] for w in distinct]
        lengths = np.fromiter(map(len, own), np.int64, len(own)) // 4
        flat = np.frombuffer(b"".join(own), np.uint32)
        ids, at = gather(flat, np.cumsum(lengths) - lengths, lengths, codes)
        return ids, at[np.searchsorted(starts, ends)]


@lru_cache(maxsize=1)
def chunk_ids(model: str) -> ChunkIds:
    """The encoder of a Python worker, kept for its next tasks."""
    return ChunkIds(model)


def build(ids: np.ndarray) -> dict:
    """The wavelet matrix of an array of ids."""
    counts = np.bincount(ids) if len(ids) else np.zeros(1, np.int64)
    alphabet = np.argsort(-counts, kind="stable")[: int((counts > 0).sum())].astype(np.uint32)
    code = np.zeros(len(counts), np.uint32)
    code[alphabet] = np.arange(len(alphabet), dtype=np.uint32)
    levels = max(1, int(max(len(alphabet) - 1, 0)).bit_length())
    now = code[ids] if len(ids) else np.zeros(0, np.uint32)
    now = now.astype(np.uint16) if levels <= 16 else now
    planes, ranks, zeros = [], [], []
    for k in range(levels - 1, -1, -1):
        bit = (now & now.dtype.type(1 << k)) != 0
        low = np.compress(~bit, now)
        now = np.concatenate([low, np.compress(bit, now)])
        zeros.append(len(low))
        packed = np.packbits(bit, bitorder="little")
        planes.append(packed.tobytes())
        ranks.append(_ranks(packed).tobytes())
    return {"alphabet": alphabet.tobytes(), "zeros": np.array(zeros, np.int64).tobytes(), "planes": planes, "ranks": ranks}


def _ranks(packed: np.ndarray) -> np.ndarray:
    ones = np.cumsum(_POPCOUNT[packed], dtype=np.uint32)
    return np.concatenate([np.zeros(1, np.uint32), ones[BLOCK // 8 - 1 :: BLOCK // 8]])


class Shard:
    """Queries on one shard's row."""

    def __init__(self, row: dict) -> None:
        self.n = row["n_tokens"]
        self.alphabet = np.frombuffer(row["alphabet"], np.uint32)
        self.zeros = np.frombuffer(row["zeros"], np.int64)
        self.planes = [np.frombuffer(p, np.uint8) for p in row["planes"]]
        self.ranks = [np.frombuffer(r, np.uint32) for r in row["ranks"]]
        self.code = {int(t): c for c, t in enumerate(self.alphabet)}

    def _rank1(self, k: int, i: int) -> int:
        """Ones of plane k before place i."""
        block = i // BLOCK
        whole, left = divmod(i, 8)
        plane = self.planes[k]
        n = int(self.ranks[k][block]) + int(_POPCOUNT[plane[block * BLOCK // 8 : whole]].sum())
        return n + (int(_POPCOUNT[plane[whole] & ((1 << left) - 1)]) if left else 0)

    def _select(self, k: int, bit: int, nth: int) -> int:
        """The place of the nth (from 0) one or zero of plane k, by binary search over ranks."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self._rank1(k, mid + 1)
            if (ones if bit else mid + 1 - ones) <= nth:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def access(self, i: int) -> int:
        """The id at place i."""
        code = 0
        for k, zeros in enumerate(self.zeros):
            bit = int(self.planes[k][i // 8] >> (i % 8)) & 1
            ones = self._rank1(k, i)
            i = int(zeros) + ones if bit else i - ones
            code = code << 1 | bit
        return int(self.alphabet[code])

    def _range(self, code: int, lo: int, hi: int) -> tuple[int, int]:
        for k, zeros in enumerate(self.zeros):
            a, b = self._rank1(k, lo), self._rank1(k, hi)
            lo, hi = (int(zeros) + a, int(zeros) + b) if code >> (len(self.zeros) - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id at places lo to hi."""
        if token not in self.code:
            return 0
        hi = self.n if hi is None else hi
        a, b = self._range(self.code[token], min(lo, hi), hi)
        return b - a

    def find(self, token: int, nth: int) -> int:
        """The place of the nth (from 0) occurrence of an id, or -1."""
        if not 0 <= nth < self.count(token):
            return -1
        code = self.code[token]
        at = self._range(code, 0, 0)[0] + nth
        for k in range(len(self.zeros) - 1, -1, -1):
            bit = code >> (len(self.zeros) - 1 - k) & 1
            at = self._select(k, bit, at - int(self.zeros[k]) if bit else at)
        return at

    def ids(self) -> np.ndarray:
        """All ids in order, the partitions undone from the last plane to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for k in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            zeros = int(self.zeros[k])
            up = np.empty(self.n, kind)
            up[np.flatnonzero(~bit)] = now[:zeros]
            up[np.flatnonzero(bit)] = now[zeros:] | kind(1 << (len(self.planes) - 1 - k))
            now = up
        return self.alphabet[now]


def write_shards(docs: DataFrame, model: str, path: str, end: int = 0, parts: int | None = None) -> None:
    """Writes the ids of all texts (null: empty), each ended by ``end``, in ascending doc_id order to ``path``.

    One range partition by (doc_id, text) is one run of shards, ``part`` and ``seq`` order them; null ids come
    first. The sort key is unique but for repeated rows, so no key can gather many rows. A task holds one step of
    texts and one shard of ids.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, held, n, seq, part = chunk_ids(model), [], 0, 0, None

        def shard() -> pa.RecordBatch:
            ids = np.concatenate([h[1] for h in held])
            own = np.concatenate([h[2] for h in held])
            doc_ids = pa.concat_arrays([h[0] for h in held])
            row = build(ids) | {"part": part, "seq": seq, "n_tokens": len(ids), "doc_ends": np.cumsum(own).tobytes()}
            row |= {"doc_ids": doc_ids.fill_null(0).to_numpy().tobytes(), "null_ids": doc_ids.is_null().to_numpy(zero_copy_only=False).tobytes()}
            kinds = {"part": pa.int32(), "seq": pa.int32(), "n_tokens": pa.int64(), "planes": pa.list_(pa.binary()), "ranks": pa.list_(pa.binary())}
            names = [x.strip().split(" ")[0] for x in SHARD.split(",")]
            return pa.RecordBatch.from_pydict({k: pa.array([row[k]], kinds.get(k, pa.binary())) for k in names})

        for rb in steps(batches, most=STEP):
            part = rb.column("part")[0].as_py()
            ids, at = chunks.of(*utf8(rb.column("text")))
            with_end = np.insert(ids, at[1:], end)
            held.append((rb.column("doc_id").cast(pa.int64()), with_end, np.diff(at) + 1))
            n += len(with_end)
            if n >= SHARD_TOKENS:
                yield shard()
                held, n, seq = [], 0, seq + 1
        if held:
            yield shard()

    ordered = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    ordered.withColumn("part", F.spark_partition_id()).mapInArrow(run, SHARD).write.option("compression", "zstd").parquet(path)


def read_shards(spark, path: str) -> DataFrame:
    """The shards of ``path``, one row each."""
    return spark.read.schema(SHARD).parquet(path)


def documents_of(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the planes.

    ``start`` counts the ids of all documents before it: those of earlier parts (a total for each part, of which
    there are as many as range partitions), of earlier shards of its part, and of its own shard.
    """
    earlier = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    heads = shards.select("part", "seq", "n_tokens")
    parts = heads.groupBy("part").agg(F.sum("n_tokens").alias("of_part"))
    base = F.sum("of_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(base, F.lit(0)).alias("base"))
    starts = heads.withColumn("within", F.coalesce(earlier, F.lit(0))).join(parts, "part").select("part", "seq", (F.col("base") + F.col("within")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for i in range(rb.num_rows):
                row = {name: rb.column(name)[i].as_py() for name in rb.schema.names}
                ids = Shard(row).ids().astype("<u4")
                ends = np.frombuffer(row["doc_ends"], np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                crcs = [crc32(ids[a:b]) for a, b in zip(begins, ends, strict=True)]
                doc_ids = pa.array(np.frombuffer(row["doc_ids"], np.int64), mask=np.frombuffer(row["null_ids"], bool))
                k = len(ends)
                yield pa.RecordBatch.from_pydict({"part": pa.array([row["part"]] * k, pa.int32()), "seq": pa.array([row["seq"]] * k, pa.int32()), "doc_id": doc_ids, "begin": pa.array(begins), "n_tokens": pa.array(ends - begins), "ids_crc32": pa.array(crcs, pa.int64())})

    rows = shards.mapInArrow(run, "part int, seq int, doc_id long, begin long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["part", "seq"]).select("doc_id", (F.col("first") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def token_index(docs: DataFrame, model: str, end: int = 0) -> DataFrame:
    """Writes all documents as shards in the shared folder and lists them as read back (see ``documents_of``)."""
    import uuid

    path = f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_shards(docs, model, path, end)
    return documents_of(read_shards(docs.sparkSession, path))
