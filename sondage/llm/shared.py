"""What the operators of this subpackage share: the cluster's shared folder, written
intermediate tables, and vectorised views of Arrow text columns."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sondage.scratch import shared_dir, written  # noqa: F401

#: Bytes of text that one vectorised step handles; a longer single text is a step of its own.
STEP_BYTES = 2 << 20


def steps(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``most`` bytes of text (one row at least); rows are never cut."""
    for rb in batches:
        if not rb.num_rows:
            continue
        col = rb.column(rb.schema.get_field_index(text))
        ends = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, done = 0, 0
        while at < rb.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
            to = min(to, at + 4000, rb.num_rows)
            yield rb.slice(at, to - at)
            at, done = to, int(ends[to - 1])


def frugal(run: Callable) -> Callable:
    """``run`` as the function of a task that leaves little behind: a worker is used again, and what its last task freed or kept for
    its next step otherwise stays with it while later stages need the executor's memory."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def give_back() -> None:
    """Powers go, and free memory returns to the system."""
    POWERS.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def utf8(col: pa.Array, before: str = "", after: str = "") -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty. ``before`` and ``after`` go round every text."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if before or after:
        parts = [pa.scalar(before, pa.large_string()), col, pa.scalar(after, pa.large_string())]
        col = pc.binary_join_element_wise(*parts, pa.scalar("", pa.large_string()))
    _, offsets, data = col.buffers()
    ends = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def strings(data: np.ndarray, starts: np.ndarray) -> pa.StringArray:
    """The consecutive pieces of ``data`` that begin at ``starts`` (the first at 0) as an Arrow array."""
    offsets = np.append(starts, len(data)).astype(np.int32) if len(starts) else np.zeros(1, np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def coded(data: np.ndarray, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The distinct pieces of ``strings(data, starts)``, and each piece's place among them."""
    out = strings(data, starts).dictionary_encode()
    return out.dictionary.to_numpy(zero_copy_only=False).tolist(), out.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) of every element."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def before(mask: np.ndarray) -> np.ndarray:
    """How many are true before each place (one longer than ``mask``)."""
    out = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=out[1:])
    return out


#: Bytes of white space as the contracts name it: space and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and, for each text, the number of words before it
    (one entry more than texts). Texts are parted by their ends alone, so a word never spans two texts."""
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cut = ends[:-1][ends[:-1] < len(data)]
    first[cut] = solid[cut]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    close = ends[1:][ends[1:] > 0] - 1
    last[close] = solid[close]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, ends)


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, kept for the longest step so far."""

    base, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << int(n).bit_length()
            self.up, self.down = (self._powers(b, size) for b in (self.base, self.inverse))
        return self.up, self.down

    @staticmethod
    def _powers(b: int, size: int) -> np.ndarray:
        out, have = np.ones(size, np.uint64), 1
        while have < size:
            more = min(have, size - have)
            out[have : have + more] = out[:more] * np.uint64(pow(b, have, 1 << 64))
            have += more
        return out


POWERS = Powers()


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:stop]`` by prefix sums of a polynomial, equal for equal words anywhere."""
    up, down = POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts])


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The concatenation of ``flat[starts[c] : starts[c] + lengths[c]]`` for c in codes, and the places where each begins."""
    own = lengths[codes]
    at = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(own, out=at[1:])
    return flat[np.repeat(starts[codes] - at[:-1], own) + np.arange(at[-1])], at


def run_starts(x: np.ndarray) -> np.ndarray:
    """Where the runs of equal elements of a sorted array begin."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
