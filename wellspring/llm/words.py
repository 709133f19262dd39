"""Words and hashes of many texts at once, on the bytes of an Arrow column.

A word is a run of bytes other than blank and the control characters 9 to 13.
Hashes are polynomials over the ring of 64-bit integers, so the hash of any
stretch comes from two prefix sums; two stretches with equal content have equal
hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts are handled in slices of about this many bytes, so that the working
#: arrays stay small; a longer text is a slice of its own.
SLICE_BYTES = 1 << 18

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = (self._table(b, size) for b in (self.base, self.inverse))
        return self.up, self.down

    @staticmethod
    def _table(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


_BYTE_POWERS = Powers(0x9E3779B97F4A7C15)
_WORD_POWERS = Powers(0xD6E8FEB86659FD93)
_BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


@dataclass
class Slice:
    """Some consecutive rows: bytes of their texts and where each text begins."""

    first: int  # row in the batch
    data: np.ndarray  # uint8, all texts joined
    offsets: np.ndarray  # int64, len(rows) + 1

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into slices; null texts count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks)
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), len(texts))
        own = offsets[at : end + 1]
        yield Slice(at, data[own[0] : own[-1]], own - own[0])
        at = end


@dataclass
class Words:
    """Words of a slice: byte ranges, their hashes and the rows they belong to."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # first word of each row, len(rows) + 1
    hashes: np.ndarray  # uint64

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(part: Slice, lower: bool = False) -> Words:
    data = LOWER_BYTES[part.data] if lower else part.data
    solid = ~_BLANK[data]
    begins, stops = solid.copy(), solid.copy()
    inner = part.offsets[(part.offsets > 0) & (part.offsets < len(data))]
    if len(data):
        begins[1:] &= ~solid[:-1]
        stops[:-1] &= ~solid[1:]
        begins[inner] = solid[inner]
        stops[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    up, down = _BYTE_POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[: len(data)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    return Words(starts, ends, np.searchsorted(starts, part.offsets), hashes)


def hashed_runs(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes (uint64) of the bytes from each start to the next one or the end."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = _BYTE_POWERS.get(len(data))
    return mixed(np.add.reduceat(_BYTE_CODES[data] * up[: len(data)], starts) * down[starts])


class Stretches:
    """Hashes of stretches of consecutive words."""

    def __init__(self, hashes: np.ndarray):
        self.up, self.down = _WORD_POWERS.get(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * self.up[: len(hashes)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * self.down[start])


def window_starts(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of so many words inside a row, and their rows."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    return np.arange(counts.sum()) + np.repeat(
        first[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts
    ), rows


def packed_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, body): texts compressed one by one, for shuffles that carry them. Null is empty."""
    kind = docs.schema[key].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            bodies = []
            for value in batch.column(1):
                raw = value.as_buffer() if value.is_valid else b""
                bodies.append(len(raw).to_bytes(8, "little") + codec.compress(raw, asbytes=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bodies, pa.binary())], names=["id", "body"]
            )

    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        packed, f"id {kind}, body binary"
    )


def unpacked(bodies: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of a column made by packed_texts, some bytes at a time."""
    codec = pa.Codec("zstd", 1)
    first, texts, size = 0, [], 0
    for k, value in enumerate(bodies):
        raw = value.as_buffer()
        n = int.from_bytes(raw[:8].to_pybytes(), "little")
        texts.append(codec.decompress(raw[8:], decompressed_size=n).to_pybytes() if n else b"")
        size += n
        if size >= SLICE_BYTES or len(texts) >= 4096:
            yield first, pa.array(texts, pa.large_binary()).cast(pa.large_string())
            first, texts, size = k + 1, [], 0
    if texts:
        yield first, pa.array(texts, pa.large_binary()).cast(pa.large_string())


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)
