"""Shared helpers: Arrow string columns as byte blocks, rolling hashes, tables.

All per-task work of the operators runs on *blocks*: a few consecutive texts of
an Arrow batch, at most ``MAX_BLOCK`` bytes together (one longer text makes a
block of its own), seen as one ``uint8`` buffer with document offsets.  This
keeps the memory of a Python worker bounded whatever the batch size is.
"""

from __future__ import annotations

import contextlib
import ctypes
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

MAX_BLOCK = 1 << 19

#: Polynomials modulo two primes: modulo a power of two, regular texts (Thue-Morse words) collide under every base.
_PRIMES = (np.uint64((1 << 31) - 1), np.uint64((1 << 31) - 19))
_BASES = (1_103_515_245 % ((1 << 31) - 1), 1_597_334_677)
_tables: dict[tuple, np.ndarray] = {}


def _powers(which: int, inverse: bool, n: int) -> np.ndarray:
    """The first n powers of a base, or of its inverse, modulo its prime."""
    have = _tables.get((which, inverse))
    if have is None or len(have) < n:
        p = int(_PRIMES[which])
        base = pow(_BASES[which], -1, p) if inverse else _BASES[which]
        have = np.ones(1, dtype=np.uint64)
        while len(have) < max(n, 2 * MAX_BLOCK):
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), p)) % _PRIMES[which]])
        _tables[which, inverse] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element-wise on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(33)

#: The ASCII white space that separates words: [\x20\x09-\x0D].
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Block:
    """Consecutive texts as one UTF-8 buffer; ``starts`` has one entry more than texts."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, first: int):
        self.data, self.starts, self.first = data, starts, first
        self.n = len(starts) - 1
        self._prefix = None

    @property
    def rows(self) -> slice:
        """The rows of the batch that this block covers."""
        return slice(self.first, self.first + self.n)

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i + 1]].tobytes()

    def prefix(self) -> list[np.ndarray]:
        """Prefix sums of a polynomial over the bytes, one for each prime."""
        if self._prefix is None:
            n = len(self.data)
            values = _BYTES[self.data]
            self._prefix = []
            for i, p in enumerate(_PRIMES):
                sums = np.zeros(n + 1, dtype=np.uint64)  # below n * 2**31
                np.cumsum(values * _powers(i, False, n) % p, out=sums[1:])
                self._prefix.append(sums)
        return self._prefix

    def _ranges(self, begin, end, n: int) -> np.ndarray:
        found = []
        for i, (sums, p) in enumerate(zip(self.prefix(), _PRIMES, strict=True)):
            found.append((sums[end] - sums[begin]) % p * _powers(i, True, n)[begin] % p)
        return (found[0] << np.uint64(31)) | found[1]

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the byte ranges; equal ranges have equal hashes anywhere."""
        h = self._ranges(begin, end, len(self.data) + 1)
        return mix(h ^ mix((end - begin).astype(np.uint64)))

    def windows(self, k: int) -> np.ndarray:
        """The hash of the k bytes from each position; windows may cross texts."""
        n = len(self.data) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix(self._ranges(slice(0, n), slice(k, k + n), n))

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sums of a per-byte array over each text."""
        total = np.zeros(len(self.data) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.starts[1:]] - total[self.starts[:-1]]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and text index of each maximal run of non-space bytes."""
        n = len(self.data)
        if not n:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        ink = ~SPACE[self.data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.starts] = True
        begin = ink.copy()
        begin[1:] &= ~ink[:-1] | edge[1:n]
        end = ink.copy()
        end[:-1] &= ~ink[1:] | edge[1:n]
        b = np.flatnonzero(begin)
        return b, np.flatnonzero(end) + 1, self.owner(b)

    def owner(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string column with nulls as empty texts, in one piece."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def blocks(column: pa.Array | pa.ChunkedArray, most: int = MAX_BLOCK):
    """The texts of a string or binary column, block by block."""
    column = texts_of(column) if not pa.types.is_binary(column.type) else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + n + 1].astype(np.int64)
    buffer = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(at, at[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n, first + 65_535)
        yield Block(buffer[at[first] : at[last]], at[first : last + 1] - at[first], first)
        first = last
    release()


def release() -> None:
    """Give freed memory back to the system: workers of several stages live side by side."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where it is unset, as in tests on one machine, one in the warehouse
    folder is used instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    return base.rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cut lineage, survive lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def opened(docs: DataFrame, *wanted: str) -> tuple[DataFrame, list[str]]:
    """The frame with all columns but the wanted ones renamed, and the names that ``closed`` gives back.

    Columns are taken by their exact names, so that others which differ in case
    only, or have a name that an operator uses itself, pass through.
    """
    names = docs.columns
    safe = [c if c in wanted and names.index(c) == i else f"further {i}" for i, c in enumerate(names)]
    return docs.toDF(*safe), names


def closed(docs: DataFrame, names: list[str]) -> DataFrame:
    """The frame with the names that ``opened`` took away."""
    return docs.toDF(*names)


def numbered(docs: DataFrame) -> DataFrame:
    """The frame with columns named by their places, for tasks that take them so."""
    return docs.toDF(*(f"column {i}" for i in range(len(docs.columns))))


@contextlib.contextmanager
def rows_per_batch(spark: SparkSession, n: int):
    """What is run inside sends at most n rows at once to a Python worker: for rows that hold long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

