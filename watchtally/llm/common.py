"""Helpers shared by the operators of this subpackage.

The text helpers work on a whole batch of texts at once with numpy: the texts
are laid end to end, words are found from a byte table, and every word, shingle
or line gets a 64-bit hash from prefix sums of a random polynomial. Nothing is
looped per word in Python.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
#: Texts are handled in groups of about so many bytes, to bound memory.
GROUP_BYTES = 1 << 20
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_ROWS = 2000

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_R = int(_rng.integers(1, 1 << 63, dtype=np.uint64)) * 2 + 1
_R_INV = pow(_R, -1, 1 << 64)
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)

#: ASCII white space: \x20 and \x09 to \x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Every ASCII character but letters and digits.
PUNCT = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a private one in local runs only."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-ckpt-"))
        root = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint in the shared folder."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back (compressed, unlike a checkpoint)."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class _Powers:
    """Powers of the polynomial's base and of its inverse, grown when needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, 2 * len(cls.up), 2 * GROUP_BYTES)
            for name, base in (("up", _R), ("down", _R_INV)):
                x = np.full(n, U64(base))
                x[0] = 1
                setattr(cls, name, np.multiply.accumulate(x))
        return cls.up, cls.down


class Pieces:
    """Byte ranges hashed over one buffer: hash(start, end) is position-free."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        up, self.down = _Powers.get(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[buf] * up[:n], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(h + (end - start).astype(np.uint64) * _STEP[63])


class Words:
    """Words of a group of texts: start, end (byte positions in ``buf``), doc, hash.

    ``first[d]`` is the index of text d's first word, ``first[d + 1]`` one past its last.
    """

    def __init__(self, texts: list[bytes], sep: np.ndarray = SPACE, lower: bool = False):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offset = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes + 1, out=self.offset[1:])
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.buf = LOWER[raw] if lower else raw
        word = ~sep[self.buf]
        word[self.offset[1:] - 1] = False
        edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
        self.start, self.end = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.offset)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.pieces = Pieces(self.buf)
        self.hash = self.pieces.hash(self.start, self.end)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every k-word window inside one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.zeros(n, np.uint64)
        for i in range(k):
            h += self.hash[i : i + n] * _STEP[i]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return at, mix(h[at] + U64(k))

    def shingles(self, k: int) -> Iterator[np.ndarray]:
        """For each text its sorted distinct k-word shingles; a text with fewer words has its whole sequence."""
        at, h = self.windows(k)
        cut_at = np.searchsorted(at, self.first)
        for d in range(len(self.first) - 1):
            a, b = self.first[d], self.first[d + 1]
            if b - a >= k:
                yield np.unique(h[cut_at[d] : cut_at[d + 1]])
            elif b > a:
                s = (self.hash[a:b] * _STEP[: b - a]).sum(dtype=np.uint64)
                yield mix(np.array([s + U64(b - a)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as UTF-8 bytes; null is the empty text."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def groups(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = GROUP_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches that hold about ``most`` text bytes each (a longer text stands alone)."""
    for batch in batches:
        texts = text_bytes(batch.column(text))
        a = size = 0
        for i, t in enumerate(texts):
            if i > a and size + len(t) > most:
                yield batch.slice(a, i - a), texts[a:i]
                a, size = i, 0
            size += len(t)
        if a < len(texts):
            yield batch.slice(a), texts[a:]


def give_back() -> None:
    """Return freed memory to the system at a task's end; workers are used again for other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every system's C library has it
        pass


def map_arrow(df: DataFrame, f, schema: str) -> DataFrame:
    """mapInArrow for a generator of dicts of columns; ``schema`` is a DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema), prefers_large_types=False)
    # Rows here are whole texts or sets: a batch of Spark's default 10,000 takes too much of a worker.
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_ROWS)) > MOST_ROWS:
        conf.set(BATCH_ROWS, str(MOST_ROWS))

    def run(batches):
        try:
            yield from records(batches)
        finally:
            give_back()

    def records(batches):
        for columns in f(batches):
            arrays = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, type=t.type) for x, t in ((columns[t.name], t) for t in arrow)]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays([a.cast(t.type) if a.type != t.type else a for a, t in zip(arrays, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return h.view(np.int64)


def unsigned(h: np.ndarray) -> np.ndarray:
    return np.asarray(h, np.int64).view(np.uint64)
