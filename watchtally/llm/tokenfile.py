"""Operator 9: token ids in a binary format.

Documents are dealt by ranges of doc_id and sorted inside each range; every task
encodes its range and writes two flat files into the shared folder:

``part-<n>.bin``  all ids, unsigned little-endian integers, 2 bytes each if the
                  vocabulary has at most 65,536 ids, else 4
``part-<n>.idx``  64-bit little-endian: number of documents, their doc_ids, then
                  their offsets in ids (one more than documents)

A small manifest table (one row per part: file, width, documents, ids, smallest
doc_id) gives each part its base, the prefix sum of the ids before it. Reading
memory-maps the files (random-access reads where the store can't be mapped).
A part is written under a name of its own attempt and then moved to its final
name, so a retried or duplicated task leaves one whole file.

Defined cases: null text is the empty text (end id alone); rows without doc_id
come first, as doc_id null; equal doc_ids stay side by side, in a fixed order;
extra columns are ignored; an empty table writes no part.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, map_arrow, shared_folder
from .tokens import forget_encoders, word_encoder

NO_ID = np.iinfo(np.int64).min
MANIFEST = "file string, width int, n_docs long, n_tokens long, first_id long"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path and the path inside it; a plain path is a local one."""
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def put(fs: pafs.FileSystem, path: str, write) -> None:
    """Write a whole file under an attempt's own name, then move it into place."""
    own = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(own) as out:
        write(out)
    fs.move(own, path)


def _ranges(df: DataFrame, rows_each: int) -> DataFrame:
    n = max(1, -(-df.count() // rows_each))
    return df.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, rows_each: int = 8192) -> DataFrame:
    """Write the files and return the manifest with each part's ``base``."""
    folder = folder or shared_folder(docs.sparkSession, "tokens")

    def run(batches):
        from pyspark import TaskContext

        encoder = word_encoder(tokenizer)
        width = 2 if max(encoder.n_ids, end_id + 1) <= 1 << 16 else 4
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}"
        ids, sizes = [], []

        def write(out):
            for batch in batches:
                ids.extend(NO_ID if x is None else x for x in batch.column("doc_id").to_pylist())
                for a in range(0, batch.num_rows, 256):
                    for x in encoder.encode([x or "" for x in batch.column("text").slice(a, 256).to_pylist()]):
                        sizes.append(len(x) + 1)
                        out.write(np.append(x, end_id).astype(f"<u{width}").tobytes())

        put(fs, f"{root}/{name}.bin", write)
        offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        index = np.concatenate([[len(ids)], ids, offsets]).astype("<i8")
        put(fs, f"{root}/{name}.idx", lambda out: out.write(index.tobytes()))
        if ids:
            yield {"file": [f"{folder}/{name}"], "width": [width], "n_docs": [len(ids)], "n_tokens": [int(offsets[-1])], "first_id": [ids[0]]}

    parts = cut(map_arrow(_ranges(docs.select("doc_id", "text"), rows_each), run, MANIFEST))
    return with_bases(parts)


def with_bases(parts: DataFrame) -> DataFrame:
    """The manifest (one row per part) with the ids before each part, in the order of part numbers (a longer name is a greater number)."""
    before = Window.orderBy(F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def open_part(file: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, offsets and ids of a part; ids are memory-mapped on a local or mounted folder."""
    fs, path = file_system(file)
    with fs.open_input_file(f"{path}.idx") as f:
        index = np.frombuffer(f.read(), "<i8")
    n = int(index[0])
    if isinstance(fs, pafs.LocalFileSystem):
        with pa.memory_map(f"{path}.bin") as f:
            raw = f.read_buffer()
    else:
        with fs.open_input_file(f"{path}.bin") as f:
            raw = f.read_buffer()
    return index[1 : n + 1], index[n + 1 :], np.frombuffer(raw, f"<u{width}")


def read_tokens(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and the ids) of every document in the files."""

    def run(batches):
        forget_encoders()
        for batch in batches:
            for row in batch.to_pylist():
                doc_ids, offsets, ids = open_part(row["file"], row["width"])
                step = 4096
                for a in range(0, len(doc_ids), step):
                    b = min(a + step, len(doc_ids))
                    own = [ids[offsets[i] : offsets[i + 1]].astype("<u4") for i in range(a, b)]
                    yield {"doc_id": pa.array(doc_ids[a:b], mask=doc_ids[a:b] == NO_ID), "start": row["base"] + offsets[a:b], "n_tokens": np.diff(offsets[a : b + 1]),
                           "ids_crc32": [zlib.crc32(x) for x in own]} | ({"ids": [x.astype(np.int64) for x in own]} if with_ids else {})

    n = max(1, manifest.count())
    dealt = manifest.repartition(min(n, 10_000), "file")
    return map_arrow(dealt, run, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))
