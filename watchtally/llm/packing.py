"""Operator 2: best-fit packing by minimum bin slack.

Documents are encoded once; the pieces (a long document is cut into pieces of
``capacity`` ids, its first piece takes the remainder) are numbered within
(task, length) while they are made. Only the number of pieces of each length
matters to the packing, so the whole corpus is planned from a histogram with at
most ``capacity`` entries: for each bin the longest remaining piece is placed and a
bitset subset-sum dynamic programme over the remaining lengths (with their
counts) finds the fullest feasible combination; that combination is removed, as
many times over as the counts allow, which is what bin after bin would do. A
combination uses up at least one length each time, so the plan has at most
``capacity`` combinations, and is small whatever the corpus.

Pieces then find their place by arithmetic: the rank of a piece among those of
its length (prefix sums of the tasks' counts plus its own number) falls into one
of the plan's ranges, which gives sequence and offset. No piece is sorted, and no
length, however common, gathers in one task.

Defined cases: null text is the empty text (its end id alone, one piece of one
id); null doc_id is kept; repeated rows are packed each; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, map_arrow
from .tokens import byte_encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    first = n % capacity
    starts = ([0] if first else []) + [*range(first, n, capacity)]
    return [(s, (first if s == 0 and first else capacity)) for s in starts]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``number`` counts the pieces of one length in one task, from 0."""

    def run(batches):
        from pyspark import TaskContext

        encoder, task, seen = byte_encoder(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                out = {k: [] for k in ("row", "piece", "start", "length", "ids_crc32", "number", "ids")}
                for r, x in enumerate(encoder.encode([x or "" for x in batch.column("text").to_pylist()])):
                    ids = np.append(x, end_id).astype("<u4")
                    for p, (s, n) in enumerate(cut_points(len(ids), capacity)):
                        part = ids[s : s + n]
                        for k, v in (("row", r), ("piece", p), ("start", s), ("length", n), ("ids_crc32", zlib.crc32(part)), ("number", int(seen[n]))):
                            out[k].append(v)
                        if with_ids:
                            out["ids"].append(part.astype(np.int64))
                        seen[n] += 1
                yield out | {"doc_id": batch.column("doc_id").take(pa.array(out["row"])), "task": [task] * len(out["row"])}

    return map_arrow(docs.select("doc_id", "text"), run, PIECES + (", ids array<long>" if with_ids else ""))


def fullest(counts: np.ndarray, capacity: int) -> list[int]:
    """Lengths of the fullest bin: the longest piece left, then a subset-sum over the others.

    Bit s of ``reach`` tells that some choice among the lengths so far adds up to
    s. Lengths are added longest first and the search ends once the bin is full, so
    ties go to few, long pieces.
    """
    lengths = np.flatnonzero(counts)
    longest = int(lengths[-1])
    room = capacity - longest
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for n in lengths[::-1].tolist():
        if n > room:
            continue
        free = int(counts[n]) - (n == longest)
        for _ in range(min(free, room // n)):
            new = reach | reach << n & mask
            if new == reach:
                break
            steps.append((n, reach))
            reach = new
        if reach >> room:
            break
    s, out = reach.bit_length() - 1, [longest]
    for n, before in reversed(steps):
        if not before >> s & 1:
            out.append(n)
            s -= n
    return out


def plan(histogram: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Ranges of ranks: pieces of ``length`` with ranks from ``rank`` lie ``each`` to a sequence,
    sequences counted from ``sequence``, the first of them at ``offset``."""
    counts = np.zeros(capacity + 1, np.int64)
    for n, c in histogram.items():
        counts[n] = c
    total, sequence, rows = counts.copy(), 0, []
    while counts.any():
        used: dict[int, int] = {}
        for n in fullest(counts, capacity):
            used[n] = used.get(n, 0) + 1
        times = min(int(counts[n]) // c for n, c in used.items())
        offset = 0
        for n, c in used.items():
            rows.append((n, int(total[n] - counts[n]), c, sequence, offset))
            offset += n * c
            counts[n] -= c * times
        sequence += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "each", "sequence", "offset"), columns))


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    made = cut(pieces(docs, tokenizer, end_id, capacity, with_ids))
    by_task = made.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    place = docs.sparkSession.sparkContext.broadcast(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = made.join(bases, ["task", "length"]).withColumn("rank", F.col("base") + F.col("number")).drop("base", "number", "task")

    def run(batches):
        p = place.value
        top = np.int64(1) << 44
        keys = p["length"] * top + p["rank"]
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("length", "rank"))
            at = np.searchsorted(keys, length * top + rank, "right") - 1
            nth = rank - p["rank"][at]
            yield {k: batch.column(k) for k in batch.schema.names if k != "rank"} | {
                "sequence_id": p["sequence"][at] + nth // p["each"][at], "offset": p["offset"][at] + nth % p["each"][at] * length}

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return map_arrow(ranked, run, schema + (", ids array<long>" if with_ids else ""))


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence, its pieces in order (``packed`` made with ids); a group holds at most `capacity` ids."""
    order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(order, lambda x: x["ids"])).alias("ids"))
