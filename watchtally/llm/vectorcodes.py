"""Operator 12: vector codes (product quantisation) over anchors-hierarchy metric trees.

A vector becomes integers, floor(scale * x), and is cut into equal consecutive parts.
For each block of vectors and each part position a metric tree is built middle-out:

* middle: anchors, each taking the points nearer to it than to any other; the next one is the point
  farthest from its own anchor, and a point can only move if it lies farther from its own
  anchor than half the way to the new one;
* up: the two balls with the smallest common ball are joined until one is left;
* down: an anchor with more than ``leaf`` points gets a hierarchy of its own.

Every ball caches the sum and the count of its points, an integer pivot and the exact
squared radius. Blocks and trees are stored once; each round and the final
assignment descend them. A ball inherits its parent's list of candidate entries, and an entry
leaves the list when another one is nearer for every place in the ball. With one entry left the ball
is wholly owned: its cached sum and count are added and no point is looked at. Points of
other leaves are compared with the leaf's list only.

Everything is exact: distances and sums are 64-bit integers, an entry is dropped only
if it is farther by more than rounding could hide, and equal distances go to the lower index.
Tasks add up their blocks; Spark adds up the tasks: the driver gets ``parts * entries`` sums, whatever the number of vectors.

Defined cases: rows whose vector is null, empty or holds a null or non-finite component are
dropped; so are vectors of another length than the one with the smallest vec_id (they have no parts to compare). Null
vec_ids come last in the order, equal ones are ordered by vector; each row is coded by itself. Fewer kept rows
than entries give smaller codebooks; a length that the number of parts doesn't divide is cut as evenly as
possible; an empty table gives no rows. Other columns are ignored. Null labels are one group. Components beyond
``LIMIT / scale`` would pass 64 bits and raise ValueError. A hot label is summed in tasks first and joined back in salted groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, removed, shared_folder, stored

#: Integers of a vector stay below this, so that distances of 256 components fit 64 bits.
LIMIT = 1 << 26
FAR = np.iinfo(np.int64).max
#: An entry must be farther by this share before it leaves a list; doubles err by far less.
SAFE = 1 + 1e-9


@dataclass(frozen=True)
class CodeConfig:
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    block_rows: int = 4096
    leaf: int = 48
    salts: int = 64


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, exact."""
    return (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T)


def anchors(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of the anchors, each point's anchor, squared radii)."""
    place, owner = [0], np.zeros(len(x), np.int64)
    own = ((x - x[0]) ** 2).sum(1)
    while len(place) < most:
        new = int(own.argmax())
        if not own[new]:
            break
        gap = ((x[place] - x[new]) ** 2).sum(1)
        near = np.flatnonzero(4 * own > gap[owner])
        d = ((x[near] - x[new]) ** 2).sum(1)
        won = d < own[near]
        owner[near[won]], own[near[won]] = len(place), d[won]
        place.append(new)
    radius = np.zeros(len(place), np.int64)
    np.maximum.at(radius, owner, own)
    return np.array(place), owner, radius


def middle_out(x: np.ndarray, members: np.ndarray, leaf: int):
    """A nested tree over x[members]: an index array (leaf) or a pair of trees."""
    if len(members) <= leaf:
        return members
    own = x[members]
    place, owner, radius = anchors(own, int(np.ceil(np.sqrt(len(members)))))
    if len(place) == 1:
        return members  # equal points
    trees = [middle_out(x, members[owner == a], leaf) for a in range(len(place))]
    return joined(trees, own[place].astype(float), np.sqrt(radius), np.bincount(owner, minlength=len(place)).astype(float))


def joined(trees: list, pivot: np.ndarray, radius: np.ndarray, count: np.ndarray):
    """Join the two balls with the smallest common ball, until one tree is left."""
    n = len(trees)
    common = (np.sqrt(np.maximum(0, ((pivot[:, None] - pivot[None]) ** 2).sum(2))) + radius[:, None] + radius) / 2
    np.fill_diagonal(common, np.inf)
    for _ in range(n - 1):
        a, b = divmod(int(common.argmin()), n)
        centre = (pivot[a] * count[a] + pivot[b] * count[b]) / (count[a] + count[b])
        radius[a] = max(np.sqrt(((centre - pivot[c]) ** 2).sum()) + radius[c] for c in (a, b))
        trees[a], pivot[a], count[a] = (trees[a], trees[b]), centre, count[a] + count[b]
        common[b] = common[:, b] = np.inf
        alive = np.isfinite(common[a])
        common[a, alive] = common[alive, a] = (np.sqrt(((pivot[alive] - centre) ** 2).sum(1)) + radius[alive] + radius[a]) / 2
        last = a
    return trees[last]


@dataclass
class Tree:
    """A tree over points laid out so that each ball is a range; ball 0 is the root."""

    order: np.ndarray  # place in the block of each laid-out point
    x: np.ndarray  # laid-out points
    start: np.ndarray
    end: np.ndarray
    child: np.ndarray  # the left one; the right one follows it; -1: a leaf
    pivot: np.ndarray
    radius: np.ndarray  # squared
    total: np.ndarray  # cached sums

    @classmethod
    def build(cls, x: np.ndarray, leaf: int) -> Tree:
        nested = middle_out(x, np.arange(len(x)), leaf)
        order, start, end, child = [], [0], [0], [-1]
        todo, at = [(nested, 0)], 0
        # Depth first, so that leaves lie in order; a ball's range ends when its subtree is laid out.
        while todo:
            node, i = todo.pop()
            if node is None:
                end[i] = at
            elif isinstance(node, tuple):
                start[i], child[i] = at, len(start)
                left = len(start)
                start += [0, 0]
                end += [0, 0]
                child += [-1, -1]
                todo += [(None, i), (node[1], left + 1), (node[0], left)]
            else:
                start[i] = at
                order.append(node)
                at += len(node)
                end[i] = at
        order = np.concatenate(order)
        return cls.of(order, x[order], np.array(start), np.array(end), np.array(child))

    @classmethod
    def of(cls, order, x, start, end, child) -> Tree:
        sums = np.concatenate((np.zeros((1, x.shape[1]), np.int64), np.cumsum(x, 0)))
        total = sums[end] - sums[start]
        pivot = total // np.maximum(1, end - start)[:, None]
        radius = np.array([((x[a:b] - p) ** 2).sum(1).max(initial=0) for a, b, p in zip(start.tolist(), end.tolist(), pivot)], np.int64)
        return cls(order, x, start, end, child, pivot, radius, total)

    FIELDS = (("order", "<i4"), ("x", "<i4"), ("start", "<i4"), ("end", "<i4"), ("child", "<i4"), ("pivot", "<i4"), ("radius", "<i8"), ("total", "<i8"))

    def packed(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, f), t).tobytes() for f, t in self.FIELDS]

    @classmethod
    def unpacked(cls, raw: list[bytes]) -> Tree:
        a = {f: np.frombuffer(r, t).astype(np.int64) for (f, t), r in zip(cls.FIELDS, raw)}
        d = len(a["x"]) // max(1, len(a["order"]))
        return cls(**a | {f: a[f].reshape(-1, d) for f in ("x", "pivot", "total")})

    def assign(self, book: np.ndarray, points: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """(sums, counts) by entry and, if asked for, each laid-out point's entry; equal distances go to the lower entry."""
        k = len(book)
        sums, counts = np.zeros_like(book), np.zeros(k, np.int64)
        entry = np.zeros(len(self.x), np.int64) if points else None
        gap = np.sqrt(distances(book, book).astype(float))
        ball, listed = np.zeros(1, np.int64), np.ones((1, k), bool)
        while len(ball):
            d = distances(self.pivot[ball], book)
            best = np.where(listed, d, FAR).argmin(1)
            more = (d - d[np.arange(len(ball)), best][:, None]).astype(float)
            listed &= ~(more > 2 * SAFE * np.sqrt(self.radius[ball].astype(float))[:, None] * gap[best])
            owned = listed.sum(1) == 1
            np.add.at(sums, best[owned], self.total[ball[owned]])
            np.add.at(counts, best[owned], (self.end - self.start)[ball[owned]])
            if points:
                for b, c in zip(ball[owned].tolist(), best[owned].tolist()):
                    entry[self.start[b] : self.end[b]] = c
            leaf = ~owned & (self.child[ball] < 0)
            for b, row in zip(ball[leaf].tolist(), listed[leaf]):
                few = np.flatnonzero(row)
                x = self.x[self.start[b] : self.end[b]]
                c = few[distances(x, book[few]).argmin(1)]
                np.add.at(sums, c, x)
                counts += np.bincount(c, minlength=k)
                if points:
                    entry[self.start[b] : self.end[b]] = c
            down = ~owned & ~leaf
            ball = (self.child[ball[down]][:, None] + [0, 1]).ravel()
            listed = np.repeat(listed[down], 2, axis=0)
        return sums, counts, entry


def edges(dim: int, parts: int) -> list[int]:
    """Where parts begin; the last is the end."""
    return [i * dim // parts for i in range(parts + 1)]


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers."""
    q = np.floor(x.astype(np.float64) * scale)
    if len(q) and np.abs(q).max() >= LIMIT:
        raise ValueError(f"components beyond {LIMIT // scale} can't be coded exactly")
    return q.astype(np.int64)


def kept(vectors: DataFrame) -> DataFrame:
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select("vec_id", "embedding", "label").where(v.isNotNull() & (F.size(v) > 0) & finite)


def seeds(rows: DataFrame, cfg: CodeConfig) -> list[np.ndarray]:
    """The first codebook of each part: that part of the first ``entries`` kept rows."""
    order = (F.asc_nulls_last("vec_id"), F.asc("embedding"))
    first = [r.embedding for r in rows.orderBy(*order).limit(cfg.entries).collect()]
    if first and any(len(x) != len(first[0]) for x in first):
        first = [r.embedding for r in rows.where(F.size("embedding") == len(first[0])).orderBy(*order).limit(cfg.entries).collect()]
    if not first:
        return []
    q = whole(np.array(first), cfg.scale)
    cut = edges(q.shape[1], cfg.parts)
    return [q[:, a:b] for a, b in zip(cut, cut[1:])]


def blocks(rows: DataFrame, dim: int, cfg: CodeConfig) -> DataFrame:
    """vec_id, label: arrays of a block's rows; trees: one packed tree for each part."""
    cut = edges(dim, cfg.parts)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}

    def block(columns: list[pa.RecordBatch]) -> dict:
        q = whole(np.concatenate([b.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) for b in columns]), cfg.scale)
        trees = [Tree.build(q[:, a:b], cfg.leaf).packed() for a, b in zip(cut, cut[1:])]
        return {c: pa.array([[x for b in columns for x in b.column(c).to_pylist()]], pa.list_(columns[0].schema.field(c).type)) for c in kinds} | {"trees": [trees]}

    def run(batches) -> Iterator[dict]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, cfg.block_rows - n)
                held.append(part)
                n += part.num_rows
                batch = batch.slice(part.num_rows)
                if n == cfg.block_rows:
                    yield block(held)
                    held, n = [], 0
        if held:
            yield block(held)

    same = rows.where(F.size("embedding") == dim)
    return map_arrow(same, run, f"vec_id array<{kinds['vec_id']}>, label array<{kinds['label']}>, trees array<array<binary>>")


def one_round(stored_blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The next codebooks: each entry the floor of the mean of its parts, unused ones as they are."""
    width = max(b.shape[1] for b in books)

    def run(batches) -> Iterator[dict]:
        sums, counts = [np.zeros_like(b) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for row in batch.column("trees"):
                for p, raw in enumerate(row.as_py()):
                    s, c, _ = Tree.unpacked(raw).assign(books[p], False)
                    sums[p] += s
                    counts[p] += c
        for p, (s, c) in enumerate(zip(sums, counts)):
            used = np.flatnonzero(c)
            yield {"part": np.full(len(used), p), "entry": used, "n": c[used], "total": [*np.pad(s[used], ((0, 0), (0, width - s.shape[1])))]}

    partial = map_arrow(stored_blocks.select("trees"), run, "part int, entry int, n long, total array<long>")
    total = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)))
    out = [b.copy() for b in books]
    for r in total.collect():  # parts * entries rows at most
        book = out[r["part"]]
        book[r["entry"]] = [r[f"t{i}"] // r["n"] for i in range(book.shape[1])]
    return out


def codes(stored_blocks: DataFrame, books: list[np.ndarray], kinds: dict[str, str]) -> DataFrame:
    """vec_id, label, code, error of every kept vector."""

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            ids, labels = batch.column("vec_id"), batch.column("label")
            for i, row in enumerate(batch.column("trees")):
                n = len(ids[i].values)
                code, error = np.zeros((n, len(books)), np.uint8), np.zeros(n, np.int64)
                for p, raw in enumerate(row.as_py()):
                    tree = Tree.unpacked(raw)
                    entry = tree.assign(books[p], True)[2]
                    code[tree.order, p] = entry
                    error[tree.order] += ((tree.x - books[p][entry]) ** 2).sum(1)
                text, w = code.tobytes().hex(), 2 * len(books)
                yield {"vec_id": ids[i].values, "label": labels[i].values, "code": [text[j * w : (j + 1) * w] for j in range(n)], "error": error}

    return map_arrow(stored_blocks, run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def sha256_of(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, cfg: CodeConfig = CodeConfig()) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256: one row for each kept row of vectors."""
    rows = kept(vectors)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    books = seeds(rows, cfg)
    if not books:
        return vectors.sparkSession.createDataFrame([], f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long, label_error long, codebooks_sha256 string")
    spark, folder = rows.sparkSession, shared_folder(rows.sparkSession, "vector-trees")
    trees = blocks(rows, sum(b.shape[1] for b in books), cfg)
    trees.write.parquet(folder)
    trees = spark.read.schema(trees.schema).parquet(folder)
    for _ in range(cfg.rounds):
        books = one_round(trees, books)
    coded = stored(codes(trees, books, kinds), "vector-codes")
    removed(spark, folder)
    salts = F.array([F.lit(i) for i in range(cfg.salts)])
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("_label"), "label_error", F.explode(salts).alias("_salt"))
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(cfg.salts)).cast("int"))
    joined_back = salted.join(totals.hint("merge"), F.col("label").eqNullSafe(F.col("_label")) & (F.col("salt") == F.col("_salt")))
    return joined_back.select("vec_id", "label", "code", "error", "label_error", F.lit(sha256_of(books)).alias("codebooks_sha256"))
