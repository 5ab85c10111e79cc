"""Operator 11: phrase collocation mining by set-oriented relational mining (SETM).

R1 is the occurrence relation: for each word its piece and position, kept sorted.
It is persisted as one row for each block of texts, bucketed by block: piece and
position are one ascending number ``at`` (consecutive inside a piece, a gap between
pieces), ``code`` points into the block's dictionary. Then for each length k:

* group-count: the blocks' dictionaries, each group of a block with its count there, are
  dealt by group (words as rows, longer groups in compressed parts) and summed; groups
  below ``min_count`` go;
* semi-join: the frequent groups go back to the blocks that hold them;
* extension: in each block R_k, cut to its frequent groups, is merge-joined with
  itself by piece and adjacent position (both sides are sorted by ``at``), so R_k+1
  holds each pair of overlapping occurrences of frequent groups; it is persisted.

Occurrences never leave their block: only dictionaries and frequent groups are
shuffled, so a word that makes up a third of the corpus is one row a block. A group
is known by the ids of its first and its last k-1 words, which gives the counts
of all its beginnings and ends, needed by the score, without further counting. The
bucketed relation meets the frequent groups without being shuffled again.

Scores are decimals of 38 digits; a quotient is cut to its integer part exactly.
A candidate lies inside a longer one with half its count exactly if it is the
beginning or the end of such a candidate that is one word longer, since counts only fall
with length. The first ``top`` of a language are taken in salted groups first.

Defined cases: null or empty texts have no pieces; a null lang is ``und`` and one
group with that text; repeated rows count each; extra columns and doc_id are ignored;
equal scores are ordered by count, then phrase in UTF-8 byte order; an empty table gives no rows.
A long text is cut into segments after a word; a segment borrows the words that its
last phrases need from its successor (``guest``), which count only as ends of phrases. A
block takes about ``block_bytes`` of text (one longer word makes it longer) and 20 times that in memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from .common import LOWER, U64, give_back, map_arrow, mix, removed, shared_folder, stored, text_bytes

# Fixed values of the contract: what ends a piece, what parts words.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"
_BREAK = np.zeros(256, bool)
_BREAK[[*BREAKS]] = True
_APART = _BREAK.copy()
_APART[[*BLANKS]] = True
_NEXT = re.compile(rb"[" + re.escape(BREAKS + BLANKS) + rb"]|\Z")

WORDS = "block long, lang array<string>, word array<string>, n array<long>, langs array<string>, lang_n array<long>, step binary, code binary, guest binary"
#: The relations of longer groups: a row of occurrences for each block, and its dictionary in parts.
GROUPS = "block long, step binary, code binary, guest binary, part int, entries binary"
#: Frequent groups of one part: lists for the blocks that hold them, and a row (no block) with their counts.
FOUND = "block long, places binary, ids binary, first array<long>, rest array<long>, id array<long>, f array<long>"


@dataclass(frozen=True)
class CollocationConfig:
    max_words: int = 3
    min_count: int = 10
    #: A longer candidate with so many percent of a candidate's count drops it.
    inside_pct: int = 50
    top: int = 2000
    scale: int = 1_000_000
    block_bytes: int = 8 << 20
    #: Parts of the groups' dictionaries; 0: four for each shuffle partition.
    parts: int = 0
    salts: int = 32


def segments(text: bytes, most: int, borrow: int) -> Iterator[tuple[bytes, int]]:
    """(bytes, own): parts of a text with ``borrow`` words beyond their own bytes, unless a piece ends before."""
    a = 0
    while len(text) - a > most:
        b = _NEXT.search(text, a + most).start()
        end = b
        for _ in range(borrow):
            while end < len(text) and text[end] in BLANKS:
                end += 1
            end = _NEXT.search(text, end).start()
        yield text[a:end], b - a
        a = b
    yield text[a:], len(text) - a


def _packed(x: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def _one_list(x) -> pa.ListArray:
    x = pa.array(x)
    return pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)


def _block(number: int, parts: list[tuple[str, bytes, int]]) -> dict:
    """The first relation of one block of (lang, bytes, own bytes)."""
    langs = pa.array([p[0] for p in parts], pa.string()).dictionary_encode()
    raw = LOWER[np.frombuffer(b"\n".join(p[1] for p in parts) + b"\n", np.uint8)]
    sizes = np.fromiter((len(p[1]) + 1 for p in parts), np.int64, len(parts))
    offset = np.concatenate(([0], np.cumsum(sizes)))
    inside = ~_APART[raw]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    piece = np.cumsum(_BREAK[raw], dtype=np.int64)[start]
    part = np.searchsorted(offset, start, "right") - 1
    own = start - offset[part] < np.fromiter((p[2] for p in parts), np.int64, len(parts))[part]
    at = np.arange(len(start)) + np.cumsum(np.diff(piece, prepend=0) > 0)
    ends = np.concatenate(([0], np.cumsum(end - start))).astype(np.int32)
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(raw[inside])).dictionary_encode()
    lang = langs.indices.to_numpy().astype(np.int64)[part]
    m = max(1, len(words.dictionary))
    entries, code = np.unique(lang * m + words.indices.to_numpy(), return_inverse=True)
    return {
        "block": [number], "lang": _one_list(langs.dictionary.take(pa.array(entries // m))), "word": _one_list(words.dictionary.take(pa.array(entries % m))),
        "n": _one_list(np.bincount(code[own], minlength=len(entries))), "langs": _one_list(langs.dictionary), "lang_n": _one_list(np.bincount(lang[own], minlength=len(langs.dictionary))),
        "step": [_packed(np.diff(at, prepend=0), "<i4")], "code": [_packed(code, "<i4")], "guest": [_packed(at[~own], "<i8")],
    }


def occurrences(docs: DataFrame, cfg: CollocationConfig) -> DataFrame:
    """A row for each block of texts of one task."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")

    def run(batches):
        number, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), text_bytes(batch.column("text"))):
                for data, own in segments(text, cfg.block_bytes, cfg.max_words - 1):
                    parts.append((lang, data, own))
                    size += len(data) + 1
                    if size >= cfg.block_bytes:
                        yield _block(number, parts)
                        number, parts, size = number + 1, [], 0
        if parts:
            yield _block(number, parts)

    return map_arrow(docs, run, WORDS)


def _squeezed(*columns: tuple[np.ndarray, str]) -> bytes:
    return zstandard.ZstdCompressor(3).compress(b"".join(_packed(x, kind) for x, kind in columns))


def _unsqueezed(raw: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(raw) // sum(widths), 0, []
    for kind, w in zip(kinds, widths):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * w
    return out


ENTRY = ("<i4", "<i8", "<i8", "<i4")


def extend(relation: DataFrame, frequent: DataFrame, cfg: CollocationConfig) -> DataFrame:
    """R_k+1 from R_k and its frequent groups by block.

    A block's new dictionary leaves in parts by the hash of the group, compressed: one
    row for each block and part instead of one for each entry.
    """
    schema = to_arrow_schema(StructType.fromDDL(GROUPS), prefers_large_types=False)
    n_parts = cfg.parts or 4 * int(relation.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = "places" in frequent.columns

    def listed(right: pa.Table, m: int) -> np.ndarray:
        """The id of each entry of a block's dictionary, -1 if it isn't frequent."""
        ids = np.full(m, -1, np.int64)
        if packed:
            for places, own in zip(right.column("places").to_pylist(), right.column("ids").to_pylist()):
                ids[np.cumsum(_unsqueezed(places, "<i4")[0])] = _unsqueezed(own, "<i8")[0]
        else:
            ids[right.column("place").to_numpy()] = right.column("id").to_numpy()
        return ids

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.Table.from_batches([], schema)
        step, code, guest = (np.frombuffer(left.column(c)[0].as_buffer(), kind) for c, kind in (("step", "<i4"), ("code", "<i4"), ("guest", "<i8")))
        at = np.cumsum(step, dtype=np.int64)
        ids = listed(right, int(code.max(initial=-1)) + 1)
        kept = ids[code] >= 0
        at, code = at[kept], code[kept]
        # Merge join: in sorted order the next row is the only one that can lie at the adjacent position.
        p = np.flatnonzero(np.diff(at) == 1)
        m = max(1, len(ids))
        pairs, new = np.unique(code[p].astype(np.int64) * m + code[p + 1], return_inverse=True)
        at, new = at[p], new.astype(np.int32)
        own = ~np.isin(at, guest) if len(guest) else slice(None)
        n = np.bincount(new[own], minlength=len(pairs))
        first, rest = ids[pairs // m], ids[pairs % m]
        part = (mix(first.view(np.uint64) * U64(0x9E3779B97F4A7C15) + rest.view(np.uint64)) % U64(n_parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
        parts = [order[a:b] for a, b in zip(cuts, cuts[1:])]
        none = [None] * len(parts)
        out = pa.table({
            "block": [left.column("block")[0].as_py()] * (1 + len(parts)), "step": [_packed(np.diff(at, prepend=0), "<i4"), *none], "code": [new.tobytes(), *none],
            "guest": [guest.tobytes(), *none], "part": [None, *(int(part[x[0]]) for x in parts)],
            "entries": [None, *(_squeezed(*zip((np.diff(x, prepend=0), first[x], rest[x], n[x]), ENTRY)) for x in parts)],
        }, schema)
        del step, code, at, kept, p, pairs, new, ids, n, first, rest, part, order, parts
        give_back()
        return out

    left = relation.where(F.col("code").isNotNull()).select("block", "step", "code", "guest")
    lists = frequent.where(F.col("block").isNotNull()).select("block", *(("places", "ids") if packed else ("place", "id")))
    return left.groupBy("block").cogroup(lists.groupBy("block")).applyInArrow(one, GROUPS)


def count_groups(relation: DataFrame, cfg: CollocationConfig, lists: bool = True) -> DataFrame:
    """Group-count and semi-join of the blocks' dictionaries, part by part (``FOUND``).

    A group's entries of all blocks meet in one part, at most one a block. Parts are as many
    as the session's shuffle partitions call for, so their size doesn't grow with the corpus.
    An id is made of the part and the place among its frequent groups.
    """
    schema = to_arrow_schema(StructType.fromDDL(FOUND), prefers_large_types=False)

    def one(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        rows = [_unsqueezed(x, *ENTRY) for x in table.column("entries").to_pylist()]
        first, rest, n = (np.concatenate([r[i] for r in rows]) for i in (1, 2, 3))
        firsts, a = np.unique(first, return_inverse=True)
        rests, b = np.unique(rest, return_inverse=True)
        keys, group = np.unique(a.astype(np.int64) * len(rests) + b, return_inverse=True)
        f = np.zeros(len(keys), np.int64)
        np.add.at(f, group, n)
        often = f >= cfg.min_count
        ids = np.where(often, (part << 32) + np.cumsum(often) - 1, -1)
        keys, f = keys[often], f[often]
        out = {c: [] for c in schema.names}
        at = 0
        for block, r in zip(table.column("block").to_pylist() if lists else (), rows):
            own = ids[group[at : at + len(r[0])]]
            at += len(r[0])
            hit = own >= 0
            if hit.any():
                places = np.cumsum(r[0], dtype=np.int64)[hit]
                for c, x in (("block", block), ("places", _squeezed((np.diff(places, prepend=0), "<i4"))), ("ids", _squeezed((own[hit], "<i8")))):
                    out[c].append(x)
        k = len(out["block"])
        if len(keys):
            whole = {"first": firsts[keys // len(rests)], "rest": rests[keys % len(rests)], "id": ids[ids >= 0], "f": f}
            for c in schema.names:
                out[c] += ([None] * k if c in whole else []) + [whole.get(c)]
        elif k == 0:
            return pa.Table.from_batches([], schema)
        result = pa.table(out, schema)
        give_back()
        return result

    dictionary = relation.where(F.col("part").isNotNull()).select("part", "block", "entries")
    return dictionary.groupBy("part").applyInArrow(one, FOUND)


def counted(found: DataFrame) -> DataFrame:
    """first, rest, id, f of the frequent groups, one row each."""
    rows = found.where(F.col("block").isNull()).select("first", "rest", "id", F.posexplode("f").alias("place", "count"))
    return rows.select(*(F.get(c, F.col("place")).alias(c) for c in ("first", "rest", "id")), F.col("count").alias("f"))


class Relations:
    """Persisted relations of one run; removed together."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.names = spark, shared_folder(spark, "collocations"), []

    def bucketed(self, df: DataFrame, name: str) -> DataFrame:
        """A table bucketed by block, so that joins by block read it where it lies."""
        table = f"{self.folder.rsplit('/', 1)[-1]}_{name}".replace("-", "_")
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.bucketBy(n, "block").option("compression", "zstd").option("path", f"{self.folder}/{name}").saveAsTable(table)
        self.names.append(table)
        return self.spark.table(table)

    def plain(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            removed(self.spark, f"{self.folder}/{name}")

    def forget(self) -> None:
        for table in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        removed(self.spark, self.folder)


def frequent_words(relation: DataFrame, cfg: CollocationConfig) -> DataFrame:
    """(block, place, lang, word, id, f, main): the frequent words of every block; ``main`` marks one row of each word.

    The dictionaries are shuffled once, by the words; sums and semi-join both read that shuffle. An id is
    made of the task and the row in it, which hold for the whole word, since each word lies in one task.
    """
    n_tasks, keys = int(relation.sparkSession.conf.get("spark.sql.shuffle.partitions")), ["lang", "word"]
    # Each array is read at its place: zipped arrays would make an object of every entry.
    spread = relation.select("block", *keys, F.posexplode("n").alias("place", "n"))
    spread = spread.select("block", "place", *(F.get(k, F.col("place")).alias(k) for k in keys), "n").repartition(n_tasks, *keys)
    sums = spread.groupBy(*keys).agg(F.sum("n").alias("f"), F.min("block").alias("lowest")).where(F.col("f") >= cfg.min_count)
    sums = sums.withColumn("id", F.monotonically_increasing_id())
    # A task's frequent words are a small part of its rows: a hash table of them, no sort of the rows.
    return spread.join(sums.hint("shuffle_hash"), keys).select("block", "place", *keys, "id", "f", (F.col("block") == F.col("lowest")).alias("main"))


def _longer_phrases(before: DataFrame, groups: DataFrame) -> DataFrame:
    """Frequent groups with their phrase and the counts of all its beginnings and ends, from those one word shorter."""
    head = before.select(F.col("id").alias("first"), "lang", F.col("phrase").alias("beginning"), "heads")
    tail = before.select(F.col("id").alias("rest"), "last", "tails")
    return groups.join(head.hint("merge"), "first").join(tail.hint("merge"), "rest").select(
        "id", "first", "rest", "lang", "f", F.concat_ws(" ", "beginning", "last").alias("phrase"), "last",
        F.array_append("heads", F.col("f")).alias("heads"), F.array_append("tails", F.col("f")).alias("tails"))


def _outside(level: DataFrame, longer: DataFrame | None, cfg: CollocationConfig) -> DataFrame:
    """Candidates that don't lie inside a longer one with enough of their count."""
    if longer is None:
        return level
    inside = longer.select(F.explode(F.array_distinct(F.array("first", "rest"))).alias("id"), "f").groupBy("id").agg(F.max("f").alias("most"))
    kept = F.col("most").isNull() | (100 * F.col("most") < cfg.inside_pct * F.col("f"))
    return level.join(inside.hint("merge"), "id", "left").where(kept).drop("most")


def _scored(level: DataFrame, k: int, cfg: CollocationConfig) -> DataFrame:
    """lang, phrase, a, l, r, score of k-word phrases; the cut with the lowest score, then the smallest first part."""
    wide = "decimal(38,0)"
    cuts = []
    for i in range(1, k):
        left, right = F.col("heads")[i - 1], F.col("tails")[k - i - 1]
        score = F.call_function("div", F.lit(cfg.scale).cast(wide) * F.col("f").cast("decimal(19,0)") * F.col("f").cast("decimal(19,0)"), left.cast("decimal(19,0)") * right.cast("decimal(19,0)"))
        cuts.append(F.struct(score.alias("score"), F.lit(i).alias("cut"), left.alias("l"), right.alias("r")))
    lowest = F.array_min(F.array(*cuts)).alias("x")
    return level.select("lang", "phrase", F.col("f").alias("a"), lowest).select("lang", "phrase", "a", "x.l", "x.r", "x.score")


def _first(scored: DataFrame, cfg: CollocationConfig) -> DataFrame:
    """Each language's first ``top``; salted groups first, so no task takes all of a language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(cfg.salts)))
    for keys in (["lang", "salt"], ["lang"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).where(F.col("rank") <= cfg.top)
    return salted.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, cfg: CollocationConfig = CollocationConfig()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of two to ``max_words`` words of each language."""
    own = Relations(docs.sparkSession)
    relation = own.bucketed(occurrences(docs, cfg), "words")
    totals = relation.select(F.explode(F.arrays_zip("langs", "lang_n")).alias("g")).groupBy(F.col("g.langs").alias("lang")).agg(F.sum("g.lang_n").alias("n"))
    totals = own.plain(totals, "totals")
    found = own.plain(frequent_words(relation, cfg), "frequent_1")
    word, f = F.col("word"), F.array("f")
    levels = [found.where("main").select("id", "lang", "f", word.alias("phrase"), word.alias("last"), f.alias("heads"), f.alias("tails"))]
    for k in range(2, cfg.max_words + 1):
        relation = own.bucketed(extend(relation, found, cfg), f"groups_{k}")
        found = own.plain(count_groups(relation, cfg, k < cfg.max_words), f"frequent_{k}")
        own.drop(f"groups_{k - 1}" if k > 2 else "words")
        levels.append(own.plain(_longer_phrases(levels[-1], counted(found)), f"phrases_{k}"))
    scored = [_scored(_outside(level, longer, cfg), k, cfg) for k, (level, longer) in enumerate(zip(levels[1:], [*levels[2:], None]), 2)]
    chosen = reduce(DataFrame.unionAll, scored).join(totals.hint("merge"), "lang")
    result = stored(_first(chosen, cfg), "collocations-result")
    own.forget()
    return result
