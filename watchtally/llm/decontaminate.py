"""Operator 5: benchmark decontamination by size-partitioned MinHash containment search.

Question: which documents contain at least 80 % of a test item's distinct 5-word
shingles? Test items are short, documents long, so Jaccard signatures of whole
documents see nothing; containment is searched from the items' side.

1. Items are partitioned by size, classes [2^c, 2^(c+1)) of shingles. An item's sketch
   is its k smallest MinHash values, k being the class's ``spare + 1``, where
   ``spare = n - ceil(0.8 n)`` is the most shingles that a containing document may
   lack (of the largest size in the class). Among k shingles of the item at least
   one must occur in such a document, so the search misses none.
2. One scan of the documents tests every shingle against two bit filters of fixed
   size, made from all sketches and from all item shingles. Only documents with a
   sketch hit emit anything: their shingles that may belong to an item.
3. Sketch hits meet the items' sketches in a join, which gives candidate pairs;
   each is verified by counting the item's shingles in the document exactly.

The filters' size doesn't depend on the data; a larger benchmark only lets more
shingles through to the exact joins, which are shuffle joins.

Words are maximal runs of bytes other than ASCII punctuation, white space and
controls, A-Z lower-cased, so a passage is found whatever its punctuation.

Defined cases: items without words are found nowhere; an item of fewer than five
words is one shingle, found only in documents with just these words; null and
empty texts contain nothing; repeated documents are each reported, repeated items
once per item_id; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PUNCT, U64, Words, cut, groups, map_arrow, mix, signed


@dataclass(frozen=True)
class SearchConfig:
    words: int = 5
    percent: int = 80
    filter_bits: int = 1 << 25


def sketch_size(n: int, percent: int) -> int:
    """Sketch size of the class of an item with n shingles."""
    top = (1 << n.bit_length()) - 1
    return top - -(-percent * top // 100) + 1


def _name(s: np.ndarray) -> int:
    """Fingerprint of a set of shingles."""
    return int(signed(mix(np.array([s.sum(dtype=np.uint64) + U64(len(s))], np.uint64)))[0])


def _minhash(s: np.ndarray) -> np.ndarray:
    return mix(s ^ U64(0x2545F4914F6CDD1D))


def item_shingles(items: DataFrame, c: SearchConfig) -> DataFrame:
    """One row per item and shingle: item_id, item (fingerprint), n, size_class, shingle, in_sketch."""

    def run(batches):
        for batch, texts in groups(batches):
            ids = batch.column("item_id").to_pylist()
            for i, s in enumerate(Words(texts, PUNCT, lower=True).shingles(c.words)):
                if n := len(s):
                    h = _minhash(s)
                    k = min(sketch_size(n, c.percent), n)
                    yield {"item_id": [ids[i]] * n, "item": [_name(s)] * n, "n": [n] * n, "size_class": [n.bit_length() - 1] * n,
                           "shingle": signed(s), "in_sketch": h <= np.partition(h, k - 1)[k - 1]}

    return map_arrow(items.select("item_id", "text"), run, "item_id long, item long, n int, size_class int, shingle long, in_sketch boolean").distinct()


def bit_filter(shingles: DataFrame, bits: int) -> np.ndarray:
    """Bits of all shingles; at most ``bits / 64`` rows reach the driver."""
    at = F.pmod("shingle", F.lit(bits))
    words = shingles.select(F.shiftright(at, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(pmod(shingle, {bits}), 64) as int))").alias("b"))
    out = np.zeros(bits // 64, np.uint64)
    for w, b in words.groupBy("w").agg(F.bit_or("b").alias("b")).collect():
        out[w] = U64(b & 0xFFFFFFFFFFFFFFFF)
    return out


def _test(filt: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = np.mod(signed(h), len(filt) * 64)
    return (filt[at >> 6] >> (at & 63).astype(np.uint64)) & U64(1) == 1


def search(docs: DataFrame, items: DataFrame, config: SearchConfig = SearchConfig()) -> DataFrame:
    """doc_id, doc (fingerprint of its shingles), item_id, n_shingles, n_common, containment of every pair at or above the threshold."""
    return _search(docs.select("doc_id", "text"), items, config)[0]


def _search(docs: DataFrame, items: DataFrame, c: SearchConfig) -> tuple[DataFrame, DataFrame]:
    """The pairs, and the documents' hits with the columns of ``docs`` but text (a text_id on one hit of each row only)."""
    spark = docs.sparkSession
    by_text = "text_id" in docs.columns
    own = cut(item_shingles(items, c))
    sketch = own.where("in_sketch")
    sent = spark.sparkContext.broadcast((bit_filter(sketch, c.filter_bits), bit_filter(own, c.filter_bits)))

    def run(batches):
        of_sketch, of_items = sent.value
        for batch, texts in groups(batches):
            w = Words(texts, PUNCT, lower=True)
            at, h = w.windows(c.words)
            hit = np.zeros(len(texts), bool)
            hit[w.doc[at[_test(of_sketch, h)]]] = True
            hit |= np.diff(w.first) < c.words  # short ones are looked at below
            if not hit.any():
                continue
            chosen = np.flatnonzero(hit)
            out = {"row": [], "first": [], "doc": [], "shingle": [], "sketched": []}
            for i, s in zip(chosen, Words([texts[i] for i in chosen], PUNCT, lower=True).shingles(c.words)):
                sketched = _test(of_sketch, s)
                if sketched.any():
                    keep = _test(of_items, s)
                    out["row"].append(np.full(keep.sum(), i))
                    out["first"].append(np.arange(keep.sum()) == 0)
                    out["doc"].append(np.full(keep.sum(), _name(s)))
                    out["shingle"].append(signed(s[keep]))
                    out["sketched"].append(sketched[keep])
            if out["row"]:
                rows = pa.array(np.concatenate(out["row"]), pa.int64())
                made = {k: np.concatenate(v) for k, v in out.items() if k != "row"} | {"doc_id": batch.column("doc_id").take(rows)}
                if by_text:
                    own = pa.array(np.concatenate(out["row"]), pa.int64(), mask=~made["first"])
                    made["text_id"] = batch.column("text_id").take(own)
                yield made

    every = cut(map_arrow(docs, run, "doc_id long, doc long, shingle long, sketched boolean" + ", text_id string" * by_text))
    # Rows of one text and id repeat when documents do; pairs are counted once.
    hits = every.groupBy("doc_id", "doc", "shingle").agg(F.max("sketched").alias("sketched"))
    pairs = (hits.where("sketched").join(sketch.select("shingle", "item_id", "item", "n").hint("merge"), "shingle")
             .select("doc_id", "doc", "item_id", "item", "n").distinct())
    # Each candidate's shingles are those of the item found among the document's hits.
    p, h = pairs.alias("p"), hits.alias("h")
    asked = p.join(own.select("item_id", "item", "shingle").hint("merge"), ["item_id", "item"])
    a = asked.alias("a")
    found = a.join(h.hint("merge"), (F.col("a.shingle") == F.col("h.shingle")) & (F.col("a.doc") == F.col("h.doc")) & F.col("a.doc_id").eqNullSafe(F.col("h.doc_id")))
    counted = found.groupBy("a.doc_id", "a.doc", "a.item_id", "a.item", "a.n").agg(F.count("*").alias("n_common"))
    best = counted.where(f"100 * n_common >= {c.percent} * n")
    best = (best.groupBy("doc_id", "doc", "item_id").agg(F.max_by("n", "n_common").cast("long").alias("n_shingles"), F.max("n_common").alias("n_common"))
            .withColumn("containment", F.round(F.col("n_common") / F.col("n_shingles"), 6)))
    return best, every


def clean(docs: DataFrame, items: DataFrame, config: SearchConfig = SearchConfig()) -> DataFrame:
    """``docs`` without the documents that contain a test item; rows of one doc_id, null or not, are judged by their own text."""
    pairs, hits = _search(docs.select("doc_id", "text", F.md5("text").alias("text_id")), items, config)
    found = pairs.select(F.col("doc_id").alias("_id"), F.col("doc").alias("_doc")).distinct().hint("merge")
    texts = hits.where("text_id is not null").select("doc_id", "doc", "text_id").distinct()
    bad = (texts.join(found, texts["doc_id"].eqNullSafe(found["_id"]) & (texts["doc"] == found["_doc"]), "left_semi")
           .select(F.col("doc_id").alias("_id"), F.col("text_id").alias("_bad")).hint("merge"))
    named = docs.withColumn("_text_id", F.md5("text"))
    return named.join(bad, named["doc_id"].eqNullSafe(bad["_id"]) & (named["_text_id"] == bad["_bad"]), "left_anti").select(*docs.columns)
