"""Operator 4: toxicity by nearest labelled examples.

Every whole text is a query against labelled examples; similarity is the exact
cosine of TF-IDF vectors; the nearest ``neighbours`` vote with their similarity for
or against, and a logistic fitted on left-one-out votes of the examples turns the
vote into a probability. The neighbours are returned as evidence.

Terms are lower-cased words and word beginnings of 4 to 7 bytes. Every word of a text is
in its vector: a term's weight is its inverse document frequency over all documents times
``base`` plus how far its log odds between the labels (half an example added to each) lie
beyond ``shrink`` standard errors. Terms that lie beyond them have a place of their own (the
``terms`` heaviest of them); all other words share ``slots`` places by their hash, at the base
weight. So more labels make weights sharper, but no word ever leaves the vectors.

Search: a block-max inverted index. Examples are numbered by their strongest term
and dealt into blocks of ``block``; every term has its postings, cut at the blocks,
and its largest weight in each block. A query bounds each block's best possible
cosine by the sum of these maxima, opens the blocks with the highest bounds, and then of the
others those whose bound reaches its k-th best similarity: the result is exact (to nine
digits, by which ties are told). The commonest words would be most of the postings; they are
rows of a matrix, and their part of a query's scores is one product with it.

Bounds: the examples are the fitted side, a sample of at most ``examples`` labelled
rows (lowest hash of doc_id first, near copies by MinHash taken once). They, the places
(``terms`` and ``slots``) and the index are bounded by these parameters whatever the
corpus, and are sent to the tasks. Scores cover all documents.

Defined cases: a null or empty text has no
neighbours and gets the score of an empty vote; a text equal to an example's has it as its
nearest neighbour (a score knows texts alone); rows without a label or with a
null doc_id are no examples, and of rows that repeat a doc_id the smallest text is; without examples of both labels every score is the
share of toxic ones (0 without any); repeated rows are scored each; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PUNCT, U64, Words, give_back, groups, map_arrow, mix, signed, stored, unsigned

PREFIXES = (4, 5, 6, 7)


@dataclass(frozen=True)
class ToxicityConfig:
    examples: int = 8000
    terms: int = 32_768
    slots: int = 32_768
    #: Standard errors that a term's log odds lose before they count.
    shrink: float = 2.5
    #: Weight of a word that tells nothing about the labels.
    base: float = 0.3
    neighbours: int = 15
    block: int = 128
    #: Places, the commonest, whose weights are kept as a matrix instead of postings.
    dense: int = 256


def terms_of(texts: list[bytes], w: Words | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) of every word, then of every word beginning."""
    w = w or Words(texts, PUNCT, lower=True)
    doc, h = [w.doc], [w.hash]
    size = w.end - w.start
    for n in PREFIXES:
        long = size > n
        doc.append(w.doc[long])
        h.append(mix(w.pieces.hash(w.start[long], w.start[long] + n) ^ U64(0xD6E8FEB86659FD93)))
    return np.concatenate(doc), np.concatenate(h)


def counts_of(texts: list[bytes], terms: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, count), ordered by text and place: the given sorted terms, then the slots of all other words."""
    w = Words(texts, PUNCT, lower=True)
    doc, h = terms_of(texts, w)
    place = np.full(len(h), -1)
    if len(terms):
        # A small table of high bits rules most terms out before the search.
        table = np.zeros(1 << 16, bool)
        table[(terms >> U64(48)).astype(np.int64)] = True
        may = np.flatnonzero(table[(h >> U64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(terms, h[may]), len(terms) - 1)
        hit = terms[at] == h[may]
        place[may[hit]] = at[hit]
    n_words = len(w.hash)  # words come first, then their beginnings
    other = np.flatnonzero(place[:n_words] < 0)
    place[other] = len(terms) + (h[other] % U64(slots)).astype(np.int64)
    used = place >= 0
    size = len(terms) + slots
    key, n = np.unique(doc[used] * size + place[used], return_counts=True)
    return key // size, key % size, n


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places in the ranges, laid end to end, and the length of each."""
    n = end - start
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


class Index:
    """Block-max inverted index of unit vectors.

    The ``dense`` commonest places, whose postings would be most of the index, are rows of a
    matrix: their part of all scores comes from one product (``head``). The others have postings.
    """

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int, dense: int = 0):
        n = len(rows)
        self.n, self.block, self.blocks = n, block, max(1, -(-n // block))
        small = np.int32 if n_terms * self.blocks < 1 << 31 else np.int64  # the driver holds these arrays side by side
        who = np.repeat(np.arange(n, dtype=np.int32), [len(t) for t, _ in rows]) if n else np.zeros(0, np.int32)
        term = np.concatenate([t for t, _ in rows]).astype(small, copy=False) if n else np.zeros(0, small)
        weight = np.concatenate([w for _, w in rows]).astype(np.float64, copy=False) if n else np.zeros(0)
        common = np.argsort(-np.bincount(term, minlength=n_terms), kind="stable")[:dense]
        self.row = np.full(n_terms, -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.matrix = np.zeros((len(common), n))
        at = self.row[term]
        self.matrix[at[at >= 0], who[at >= 0]] = weight[at >= 0]
        who, term, weight = who[at < 0], term[at < 0], weight[at < 0]
        order = np.argsort(term, kind="stable")  # by term, then example
        self.who, self.weight = who[order], weight[order]
        cell = term[order] * small(self.blocks) + self.who // small(block)
        del who, term, weight, order, at
        # Postings of term t in block b are cut[t * blocks + b] : cut[t * blocks + b + 1].
        self.cut = np.zeros(n_terms * self.blocks + 1, np.int32 if len(cell) < 1 << 31 else np.int64)
        np.cumsum(np.bincount(cell, minlength=n_terms * self.blocks), out=self.cut[1:])
        most = np.zeros(n_terms * self.blocks, np.float32)
        np.maximum.at(most, cell, np.nextafter(self.weight.astype(np.float32), np.float32(2)))  # never below the weight
        self.most = most.reshape(n_terms, self.blocks)

    def heads(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Each query's scores by the dense places alone, a row of one for each example."""
        q = np.zeros((len(queries), len(self.matrix)))
        for i, (terms, weights) in enumerate(queries):
            at = self.row[terms]
            q[i, at[at >= 0]] = weights[at >= 0]
        return q @ self.matrix

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, but: int = -1, head: np.ndarray | None = None) -> list[tuple[float, int]]:
        """The k examples with the highest cosine above 0, best first, ties by number."""
        if not self.n:
            return []
        head = self.heads([(terms, weights)])[0] if head is None else head
        rare = self.row[terms] < 0
        terms, weights = terms[rare], weights[rare]
        bound = np.maximum.reduceat(head, np.arange(0, self.n, self.block)) + weights @ self.most[terms].astype(np.float64)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best: list[tuple[float, int]] = []
        for opened in (order[:4], order[4:]):  # the rest after the most promising ones
            if len(best) == k:
                opened = opened[bound[opened] >= -best[-1][0] - 1e-9]
            if not len(opened):
                break
            if 4 * len(opened) < self.blocks:
                cell = (terms[:, None] * self.blocks + opened).ravel()
                start, end, each = self.cut[cell], self.cut[cell + 1], np.repeat(weights, len(opened))
            else:  # a term's blocks lie side by side
                start, end, each = self.cut[terms * self.blocks], self.cut[(terms + 1) * self.blocks], weights
            where, n = _ranges(start.astype(np.int64), end.astype(np.int64))
            rest = np.bincount(self.who[where], weights=self.weight[where] * np.repeat(each, n), minlength=self.n)
            own = (opened[:, None] * self.block + np.arange(self.block)).ravel()
            own = own[(own < self.n) & (own != but)]
            score = np.round(head[own] + rest[own], 9)
            found = np.flatnonzero(score > 0)
            if len(found) > k:  # those that may be among the best k, ties included
                found = found[score[found] >= np.partition(score[found], -k)[-k]]
            best = sorted(best + [(-score[i], int(own[i])) for i in found.tolist()])[:k]
        return [(-s, i) for s, i in best]


@dataclass
class Model:
    """All that scoring needs; its size is bounded by the configuration."""

    terms: np.ndarray
    #: Inverse document frequency times the weight from the labels, of every place.
    factor: np.ndarray
    index: Index | None
    ids: np.ndarray
    toxic: np.ndarray
    slope: float
    offset: float
    config: ToxicityConfig = field(default_factory=ToxicityConfig)

    def vector(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (1 + np.log(n)) * self.factor[at]
        return w / np.sqrt((w * w).sum())

    def vote(self, near: list[tuple[float, int]]) -> float:
        return sum(s if self.toxic[i] else -s for s, i in near)

    def probability(self, vote: float) -> float:
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.slope * vote + self.offset))))


def _near_copies(rows) -> set[int]:
    """doc_ids of the examples kept: those that share no MinHash with an earlier one."""
    seen: set[tuple[int, int]] = set()
    kept = set()
    for r in sorted(rows, key=lambda r: r.doc_id):
        marks = {(i, m) for i, m in enumerate(r.marks)}
        if r.doc_id not in kept and (not marks or not marks & seen):
            kept.add(r.doc_id)
        seen |= marks
    return kept


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and offset by Newton's method with halved steps, smoothed targets and a weak pull to 0."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    design = np.stack([x, np.ones(len(x))], axis=1)
    pull = np.array([1e-2, 1e-4])

    def loss(theta):
        z = design @ theta
        return (np.logaddexp(0, z) - target * z).sum() + (pull * theta * theta).sum() / 2

    theta = np.array([0.0, math.log((pos + 1) / (neg + 1))])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -40, 40)))
        g = design.T @ (p - target) + pull * theta
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + np.diag(pull), g)
        t = 1.0
        while t > 1e-6 and loss(theta - t * step) > loss(theta):
            t /= 2
        theta = theta - t * step
        if np.abs(t * step).max() < 1e-9:
            break
    return max(0.0, float(theta[0])), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, config: ToxicityConfig = ToxicityConfig()) -> Model:
    """``labels``: doc_id, toxic (0/1)."""
    c, spark = config, docs.sparkSession
    docs = docs.select("doc_id", "text")
    chosen = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(c.examples))
    # One row a doc_id, however often a table repeats it.
    one = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sample = stored(one, "toxicity-examples")

    def marks(batches):
        for batch, texts in groups(batches):
            w = Words(texts, PUNCT, lower=True)
            out = [[int(mix(s ^ U64(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)).min() >> U64(1)) for i in (1, 2, 3)] if len(s) else [] for s in w.shingles(5)]
            yield {"doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"), "marks": out}

    rows = map_arrow(sample, marks, "doc_id long, toxic int, marks array<long>").collect()  # at most c.examples
    kept = _near_copies(rows)
    label = {r.doc_id: int(r.toxic) for r in rows if r.doc_id in kept}
    n_pos = sum(label.values())
    n_neg = len(label) - n_pos
    flat = Model(np.zeros(0, np.uint64), np.zeros(0), None, np.zeros(0, np.int64), np.zeros(0, np.int64), 0.0, -40.0, c)
    if not n_pos or not n_neg:
        flat.offset = 40.0 if n_pos else -40.0
        return flat

    ids = spark.createDataFrame([(i,) for i in sorted(kept)], "doc_id long")
    examples = sample.join(F.broadcast(ids), "doc_id")

    def count(batches):
        parts = []
        for batch, texts in groups(batches):
            doc, h = terms_of(texts)
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            order = np.lexsort((h, doc))
            doc, h = doc[order], h[order]
            first = np.ones(len(h), bool)
            first[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
            parts.append((h[first], toxic[doc[first]]))
        if parts:
            h, t = (np.concatenate(x) for x in zip(*parts))
            term, at = np.unique(h, return_inverse=True)
            yield {"term": signed(term), "pos": np.bincount(at, weights=t).astype(np.int64), "neg": np.bincount(at, weights=1 - t).astype(np.int64)}

    a, b = F.col("pos").cast("double") + 0.5, F.col("neg").cast("double") + 0.5
    beyond = F.abs(F.log(a / (n_pos + 1)) - F.log(b / (n_neg + 1))) - c.shrink * F.sqrt(1 / a + 1 / b)
    top = (map_arrow(examples.select("doc_id", "text", "toxic"), count, "term long, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
           .withColumn("beyond", beyond).where("beyond > 0").orderBy(F.desc("beyond"), "term").limit(c.terms).collect())
    terms = unsigned([r.term for r in top])
    order = np.argsort(terms)
    terms = terms[order]
    weight = np.concatenate([np.array([r.beyond for r in top])[order], np.zeros(c.slots)]) + c.base

    # Document frequencies over the whole corpus.
    sent = spark.sparkContext.broadcast(terms)

    def frequency(batches):
        total, rows = np.zeros(len(sent.value) + c.slots, np.int64), 0
        for batch, texts in groups(batches):
            _, at, _ = counts_of(texts, sent.value, c.slots)
            total += np.bincount(at, minlength=len(total))
            rows += len(texts)
        at = np.flatnonzero(total)
        yield {"at": np.concatenate([[-1], at]), "n": np.concatenate([[rows], total[at]])}

    df = map_arrow(docs.select("text"), frequency, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    at, n = df.column("at").to_numpy(), df.column("n").to_numpy()
    frequent = np.zeros(len(weight))
    frequent[at[at >= 0]] = n[at >= 0]
    idf = np.log((1 + n[at < 0].sum()) / (1 + frequent)) + 1
    model = Model(terms, idf * weight, None, np.zeros(0, np.int64), np.zeros(0, np.int64), 0.0, 0.0, c)

    def vectors(batches):
        for batch, texts in groups(batches):
            doc, at, n = counts_of(texts, sent.value, c.slots)
            split = np.searchsorted(doc, np.arange(len(texts) + 1))
            yield {"doc_id": batch.column("doc_id")} | {k: [x[s:e].astype("<i4").tobytes() for s, e in zip(split[:-1], split[1:])] for k, x in (("at", at), ("n", n))}

    made, empty = [], []
    coded = map_arrow(examples.select("doc_id", "text"), vectors, "doc_id long, at binary, n binary").toArrow()  # at most c.examples
    for doc_id, at, n in zip(coded.column("doc_id").to_pylist(), coded.column("at"), coded.column("n")):
        if len(at.as_buffer()):
            at = np.frombuffer(at.as_buffer(), "<i4")
            w = model.vector(at, np.frombuffer(n.as_buffer(), "<i4"))
            made.append((int(at[np.argmax(w)]), doc_id, at, w))
        else:
            empty.append(label[doc_id])
    made.sort(key=lambda x: x[:2])
    model.ids = np.array([m[1] for m in made], np.int64)
    model.toxic = np.array([label[m[1]] for m in made], np.int64)
    model.index = Index([(m[2], m[3]) for m in made], len(weight), c.block, c.dense)
    del made, coded
    give_back()

    # The examples' votes without their own, in tasks like the scores.
    ready = spark.sparkContext.broadcast(model)

    def voted(batches):
        for batch, texts in groups(batches):
            near = _nearest(ready.value, texts, batch.column("doc_id").to_pylist())
            yield {"doc_id": batch.column("doc_id"), "vote": [ready.value.vote(x) for x in near]}

    votes = {r.doc_id: r.vote for r in map_arrow(examples.select("doc_id", "text"), voted, "doc_id long, vote double").collect()}  # at most c.examples
    x = [votes[i] for i in model.ids.tolist()] + [0.0] * len(empty)
    model.slope, model.offset = _logistic(np.array(x), np.concatenate([model.toxic, np.array(empty, np.int64)]))
    return model


NEIGHBOURS = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))


def _nearest(m: Model, texts: list[bytes], but: list[int] | None = None) -> list[list[tuple[float, int]]]:
    """Each text's nearest examples, without that of a doc_id in ``but``."""
    near = [[] for _ in texts]
    if m.index is not None:
        own = {int(i): k for k, i in enumerate(m.ids)} if but else {}
        doc, at, count = counts_of(texts, m.terms, m.config.slots)
        split = np.searchsorted(doc, np.arange(len(texts) + 1))
        filled = np.flatnonzero(np.diff(split))
        for a in range(0, len(filled), 64):
            some = filled[a : a + 64].tolist()
            queries = [(at[x], m.vector(at[x], count[x])) for x in (slice(split[i], split[i + 1]) for i in some)]
            for i, (places, weights), head in zip(some, queries, m.index.heads(queries)):
                near[i] = m.index.nearest(places, weights, m.config.neighbours, own.get(but[i], -1) if but else -1, head)
    return near


def _scored(m: Model, texts: list[bytes]) -> tuple[np.ndarray, list[list[dict]]]:
    near = _nearest(m, texts)
    value = np.array([m.probability(m.vote(x)) for x in near])
    return value, [[{"doc_id": int(m.ids[j]), "similarity": s, "toxic": int(m.toxic[j])} for s, j in x] for x in near]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted and the neighbours (example's doc_id, similarity, label) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch, texts in groups(batches):
            value, near = _scored(sent.value, texts)
            yield {"doc_id": batch.column("doc_id"), "score": value, "predicted": (value >= 0.5).astype(np.int32), "neighbours": pa.array(near, NEIGHBOURS)}

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, score double, predicted int, neighbours array<struct<doc_id: long, similarity: double, toxic: int>>")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that aren't predicted toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch, texts in groups(batches):
            value, _ = _scored(sent.value, texts)
            yield batch.filter(pa.array(value < 0.5))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """True for rows that labels are never learnt from (one in five, by the CRC of the id as text)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
