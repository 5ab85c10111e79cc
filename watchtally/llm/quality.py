"""Operator 7: quality rules.

Two parts. Base rules: counts of every whole text. Method: each document's
hashed word 1- and 2-grams are scored by the log-likelihood ratio between two
multinomials, one of trusted target documents and one of the raw corpus
(Dirichlet-smoothed over a fixed number of buckets), divided by the number of
n-grams; a document is kept when the score reaches a fixed threshold, so the
same document with the same model always gets the same verdict.

The raw multinomial counts all documents; the target counts a bounded sample of
trusted documents (``max_target``, lowest hash of doc_id first), because it is the
fitted side. Both are vectors of ``2 ** bits`` counts: each task adds its own,
Spark sums them, and only the fixed-size result reaches the driver.

Defined cases: null or empty text has no words, fails the base rules, score 0;
repeated rows are scored each; extra columns are ignored; an empty table gives no
rows; without trusted documents the ratio is 0 everywhere and only the base rules
and the threshold (0 >= threshold) decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, U64, Words, groups, map_arrow, mix

SYMBOL = np.zeros(256, bool)
SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


@dataclass(frozen=True)
class QualityConfig:
    bits: int = 16
    max_target: int = 20_000
    prior: float = 1.0
    #: Mean log-likelihood ratio (nats per n-gram) that a kept document reaches.
    threshold: float = -0.13
    min_words: int = 20
    max_repeat_pct: int = 30
    window: int = 8


def _per_text(n: int, at: np.ndarray) -> np.ndarray:
    return np.bincount(at, minlength=n)[:n]


def _repeats(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True where (doc, h) occurs twice or more."""
    key = mix(h + (doc.astype(np.uint64) + U64(1)) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def base_counts(texts: list[bytes], window: int = 8) -> dict[str, np.ndarray]:
    """Base counts of a group of texts, and their words."""
    n = len(texts)
    w = Words(texts)
    text_of = np.repeat(np.arange(n), np.diff(w.offset))
    space = SPACE[w.buf]
    chars = _per_text(n, text_of[~space & ((w.buf & 0xC0) != 0x80)])
    symbols = _per_text(n, text_of[SYMBOL[w.buf]])

    # Lines end at \n; the end of a text is one in ``buf``.
    ends = np.flatnonzero(w.buf == 10)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    seen = np.concatenate([[0], np.cumsum(~space)])
    worded = seen[ends] > seen[starts]
    starts, ends = starts[worded], ends[worded]
    line_doc, line = text_of[starts], w.pieces.hash(starts, ends)
    key = mix(line + (line_doc.astype(np.uint64) + U64(1)) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    later = order[1:][np.diff(key[order]) == 0]
    dup_lines = _per_text(n, line_doc[later])

    at, h = w.windows(window)
    at = at[_repeats(w.doc[at], h)]
    cover = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, np.minimum(at + window, len(w.hash)), -1)
    repeat = _per_text(n, w.doc[np.flatnonzero(np.cumsum(cover)[:-1] > 0)])
    return {"n_words": np.diff(w.first), "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": repeat, "words": w}


def _grams(w: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every hashed word 1- and 2-gram."""
    at, two = w.windows(2)
    shift = U64(64 - bits)
    return np.concatenate([w.doc, w.doc[at]]), (np.concatenate([w.hash, two]) >> shift).astype(np.int64)


def _counts(df: DataFrame, bits: int) -> np.ndarray:
    def run(batches):
        total = np.zeros(1 << bits, np.int64)
        for _, texts in groups(batches):
            _, b = _grams(Words(texts, lower=True), bits)
            total += np.bincount(b, minlength=len(total))
        at = np.flatnonzero(total)
        yield {"bucket": at, "n": total[at]}

    rows = map_arrow(df.select("text"), run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << bits, np.float64)
    for b, n in rows.collect():  # at most 2 ** bits rows, whatever the corpus
        out[b] = n
    return out


def fit(docs: DataFrame, trusted: DataFrame, config: QualityConfig = QualityConfig()) -> np.ndarray:
    """Log-likelihood ratio of every bucket; ``trusted`` has the doc_id of trusted documents."""
    raw = _counts(docs, config.bits)
    ids = (trusted.select("doc_id").where("doc_id is not null").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(config.max_target))
    target = _counts(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi"), config.bits)
    if not target.sum():
        return np.zeros(len(raw), np.float32)
    share = raw + config.prior
    share /= share.sum()
    smooth = target + config.prior * len(raw) * share
    return (np.log(smooth / smooth.sum()) - np.log(share)).astype(np.float32)


def score(docs: DataFrame, ratio: np.ndarray, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Base counts, base verdict, score and verdict of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)  # 4 * 2 ** bits bytes

    def run(batches):
        for batch, texts in groups(batches):
            c = base_counts(texts, config.window)
            n = len(texts)
            doc, bucket = _grams(Words(texts, lower=True), config.bits)
            total = np.bincount(doc, weights=sent.value[bucket].astype(np.float64), minlength=n)
            value = total / np.maximum(np.bincount(doc, minlength=n), 1)
            failed = (c["n_words"] < config.min_words) | (100 * c["n_repeat_words"] > config.max_repeat_pct * c["n_words"])
            yield {k: v for k, v in c.items() if k != "words"} | {
                "doc_id": batch.column("doc_id"), "base_failed": failed, "score": value,
                "kept": ~failed & (np.round(value, 9) >= config.threshold)}

    return map_arrow(docs.select("doc_id", "text"), run,
                     "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                     "base_failed boolean, kept boolean, score double")
