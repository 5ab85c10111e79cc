"""Operator 11 against a plain version; its query is held against SQL in test_oracle."""

import random
import re
from collections import Counter, defaultdict

import pytest

from watchtally.llm import collocations
from watchtally.llm.collocations import CollocationConfig, mine, segments

SCHEMA = "lang string, text string"


def plain(rows, cfg):
    """The contract, phrase by phrase, with Python's integers; containment in every longer candidate."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, cfg.max_words + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= cfg.min_count}
        inside = {p[i:i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= cfg.inside_pct * c[p[i:i + k]]}
        rows = []
        for p in candidates.keys() - inside:
            score, k = min((cfg.scale * c[p] ** 2 // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -c[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:cfg.top], 1)]
    return sorted(out)


def mined(spark, rows, cfg, parts=3):
    return sorted(map(tuple, mine(spark.createDataFrame(rows, SCHEMA).repartition(parts), cfg).collect()))


def random_rows(n, seed, words="a b c d the The THE é x-y 1,5 日 ß"):
    rng = random.Random(seed)
    seps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ; ", "! "]
    return [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words.split()) + rng.choice(seps) for _ in range(rng.randrange(60)))) for _ in range(n)]


@pytest.mark.parametrize("cfg", [CollocationConfig(), CollocationConfig(max_words=2, min_count=2, top=7), CollocationConfig(max_words=5, min_count=3, inside_pct=80, parts=3), CollocationConfig(min_count=1, salts=2, top=50)])
def test_equals_plain(spark, cfg):
    rows = random_rows(120, 3)
    assert mined(spark, rows, cfg) == plain(rows, cfg)


def test_small_blocks(spark):
    """Long texts are cut into segments that borrow words; results don't depend on blocks or partitions."""
    rows = [("en", " ".join(random.Random(i).choices("a b c d e".split(), k=3000)) + (". " if i % 2 else "")) for i in range(4)] + [("en", "w" * 5000 + " a b"), ("en", "a\t " * 400)] * 2
    want = plain(rows, CollocationConfig())
    for size in (64, 1000, 1 << 20):
        assert mined(spark, rows, CollocationConfig(block_bytes=size), 2) == want


@pytest.mark.parametrize("most", [1, 5, 17])
def test_segments_keep_every_phrase_once(most):
    rng = random.Random(most)
    for _ in range(50):
        text = "".join(rng.choice("ab  \t.,\n") for _ in range(rng.randrange(120))).encode()

        def phrases(data, own):
            found, at = [], 0
            for piece in re.split(rb"[.,;:!?\x0a-\x0d]", data):
                w = [(m.start() + at, m[0]) for m in re.finditer(rb"[^\x20\x09]+", piece)]
                found += [tuple(x for _, x in w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1) if w[i][0] < own]
                at += len(piece) + 1
            return found

        cut = [p for data, own in segments(text, most, 2) for p in phrases(data, own)]
        assert sorted(cut) == sorted(phrases(text, len(text)))


def test_edges(spark, edge_docs, edge_rows, empty_docs):
    """Null and empty texts, repeated rows, very long texts, extra columns; an empty table and a table without phrases."""
    cfg = CollocationConfig(min_count=3)
    assert sorted(map(tuple, mine(edge_docs, cfg).collect())) == plain([("en", t) for _, t in edge_rows], cfg)
    got = mine(empty_docs)
    assert got.count() == 0 and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert mined(spark, [(None, None), ("en", ""), ("en", "one two")], CollocationConfig()) == []


def test_scores_pass_64_bits(spark):
    """Counts of millions: the product is beyond 64 bits, the quotient exact."""
    from decimal import Decimal

    a, l, r = 3_999_999_937, 4_000_000_007, 4_100_000_011
    level = spark.createDataFrame([("en", "x y", a, [l, a], [r, a])], "lang string, phrase string, f long, heads array<long>, tails array<long>")
    got = collocations._scored(level, 2, CollocationConfig()).first()
    assert (got.a, got.l, got.r, got.score) == (a, l, r, 10 ** 6 * a * a // (l * r)) and Decimal(10 ** 6 * a * a) > 2 ** 64


def test_hot_word_is_one_row_a_block(spark):
    """A word that is most of the corpus reaches the shuffle once for each block, and nothing temporary stays."""
    docs = spark.createDataFrame([("en", "hot " * 5000)] * 6, SCHEMA).repartition(3)
    relation = collocations.occurrences(docs, CollocationConfig())
    rows = relation.selectExpr("block", "explode(word) AS word").collect()
    assert len(rows) == 3 and len({r.block for r in rows}) == 3
    before = {t.name for t in spark.catalog.listTables()}
    assert [r.phrase for r in mine(docs).collect()] == ["hot hot hot"]
    assert {t.name for t in spark.catalog.listTables()} == before


def test_relations_are_not_shuffled_again(spark):
    """The bucketed relation meets the frequent groups by block without an exchange of its own."""
    cfg = CollocationConfig(min_count=2)
    own = collocations.Relations(spark)
    relation = own.bucketed(collocations.occurrences(spark.createDataFrame(random_rows(30, 1), SCHEMA), cfg), "words")
    found = own.plain(collocations.frequent_words(relation, cfg), "found")
    plan = collocations.extend(relation, found, cfg)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    own.forget()
