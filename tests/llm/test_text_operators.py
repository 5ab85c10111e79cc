"""Operators 2, 7, 9 and 10 against plain versions."""

import sys

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from watchtally.llm import packing, quality, queries, secrets, tokenfile
from watchtally.llm.tokens import byte_encoder, word_encoder

from . import brute


def docs_of(spark, sf=SF_SMALL):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name,make", [("byte_bpe_50k.json", byte_encoder), ("word_bpe_49k.json", word_encoder)])
def test_encoder_equals_tokenizer(spark, edge_rows, name, make, monkeypatch):
    from watchtally.llm import tokens

    odd = ["a \n b", "a\n\nb  c ", "it's don't", "\x1c a \x85 b", " x 　y", "é é ́a", "ΑΣ ΟΔΟΣ x", "İI", "a. b, .. ., é. É, 's.", "x ²."]
    texts = [t or "" for _, t in [*edge_rows, *docs_of(spark)[1]]] + odd
    e = make(queries.tokenizer_path(name))
    want = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in e.encode(texts)] == want
    monkeypatch.setattr(tokens, "MOST_CHUNKS", 10)  # memory full
    assert [x.tolist() for x in e.encode(texts[::-1])] == want[::-1]


def test_quality_base_counts(spark, edge_docs, edge_rows, empty_docs):
    df, rows = docs_of(spark)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    ratio = np.zeros(1 << 16, np.float32)
    for d, want in ((df, rows), (edge_docs, edge_rows)):
        got = {r.doc_id: tuple(r[c] for c in cols) for r in quality.score(d, ratio).collect()}
        assert got == {i: brute.quality(t) for i, t in want}
    assert quality.score(empty_docs, ratio).count() == 0


def test_quality_verdict(spark):
    """Trusted prose is kept, junk marked as bad is not; verdicts don't depend on partitions."""
    got = queries.op7_quality_rules(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.join(labels, "doc_id").select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_quality_without_trusted(edge_docs, empty_docs):
    assert not quality.fit(edge_docs, empty_docs).any()
    assert quality.fit(empty_docs, empty_docs).shape == (1 << 16,)


def test_secrets_base(spark, edge_docs, edge_rows, empty_docs):
    df, rows = docs_of(spark, "/root/testdata/sf0.01")
    for d, want in ((df, rows), (edge_docs, edge_rows)):
        got = {r.doc_id: r.spans for r in secrets.findings(d, secrets.update_ledger(d)).collect()}
        assert len(got) == len(want)
        for i, t in want:
            base = [x for x in secrets.parse(got[i]) if x[2] in secrets.BASE]
            import hashlib
            assert hashlib.sha256(secrets.joined(base).encode()).hexdigest() == brute.base_secrets(t)[1]
    assert secrets.findings(empty_docs, secrets.update_ledger(empty_docs)).count() == 0


def test_secret_ledger_is_incremental(spark, edge_docs):
    first = edge_docs.where("doc_id <= 8")
    ledger = secrets.update_ledger(first)
    new = secrets.scan_unseen(edge_docs, ledger)
    seen = {r.blob for r in ledger.collect()}
    assert seen and not seen & {r.blob for r in new.collect()}
    grown = secrets.update_ledger(edge_docs, ledger)
    assert sorted(map(tuple, secrets.findings(edge_docs, grown).collect()), key=str) == \
        sorted(map(tuple, secrets.findings(edge_docs, secrets.update_ledger(edge_docs)).collect()), key=str)
    assert secrets.scan_unseen(edge_docs, grown).count() == 0


def test_secret_added_rules_and_redaction():
    text = "see https://bob:hunter22@host/x and ghp_" + "a1" * 20 + " token: abcdefabcdefabcdef99"
    spans = secrets.find(text)
    assert [k for _, _, k in spans] == ["url_login", "git_token", "assign", "hex"] or {k for _, _, k in spans} >= {"url_login", "git_token", "assign"}
    clean = secrets.redact(text, spans)
    assert "hunter22" not in clean and "abcdef99" not in clean and clean.startswith("see [URL_LOGIN]")
    assert secrets.find("plain words, nothing to hide: tokens are fine") == []


def test_token_files(spark, edge_docs, edge_rows, empty_docs):
    path = queries.tokenizer_path("word_bpe_49k.json")
    e = word_encoder(path)
    df, rows = docs_of(spark)
    for d, want in ((df, rows), (edge_docs, edge_rows)):
        got = {r.doc_id: r for r in tokenfile.read_tokens(tokenfile.write_tokens(d, path, 2, rows_each=5), with_ids=True).collect()}
        at = 0
        for i, t in sorted(want, key=lambda r: (r[0] is not None, r[0] or 0)):
            ids = e.tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
            assert (got[i].start, got[i].n_tokens, got[i].ids_crc32, got[i].ids) == (at, len(ids), brute.crc(ids), ids)
            at += len(ids)
    assert tokenfile.read_tokens(tokenfile.write_tokens(empty_docs, path, 2)).count() == 0


def test_packing(spark, edge_docs, edge_rows, empty_docs):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    e = byte_encoder(path)
    df, rows = docs_of(spark, "/root/testdata/sf0.01")
    for d, want in ((df, rows), (edge_docs, edge_rows)):
        out = packing.pack(d, path, 2, with_ids=True)
        got = out.collect()
        total = 0
        for i, t in want:
            ids = e.tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
            own = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
            assert [r.piece for r in own] == [*range(len(own))] and len(own) == -(-len(ids) // 1024)
            assert sum((r.ids for r in own), []) == ids and all(r.ids_crc32 == brute.crc(r.ids) and r.length == len(r.ids) for r in own)
            assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
            total += len(ids)
        by = {}
        for r in got:
            by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for s in by.values():
            at = 0
            for o, n in sorted(s):
                assert o == at
                at += n
            assert at <= 1024
        assert len(by) <= -(-total // 1024) + 1 or len(by) <= 1.02 * total / 1024
        whole = packing.sequences(out).collect()
        assert sorted(map(len, (r.ids for r in whole))) == sorted(sum(n for _, n in s) for s in by.values())
    assert packing.pack(empty_docs, path, 2).count() == 0


def test_fullest_bin_against_all_subsets():
    rng = np.random.default_rng(1)
    for _ in range(200):
        cap = 20
        counts = np.zeros(cap + 1, np.int64)
        items = rng.integers(1, cap + 1, rng.integers(1, 9))
        np.add.at(counts, items, 1)
        chosen = packing.fullest(counts, cap)
        rest = sorted(items.tolist())
        longest = rest.pop()
        best = max(s for m in range(1 << len(rest)) if (s := sum(x for k, x in enumerate(rest) if m >> k & 1)) <= cap - longest)
        assert chosen[0] == longest and sum(chosen) == longest + best
        assert all(chosen.count(x) <= counts[x] for x in chosen)


def test_reading_tasks_keep_no_encoder(spark, monkeypatch):
    path = queries.tokenizer_path("word_bpe_49k.json")
    manifest = tokenfile.write_tokens(spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string").coalesce(1), path, 2)
    monkeypatch.setattr(tokenfile, "map_arrow", lambda df, run, schema: [*run(df.toArrow().to_batches())])
    word_encoder(path)
    assert [*map(int, tokenfile.read_tokens(manifest)[0]["start"])] == [0, 3] and word_encoder.cache_info().currsize == 0


def test_remembered_chunks_stay_small():
    e = word_encoder(queries.tokenizer_path("word_bpe_49k.json"))
    e.known.clear()
    for a in range(0, 480_000, 30_000):
        e.encode([" ".join(f"x{i:x}y" for i in range(a, a + 30_000))])
    size = sys.getsizeof(e.known) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in e.known.items())
    assert size < 50 << 20 and e.encode(["x5y x33433y"])[0].tolist() == e.plain("x5y x33433y").tolist()
