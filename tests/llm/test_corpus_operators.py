"""Operators 1, 4, 5 and 6 and the pipeline against plain versions."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tests.conftest import SF_MID, SF_SMALL
from watchtally.llm import decontaminate, jaccard, packing, queries, repeats, secrets, toxicity

from . import brute
from .test_text_operators import docs_of

NONE = 10**9  # a null doc_id, larger than all others


def near_copies(seed=5):
    """Groups of copies and near copies of all kinds, chains, tiny sets and common passages."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(60)]
    rows, i = [], 0
    for base in range(30):
        text = [word() for _ in range(rng.choice([3, 5, 6, 9, 14, 40, 120]))]
        if base % 3 == 0:
            text = text[: len(text) // 2] + passage + text[len(text) // 2:]
        for _ in range(rng.choice([1, 2, 5, 12])):
            rows.append((i, " ".join(text).upper() if rng.random() < 0.1 else " ".join(text)))
            i += 1
            if rng.random() < 0.7:  # chains: each a little further from the first
                k = rng.randrange(len(text))
                text = text[:k] + [word()] + text[k + 1:]
    rng.shuffle(rows)
    return rows


# --- 1 ---

def check_repeats(spark, rows, **config):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = repeats.remove_repeats(df, repeats.RepeatConfig(**config)).collect()
    want = brute.repeats([(NONE if i is None else i, t) for i, t in rows])
    assert {NONE if r.doc_id is None else r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want and len(got) == len(rows)
    return got


def test_repeats(spark, edge_rows):
    check_repeats(spark, docs_of(spark)[1], shard_bytes=100_000)
    check_repeats(spark, edge_rows, shard_bytes=20_000)
    check_repeats(spark, near_copies(), shard_bytes=3_000)


def test_repeats_of_periodic_texts(spark):
    rows = [(5, "ab" * 400), (3, "ba" * 300 + "x"), (1, "x" * 49), (2, "x" * 50), (4, "x" * 200), (9, "é" * 100), (8, "é" * 25), (7, "q" + "é" * 26)]
    check_repeats(spark, rows, shard_bytes=300)


def test_repeats_of_hot_keys(spark, monkeypatch):
    """A phrase shorter than the span in ever different surroundings fills no bucket; repeated strings around it are found."""
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    phrase, ends = letters(45), [letters(30) for _ in range(40)]
    rows = [(i, letters(60) + phrase + (rng.choice(ends) if i % 3 == 0 else "") + letters(60)) for i in range(1500)]
    rows += [(None, rows[7][1]), (2000, "x" + rows[9][1]), (2001, (phrase + ends[0]) * 3)]
    rng.shuffle(rows)
    grouped = type(spark.range(1).groupBy("id"))
    plain = grouped.applyInArrow

    def limited(self, f, schema):
        if f.__name__ != "merge":
            return plain(self, f, schema)

        def merge(part):
            assert sum(map(len, part.column("data").to_pylist())) < 60_000
            return f(part)

        return plain(self, merge, schema)

    monkeypatch.setattr(grouped, "applyInArrow", limited)
    got = check_repeats(spark, rows, shard_bytes=5_000, hot=100)
    assert sum(r.n_removed > 0 for r in got) > 400
    monkeypatch.undo()
    check_repeats(spark, near_copies(), shard_bytes=3_000, hot=3)


def test_repeats_extra_columns_and_empty(spark, edge_docs, empty_docs):
    assert repeats.remove_repeats(edge_docs).count() == edge_docs.count()
    assert repeats.remove_repeats(empty_docs).count() == 0


def test_merge_of_transforms_equals_sorting():
    rng = np.random.default_rng(0)
    c = repeats.RepeatConfig(span=8, gram=3)
    blocks = []
    for _ in range(5):
        run = rng.integers(1, 6, 7)
        blocks.append((rng.integers(97, 99, int((run + 7).sum()), dtype=np.uint8).tobytes(), run, rng.integers(0, 9, 7)))
    got = repeats.first_places(blocks, c)
    least = {}
    for raw, run, doc in blocks:
        at = 0
        for r, d in zip(run, doc):
            for p in range(r):
                least[raw[at + p:at + p + 8]] = min(d, least.get(raw[at + p:at + p + 8], 99))
            at += r + 7
    for (raw, run, doc), bits in zip(blocks, got):
        at = 0
        for r, d, b in zip(run, doc, bits.tolist()):
            assert [bool(b >> p & 1) for p in range(r)] == [bool(least[raw[at + p:at + p + 8]] < d) for p in range(r)]
            at += r + 7


# --- 6 ---

@pytest.mark.parametrize("boundary", [None, 0, 30, 10_000])
def test_jaccard_components(spark, boundary):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df, jaccard.JoinConfig(boundary=boundary, salted_list=4)).collect()}
    assert got == brute.components(rows)


def test_jaccard_edges(spark, edge_docs, edge_rows, empty_docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(edge_docs).collect()}
    want = brute.components([(i, t) for i, t in edge_rows if i is not None])
    assert {i: x for i, x in got.items() if i is not None} == want and got[None][1] is None
    assert jaccard.join(empty_docs).count() == 0


def test_jaccard_query(spark):
    rows = docs_of(spark, SF_MID)[1]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op6_jaccard_join(spark, SF_MID).collect()}
    assert got == brute.components(rows)


def test_boundary_has_least_cost():
    c = jaccard.JoinConfig()
    sizes = {5: 100, 8: 50, 20: 40, 100: 10}

    def cost(x, lists):
        spare = lambda n: n - -(-8 * n // 10)
        light = sum(k * min(spare(n) + 2, n) * (min(spare(n) + 2, n) - 1) / 2 for n, k in sizes.items() if n <= x)
        return light + sum(k * (spare(n) + 1) * lists for n, k in sizes.items() if n >= -(-8 * (x + 1) // 10))

    for lists in (1.0, 3.0, 50.0):
        assert cost(jaccard.choose_boundary(sizes, lists, c), lists) == min(cost(x, lists) for x in (0, 5, 8, 20, 100))


# --- 5 ---

def contained(docs, items):
    def shingles(t):
        w = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = {i: shingles(t) for i, t in items}
    out = set()
    for d, t in docs:
        own = shingles(t)
        out |= {(d, i, len(s & own)) for i, s in sets.items() if s and 100 * len(s & own) >= 80 * len(s)}
    return out


def test_containment(spark):
    rows = docs_of(spark)[1]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rng = random.Random(4)
    for k, (_, t) in enumerate(items):  # damaged passages inside longer texts
        w = t.split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = "zzz"
        rows.append((10_000 + k, "Before it. " * 50 + " ".join(w).upper() + "! After it." * 300))
    odd = [(900, None), (901, ""), (902, "one two"), (903, "Before it"), (903, "it before")]
    df = spark.createDataFrame(rows + [(20_000, None), (20_001, ""), (20_002, "One, two!"), (None, items[0][1])], "doc_id long, text string").repartition(3)
    it = spark.createDataFrame([(*x, "s", 1) for x in items + odd + items[:2]], "item_id long, text string, shingle string, n int")
    got = [(r.doc_id, r.item_id, r.n_common) for r in decontaminate.search(df, it).collect()]
    assert len(got) == len(set(got))
    want = contained(rows + [(20_002, "One, two!"), (None, items[0][1])], items + odd)
    assert set(got) == want and len(want) > 10
    left = {r.doc_id for r in decontaminate.clean(df, it).collect()}
    assert left == {d for d, _ in rows} | {20_000, 20_001} - {d for d, _, _ in want} - {None} or left == ({d for d, _ in rows} | {20_000, 20_001, 20_002, None}) - {d for d, _, _ in want}
    assert decontaminate.search(df, it.where("false")).count() == decontaminate.search(df.where("false"), it).count() == 0


# --- 4 ---

@pytest.mark.parametrize("dense", [0, 7, 40])
def test_block_max_search_is_exact(dense):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(300):
        t = np.sort(rng.choice(40, rng.integers(1, 8), replace=False))
        w = rng.random(len(t))
        rows.append((t, w / np.sqrt((w * w).sum())))
    index = toxicity.Index(rows, 40, 16, dense)
    full = np.zeros((300, 40))
    for i, (t, w) in enumerate(rows):
        full[i, t] = w
    for t, w in rows[:100]:
        q = np.zeros(40)
        q[t] = w
        s = np.round(full @ q, 9)
        want = sorted((-x, i) for i, x in enumerate(s) if x > 0)[:9]
        got = index.nearest(t, w, 9)
        assert [i for _, i in got] == [i for _, i in want] and np.allclose([x for x, _ in got], [-x for x, _ in want])


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op4_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic = [r.predicted for r in got if r.toxic]
    fine = [r.predicted for r in got if not r.toxic]
    assert np.mean(toxic) >= 0.9 and np.mean(fine) < 0.01
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    for lang in ("en", "fr", "de", "es"):
        assert np.mean([r.predicted for r in got if r.toxic and langs[r.doc_id] == lang]) >= 0.85, lang
    brier = np.mean([(r.score - r.toxic) ** 2 for r in got])
    assert brier < 0.04 and all(0 <= r.score <= 1 for r in got)


def test_toxicity_edges(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(4, 0, "x"), (7, 0, "x"), (9, 1, "x"), (None, 1, "x"), (3, None, "x")], "doc_id long, toxic int, text string")
    for d, lab in ((edge_docs, labels), (edge_docs, labels.where("false")), (edge_docs, labels.where("toxic = 1")), (empty_docs, labels)):
        out = toxicity.score(d, toxicity.fit(d, lab)).collect()
        assert len(out) == d.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    model = toxicity.fit(edge_docs, labels)
    assert toxicity.keep_clean(edge_docs, model).columns == edge_docs.columns


def test_toxicity_vectors_and_votes():
    """Vectors hold every word; weights, cosine, votes and scores against a plain version."""
    from collections import Counter
    import re
    texts = ["alpha beta beta gamma", "beta delta", "", "alpha alpha alpha", "zeta eta theta", "Gamma, delta. zeta"]
    slots, n = 1 << 15, len(texts)
    raw = [t.encode() for t in texts]
    doc, place, count = toxicity.counts_of(raw, np.zeros(0, np.uint64), slots)
    slot = {}
    for t in sorted({w for x in texts for w in re.findall("[a-z]+", x.lower())}):
        slot[t] = int(toxicity.counts_of([t.encode()], np.zeros(0, np.uint64), slots)[1][0])
    assert len(set(slot.values())) == len(slot)
    counted = [Counter(re.findall("[a-z]+", t.lower())) for t in texts]
    assert [(d, p, c) for d, p, c in zip(doc.tolist(), place.tolist(), count.tolist())] == sorted((i, slot[w], c) for i, cs in enumerate(counted) for w, c in cs.items())
    factor = np.random.default_rng(0).random(slots) + 0.5
    m = toxicity.Model(np.zeros(0, np.uint64), factor, None, np.arange(4) * 10, np.array([1, 0, 0, 1]), 1.5, -0.25, toxicity.ToxicityConfig(slots=slots, neighbours=2))

    def vector(cs):
        v = {w: (1 + np.log(c)) * factor[slot[w]] for w, c in cs.items()}
        size = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    examples = [0, 1, 3, 4]
    m.index = toxicity.Index([(place[doc == i], m.vector(place[doc == i], count[doc == i])) for i in examples], slots, 2)
    value, near = toxicity._scored(m, raw)
    for i, cs in enumerate(counted):
        v = vector(cs) if cs else {}
        sims = sorted((-round(sum(x * vector(counted[j]).get(w, 0) for w, x in v.items()), 9), k) for k, j in enumerate(examples))
        want = [(k, -s) for s, k in sims if s < 0][:2]
        assert [(int(x["doc_id"] / 10), round(x["similarity"], 9)) for x in near[i]] == want
        vote = sum(s if m.toxic[k] else -s for k, s in want)
        assert abs(value[i] - 1 / (1 + np.exp(-(1.5 * vote - 0.25)))) < 1e-6


# --- pipeline ---

def test_pipeline(spark):
    docs, rows = docs_of(spark, SF_MID)
    model = queries.toxicity_model(spark, docs, SF_MID)
    toxic = {r.doc_id for r in toxicity.score(docs, model).collect() if r.predicted}
    rows = [(i, t) for i, t in rows if i not in toxic]
    groups = brute.components(rows)
    rows = [(i, t) for i, t in rows if groups[i][0] == 0 or groups[i][1] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    bad = {d for d, _, _ in contained(rows, items)}
    assert bad
    rows = [(i, secrets.redact(t, secrets.find(t))) for i, t in rows if i not in bad]
    got = corpus_pipeline.run(spark, SF_MID).collect()
    assert {r.doc_id for r in got} == {i for i, _ in rows}
    from watchtally.llm.tokens import byte_encoder
    e = byte_encoder(queries.tokenizer_path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    for i, t in rows:
        ids = e.tokenizer.encode(t, add_special_tokens=False).ids + [2]
        want = [(s, n, brute.crc(ids[s:s + n])) for s, n in packing.cut_points(len(ids), 1024)]
        assert sorted((r.start, r.length, r.ids_crc32) for r in pieces[i]) == want
    room = Counter()
    for r in got:
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 1024 and sum(room.values()) > 0.99 * 1024 * (len(room) - 2)


def test_near_copies_of_null_and_repeated_ids(spark):
    """Of linked rows one stays, whatever their ids; unrelated rows of the same id, null or not, stay."""
    a, b, c, d, e = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcde")
    near = lambda t: t + " more"
    rows = [(1, a), (None, near(a)), (None, b), (None, near(b)), (None, b.upper()), (None, c), (2, d), (2, near(a)), (None, e), (3, e), (3, near(e)), (4, ""), (None, ""), (None, None)]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, _n int").repartition(3)
    out = corpus_pipeline.drop_near_copies(spark, df, "")
    got = [(r.doc_id, r.text) for r in out.collect()]
    of_b = [x for x in got if x[0] is None and x[1] and x[1].lower().startswith("b0")]
    of_e = [x for x in got if x[1] and x[1].startswith("e0")]
    assert len(of_b) == 1 and len(of_e) == 1 and of_e[0][0] == 3 and out.columns == df.columns
    assert Counter(got) == Counter([(1, a), (None, c), (2, d), (4, ""), (None, ""), (None, None), *of_b, *of_e])


def test_contaminated_rows_of_null_and_repeated_ids(spark):
    """Only rows that hold an item go; other rows of the same id, null or not, stay."""
    item = " ".join(f"i{k}" for k in range(30))
    rows = [(None, f"before {item} after"), (None, "some other words that are clean here"), (None, None), (None, ""), (7, item), (7, "clean words under the same id as the item"), (8, item.upper()), (9, "clean")]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, _n int").repartition(3)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = decontaminate.clean(df, items)
    assert sorted(r._n for r in out.collect()) == [1, 2, 3, 5, 7] and out.columns == df.columns


def test_pipeline_stages_on_edges(spark, edge_docs, tmp_path):
    """Every stage takes nulls, empty and long texts, repeated rows, extra columns and empty tables."""
    both = edge_docs.unionByName(edge_docs.limit(4))
    spark.read.parquet(f"{SF_SMALL}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    for k, docs in enumerate((both, both.where("false"))):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            path = str(tmp_path / f"{name}-{k}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count()
