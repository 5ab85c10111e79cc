"""Registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontaminate, html, jaccard, packing, quality, repeats, secrets, sentencepieces, tokenfile, toxicity, vectorcodes, warc
from .common import map_arrow, read_table

END_ID = 2


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), END_ID, 1024)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read_table(spark, sf_dir, "pages"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    labels = read_table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    return toxicity.fit(docs, labels)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    evidence = F.transform(F.slice("neighbours", 1, 5), lambda x: x["doc_id"])
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", evidence.alias("evidence"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_common", "containment")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality.score(docs, quality.fit(docs, trusted))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    index = warc.write_index(warc.write_archives(pages))
    return warc.read_records(warc.lookup_all(index, pages))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return tokenfile.read_tokens(tokenfile.write_tokens(docs, tokenizer_path("word_bpe_49k.json"), END_ID))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    ledger = secrets.append_to_ledger(docs, secrets.corpus_ledger(spark, sf_dir))
    found = secrets.findings(docs, ledger)

    def digest(batches):
        import hashlib

        for batch in batches:
            spans = batch.column("spans").to_pylist()
            parsed = [secrets.parse(x) for x in spans]
            base = [secrets.joined([x for x in p if x[2] in secrets.BASE]) for p in parsed]
            yield {"doc_id": batch.column("doc_id"), "spans": spans, "base_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in base]} | {
                f"n_{k}": [sum(x[2] == k for x in p) for p in parsed] for k in secrets.BASE}

    return map_arrow(found, digest, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(read_table(spark, sf_dir, "embeddings")).drop("label")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    coded = sentencepieces.encode(read_table(spark, sf_dir, "documents"), model, decoded=True)
    decimal = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"), "agrees")


QUERIES = {f.__name__: f for f in (
    op1_suffix_array_dedup, op2_best_fit_packing, op3_html_extraction, op4_toxicity, op5_decontamination, op6_jaccard_join, op7_quality_rules, op8_warc, op9_token_ids, op10_secret_scans, op11_collocations, op12_vector_codes, op13_sentencepiece)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _shingles(table: str, key: str) -> str:
    """SQL for the distinct shingles of a table, as in operator 5."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+')"
    return f"""
        SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
                                           WHEN len(w) > 0 THEN [concat('<', array_to_string(w, ' '))] ELSE [] END) AS s
        FROM (SELECT {key}, {words} AS w FROM {table})"""


def _codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """SQL for operator 12: every distance of every part, round by round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS (SELECT p.vec_id, p.part, min(list_sum(list_transform(list_zip(p.x, e.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * {entries} + e.entry) AS m
                 FROM p JOIN e{i} AS e USING (part) GROUP BY ALL)""")
        if i < rounds:
            steps.append(f"""
        s{i} AS (SELECT part, entry, i, sum(v)::HUGEINT AS s, count(*) AS c
                 FROM (SELECT a{i}.part, m % {entries} AS entry, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS v FROM a{i} JOIN p USING (vec_id, part)) GROUP BY ALL),
        m{i} AS (SELECT part, entry, list(cast((s - ((s % c) + c) % c) // c AS BIGINT) ORDER BY i) AS x FROM s{i} GROUP BY ALL),
        e{i + 1} AS (SELECT e.part, e.entry, coalesce(m{i}.x, e.x) AS x FROM e{i} AS e LEFT JOIN m{i} USING (part, entry))""")
    return f"""
        WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * x::DOUBLE) AS BIGINT)) AS q FROM embeddings
                   WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (SELECT vec_id, part, q[part * len(q) // {parts} + 1:(part + 1) * len(q) // {parts}] AS x FROM v, range({parts}) AS t(part)),
        e0 AS (SELECT part, r - 1 AS entry, x FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r FROM v QUALIFY r <= {entries}) USING (vec_id)),{",".join(steps)},
        c AS (SELECT vec_id, string_agg(printf('%02x', m % {entries}), '' ORDER BY part) AS code, cast(sum(m // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
        h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM e{rounds})
        SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c JOIN v USING (vec_id), h"""


#: DuckDB SQL where SQL can express a whole result. The other operators' results depend on
#: tokenizers, fitted models, layout, added rules or components and are tested against plain versions.
ORACLE_SQL: dict[str, str] = {
    "op5_decontamination": f"""
        WITH d AS ({_shingles('documents', 'doc_id')}), i AS ({_shingles('benchmark', 'item_id')}),
        n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id)
        SELECT doc_id, item_id, n_shingles, count(*) AS n_common, round(count(*) / n_shingles, 6) AS containment
        FROM d JOIN i USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_shingles
        HAVING 100 * count(*) >= 80 * n_shingles""",
    "op8_warc": """
        WITH p AS (SELECT page_id, coalesce(url, '') AS url, cast(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                          sha256(coalesce(html, '')) AS payload_digest FROM pages),
        g AS (SELECT payload_digest, min(page_id) AS smallest FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, url, payload_bytes, payload_digest,
               CASE WHEN smallest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN smallest <> page_id THEN smallest END AS refers_to
        FROM p LEFT JOIN g USING (payload_digest)""",
    "op12_vector_codes": _codes(),
    "op11_collocations": f"""
        WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
                   FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
        g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, cast(count(*) AS BIGINT) AS f
              FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p), (SELECT unnest([1, 2, 3]) AS k)
              WHERE i + k - 1 <= len(w) GROUP BY ALL),
        n AS (SELECT lang, cast(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND f >= 10),
        inside AS (SELECT DISTINCT c.lang, c.phrase
                   FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM c WHERE k = 3) AS o
                   JOIN c ON c.lang = o.lang AND c.phrase = o.part WHERE 100 * o.a >= 50 * c.a),
        s AS (SELECT o.lang, o.phrase, o.a, o.cut, x.f AS l, y.f AS r, cast((1000000::HUGEINT * o.a * o.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
              FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) AS o
              JOIN g AS x ON x.lang = o.lang AND x.phrase = array_to_string(o.w[1:o.cut], ' ')
              JOIN g AS y ON y.lang = o.lang AND y.phrase = array_to_string(o.w[o.cut + 1:], ' ')),
        b AS (SELECT * FROM s ANTI JOIN inside USING (lang, phrase) QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM b JOIN n USING (lang) QUALIFY rank <= 2000""",
}
