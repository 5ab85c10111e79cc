"""Operator 10: secret scans with an incremental blob ledger.

Every text is content-addressed (SHA-256). The ledger is a table of
(blob, rule_version, spans) in the shared folder. A scan

1. reduces all versions to one narrow row per blob,
2. keeps the blobs that the ledger lacks under this rule version (anti join),
3. scans the text of one carrier of each such blob, appends the findings,
4. joins findings back to every document (path) that carries the blob.

Texts move in one shuffle only, keyed by (doc_id, blob), which no group of
copies can make hot. A corpus's ledger is a folder for each rule version: a later scan
of the grown corpus, also in another session, reads it, scans the new blobs alone and appends
their findings; a new rule version scans all again and leaves the old folder as history.

Every rule is linear in the text, with no upper bound on a secret's length.

Rules: the three base kinds, then the added kinds of ``RULES`` in that order.
Offsets are code points, end exclusive.

Defined cases: null text is the empty text (no findings); null doc_id is kept as a
path of its own; repeated rows are all returned; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchtally.session import job_folder

from .common import map_arrow, shared_root, stored

#: kind, pattern, group that must be long enough, least length. Fixed values; a match with a shorter group is dropped.
RULES = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
    # Header lines (Proc-Type, DEK-Info) may stand before the key.
    ("key_block", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s:,.]|-(?!----))++-----END [A-Z ]*PRIVATE KEY-----"), 0, 64),
    # A run of name characters is looked at from its beginning, and only if the rest follows: linear on any text.
    ("jwt", re.compile(r"(?<![\w-])(?=[A-Za-z0-9_-]++\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8})[A-Za-z0-9_-]*?(?P<span>\beyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++)", re.A), 0, 30),
    ("git_token", re.compile(r"\bgh[opsur]_[A-Za-z0-9]{36,}"), 0, 40),
    ("chat_token", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{20,}"), 0, 25),
    ("url_login", re.compile(r"(?<![a-z0-9+.-])(?=[a-z0-9+.-]++://[^\s:/@]*+:[^\s:/@]{6,}+@)[a-z0-9+.-]*?(?P<span>\b[a-z][a-z0-9+.-]++://[^\s:/@]*+:[^\s:/@]++@)"), 0, 12),
)
#: The same matches found faster: a rule runs only where one of its literals occurs (in the text, or lower-cased for "assign").
NEEDS = {"access": ("AKIA",), "key_block": ("PRIVATE KEY-----",), "jwt": ("eyJ",), "git_token": ("gh",), "chat_token": ("xox",), "url_login": ("://",)}
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORD = re.compile(r"passw(?:or)?d|secret|token|api_?key")
RULE_VERSION = f"r1-{zlib.crc32(repr([(k, p.pattern, g, n) for k, p, g, n in RULES]).encode()):08x}"
BASE = ("assign", "access", "hex")


def find(text: str) -> list[tuple[int, int, str]]:
    """All (start, end, kind) by start, then kind as listed."""
    out = []
    for order, (kind, pattern, group, least) in enumerate(RULES):
        if kind == "hex":
            out += [(m.start(), order, m.end()) for m in LONG_HEX.finditer(text)]
            continue
        if kind == "assign":
            if not KEYWORD.search(text.lower()):
                continue
        elif not any(x in text for x in NEEDS[kind]):
            continue
        own = "span" if "span" in pattern.groupindex else 0
        out += [(m.start(own), order, m.end(own)) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return [(s, e, RULES[o][0]) for s, o, e in sorted(out)]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Each run of overlapping spans is replaced by the kind of its first."""
    out, at = [], 0
    for s, e, kind in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def blobs(docs: DataFrame) -> DataFrame:
    """doc_id, blob of every version."""
    return docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "blob string, rule_version string, spans string")


def _scan(batches):
    for batch, a in ((b, a) for b in batches for a in range(0, b.num_rows, 512)):
        d = batch.slice(a, 512).to_pydict()
        yield {"blob": d["blob"], "rule_version": [RULE_VERSION] * len(d["blob"]), "spans": [joined(find(t or "")) for t in d["text"]]}


def scan_unseen(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    """New ledger rows: findings of every blob that the ledger lacks under the present rules."""
    seen = ledger.where(F.col("rule_version") == RULE_VERSION).select("blob").distinct()
    carriers = blobs(docs).groupBy("blob").agg(F.min("doc_id").alias("doc_id")).join(seen, "blob", "left_anti")
    texts = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"))
    # The merge hint keeps the text side out of a hash table; <=> lets a null doc_id carry a blob.
    c = carriers.select("blob", F.col("doc_id").alias("_id")).hint("merge")
    unseen = texts.join(c, (texts["blob"] == c["blob"]) & texts["doc_id"].eqNullSafe(c["_id"]), "left_semi")
    found = map_arrow(unseen.select("blob", "text"), _scan, "blob string, rule_version string, spans string")
    return found.groupBy("blob", "rule_version").agg(F.max("spans").alias("spans"))  # rows of one doc_id may repeat


def ledger_at(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger kept in a folder (empty before the first scan). A blob that two scans appended at the same time counts once."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return empty_ledger(spark)
    return spark.read.schema(empty_ledger(spark).schema).parquet(folder).dropDuplicates(["blob", "rule_version"])


def corpus_ledger(spark: SparkSession, corpus: str) -> str:
    """The folder of a corpus's ledger under the present rules, the same in every session that names the same shared folder."""
    shared_root(spark)
    return job_folder(spark, f"secret-ledger/{hashlib.sha256(corpus.encode()).hexdigest()[:16]}/{RULE_VERSION}")


def append_to_ledger(docs: DataFrame, folder: str) -> DataFrame:
    """Scan what the folder's ledger lacks, append the findings, return the whole ledger."""
    spark = docs.sparkSession
    scan_unseen(docs, ledger_at(spark, folder)).write.mode("append").parquet(folder)
    return ledger_at(spark, folder)


def update_ledger(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """The ledger after a scan, in a table of its own; ``append_to_ledger`` keeps one folder."""
    spark = docs.sparkSession
    old = empty_ledger(spark) if ledger is None else ledger
    new = stored(scan_unseen(docs, old), "secret-ledger")
    return new if ledger is None else old.unionByName(new)


def findings(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    """doc_id, blob, spans of every document, findings joined back through its blob."""
    now = ledger.where(F.col("rule_version") == RULE_VERSION).where("spans <> ''").select("blob", "spans")
    return blobs(docs).join(now, "blob", "left").select("doc_id", "blob", F.coalesce("spans", F.lit("")).alias("spans"))


def parse(spans: str) -> list[tuple[int, int, str]]:
    return [(int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x)]


def redacted(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced; other rows and columns unchanged."""
    key = F.sha2(F.coalesce("text", F.lit("")), 256)
    now = (ledger.where(F.col("rule_version") == RULE_VERSION).where("spans <> ''")
           .select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans")))
    with_spans = docs.withColumn("_blob", key).join(now, "_blob", "left")

    columns = docs.columns

    def clean(batches):
        for whole, a in ((b, a) for b in batches for a in range(0, b.num_rows, 256)):
            batch = whole.slice(a, 256)
            spans = batch.column("_spans").to_pylist()
            if any(spans):
                texts = [redact(t, parse(x)) if t and x else t for t, x in zip(batch.column("text").to_pylist(), spans)]
                at = batch.schema.get_field_index("text")
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield batch.select(columns)

    return with_spans.select(*docs.columns, "_spans").mapInArrow(clean, docs.schema)
