"""Operator 8: WARC archives with a two-level capture index.

Writing: every page is one WARC/1.1 record in its own gzip member, many members to
an archive file, files written by Spark tasks into the shared folder. Equal
payloads of at least ``min_bytes`` are stored once: the page with the smallest
page_id is the ``response``, the others are ``revisit`` records that refer to it.

Index: captures are sorted by reversed-host URL key (``com,example,www)/path``)
over ranges of keys, cut into blocks of ``BLOCK_LINES`` lines, and each block is
compressed by itself (level one). A sparse directory keeps one line per block: its
first key, offset and length (level two; a short list of index files tells which
directory to open). A lookup binary-searches the directory, reads and decompresses
only the blocks that can hold the key, and range-reads the records they name.

Defined cases: null html is the empty payload; null url is the empty URL; a null
page_id is written as no id, comes after all others, and is referred to by none
unless its whole group lacks ids, in which case every record is a response; rows
that share the smallest page_id of a group are all responses; extra columns are
ignored; an empty table gives no files and no captures.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_arrow, shared_folder
from .tokenfile import file_system, put

BLOCK_LINES = 512
#: Captures carry a date; these archives are made by a batch job, which gives one.
DATE = "2024-01-01T00:00:00Z"
FIELDS = ("surt", "url", "page_id", "record_type", "archive", "offset", "length")
CAPTURE = "surt string, url string, page_id long, record_type string, archive string, offset long, length long"


def surt(url: str | None) -> str:
    """Reversed-host key of a URL: case, scheme, leading www, default port, fragment and query order don't matter."""
    try:
        u = urlsplit((url or "").strip())
        host, port = (u.hostname or "").rstrip("."), u.port
    except ValueError:
        return (url or "").strip().lower()
    labels = host.split(".")
    if labels[0] == "www" and len(labels) > 2:
        labels = labels[1:]
    where = "" if port in (None, 80, 443) else f":{port}"
    query = "&".join(sorted(u.query.split("&"))) if u.query else ""
    return ",".join(reversed(labels)) + where + ")" + ((u.path or "/") + (f"?{query}" if query else "")).lower()


def _clean(value: str) -> str:
    """A header value may hold no line ends."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One record, not compressed."""
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:x-page:{'none' if page_id is None else page_id}>",
            f"WARC-Date: {date}", f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        body, kind = http + payload, "application/http; msgtype=response"
    else:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Refers-To-Date: {date}"]
        body, kind = http, "application/http; msgtype=response"
    head += [f"Content-Type: {kind}", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def gzipped(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def parse_record(member: bytes) -> dict:
    """Headers (lower case) and payload of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])}
    body = rest[: int(headers["content-length"])]
    return {"headers": headers, "payload": body.partition(b"\r\n\r\n")[2]}


def with_revisits(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """page_id, url, html, digest, refers_to. Groups are reduced to their smallest id before the join."""
    html = F.coalesce("html", F.lit(""))
    made = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    groups = (made.where(F.octet_length("html") >= min_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("smallest"), F.count("*").alias("n")).where("n > 1").select("digest", "smallest"))
    # A merge join, so that a large group of copies can be split between tasks.
    joined = made.join(groups.hint("merge"), "digest", "left")
    own = F.col("smallest").isNull() | F.col("smallest").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "html", "digest", F.when(~own, F.col("smallest")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 100) -> DataFrame:
    """Write the archives; the captures, one row per record, in a table of the shared folder."""
    folder = folder or shared_folder(pages.sparkSession, "warc")

    def run(batches):
        from pyspark import TaskContext

        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        name = f"pages-{TaskContext.get().partitionId():06d}.warc.gz"
        out = {k: [] for k in ("surt", "url", "page_id", "record_type", "offset", "length")}

        def write(f):
            at = 0
            for batch in batches:
                for a in range(0, batch.num_rows, 256):
                    for r in batch.slice(a, 256).to_pylist():
                        member = gzipped(record(r["page_id"], r["url"], r["html"].encode(), r["digest"], r["refers_to"]))
                        f.write(member)
                        for k, v in (("surt", surt(r["url"])), ("url", r["url"]), ("page_id", r["page_id"]),
                                     ("record_type", "response" if r["refers_to"] is None else "revisit"), ("offset", at), ("length", len(member))):
                            out[k].append(v)
                        at += len(member)

        put(fs, f"{root}/{name}", write)
        yield out | {"archive": [f"{folder}/{name}"] * len(out["url"])}

    return cut(map_arrow(with_revisits(pages, min_bytes), run, CAPTURE))


#: Archive bytes that a task reads back at least, and tasks at most.
STRETCH, MOST_TASKS = 4 << 20, 50_000
FIELD, LINE = "\x1f", "\x1e"
MANIFEST = "index_file string, first_key string, last_key string, n_lines long"


def _escaped(s: str) -> str:
    return s.replace("%", "%25").replace(FIELD, "%1F").replace(LINE, "%1E")


def _unescaped(s: str) -> str:
    return s.replace("%1E", LINE).replace("%1F", FIELD).replace("%25", "%")


def _line(r: dict) -> str:
    return FIELD.join([_escaped(r["surt"]), _escaped(r["url"]), "" if r["page_id"] is None else str(r["page_id"]), r["record_type"], r["archive"], str(r["offset"]), str(r["length"])])


def _unline(line: str) -> dict:
    key, url, page_id, kind, archive, offset, length = line.split(FIELD)
    return {"surt": _unescaped(key), "url": _unescaped(url), "page_id": int(page_id) if page_id else None, "record_type": kind, "archive": archive, "offset": int(offset), "length": int(length)}


def write_index(captures: DataFrame, folder: str | None = None, rows_each: int = 100_000) -> str:
    """Write the index and return its folder.

    ``block-<n>.cdx`` holds compressed blocks in key order, ``block-<n>.dir`` their
    sparse directory (first key, offset, length; one line per block), and ``top`` one
    line per index file with its first and last key. Only ``top``, a line for every
    ``rows_each`` captures, passes through the driver.
    """
    folder = folder or shared_folder(captures.sparkSession, "capture-index")

    def run(batches):
        from pyspark import TaskContext

        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        name = f"block-{TaskContext.get().partitionId():06d}"
        directory, last, total = [], "", 0

        def write(f):
            nonlocal last, total
            at, waiting = 0, []

            def flush():
                nonlocal at, last, total
                data = zlib.compress(LINE.join(map(_line, waiting)).encode(), 6)
                f.write(data)
                directory.append(FIELD.join([_escaped(waiting[0]["surt"]), str(at), str(len(data))]))
                at, last, total = at + len(data), waiting[-1]["surt"], total + len(waiting)
                waiting.clear()

            for batch in batches:
                for r in batch.to_pylist():
                    waiting.append(r)
                    if len(waiting) == BLOCK_LINES:
                        flush()
            if waiting:
                flush()

        put(fs, f"{root}/{name}.cdx", write)
        put(fs, f"{root}/{name}.dir", lambda f: f.write(LINE.join(directory).encode()))
        if directory:
            yield {"index_file": [name], "first_key": [_unescaped(directory[0].split(FIELD)[0])], "last_key": [last], "n_lines": [total]}

    n = max(1, -(-captures.count() // rows_each))
    # Archive and offset split a key that very many captures share.
    dealt = captures.repartitionByRange(n, "surt", "archive", "offset").sortWithinPartitions("surt", "archive", "offset")
    files = cut(map_arrow(dealt, run, MANIFEST)).orderBy(F.length("index_file"), "index_file").collect()  # a row per index file, by number
    fs, root = file_system(folder)
    fs.create_dir(root, recursive=True)
    lines = [FIELD.join([r["index_file"], _escaped(r["first_key"]), _escaped(r["last_key"])]) for r in files]
    put(fs, f"{root}/top", lambda f: f.write(LINE.join(lines).encode()))
    return folder


class CaptureIndex:
    """Reader of an index folder: binary search in ``top``, in a file's directory, then in a block."""

    def __init__(self, folder: str):
        self.fs, self.root = file_system(folder)
        rows = [x.split(FIELD) for x in self._read("top").decode().split(LINE) if x]
        self.files = [x[0] for x in rows]
        self.firsts, self.lasts = [_unescaped(x[1]) for x in rows], [_unescaped(x[2]) for x in rows]
        self.directory = lru_cache(4)(self._directory)
        self.block = lru_cache(8)(self._block)

    def _read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        with self.fs.open_input_file(f"{self.root}/{name}") as f:
            f.seek(offset)
            return f.read(length) if length is not None else f.read()

    def _directory(self, name: str) -> tuple[list[str], list[tuple[int, int]]]:
        rows = [x.split(FIELD) for x in self._read(f"{name}.dir").decode().split(LINE) if x]
        return [_unescaped(x[0]) for x in rows], [(int(x[1]), int(x[2])) for x in rows]

    def _block(self, name: str, offset: int, length: int) -> tuple[list[str], list[dict]]:
        lines = [_unline(x) for x in zlib.decompress(self._read(f"{name}.cdx", offset, length)).decode().split(LINE)]
        return [x["surt"] for x in lines], lines

    def captures(self, key: str) -> Iterator[dict]:
        """All captures under one key, block after block."""
        for name in self.files[bisect_left(self.lasts, key) : bisect_right(self.firsts, key)]:
            firsts, ranges = self.directory(name)
            # The block before the first one that starts with the key may end with it.
            for offset, length in ranges[max(0, bisect_left(firsts, key) - 1) : bisect_right(firsts, key)]:
                keys, lines = self.block(name, offset, length)
                yield from lines[bisect_left(keys, key) : bisect_right(keys, key)]


def lookup(folder: str, url: str) -> list[dict]:
    """Captures of one URL."""
    return [*CaptureIndex(folder).captures(surt(url))]


def lookup_all(folder: str, urls: DataFrame) -> DataFrame:
    """Every capture of every URL in a table, once. Keys are looked up in key order, so a task reads few blocks twice."""

    def keys(batches):
        for batch in batches:
            yield {"surt": [*{surt(u) for u in batch.column("url").to_pylist()}]}

    def run(batches):
        index = CaptureIndex(folder)
        for batch in batches:
            out = []
            for key in batch.column("surt").to_pylist():
                for c in index.captures(key):
                    out.append(c)
                    if len(out) == 4096:
                        yield {k: [x[k] for x in out] for k in FIELDS}
                        out = []
            yield {k: [x[k] for x in out] for k in FIELDS}

    distinct = map_arrow(urls.select("url"), keys, "surt string").distinct()
    return map_arrow(distinct.repartitionByRange("surt").sortWithinPartitions("surt"), run, CAPTURE)


def read_records(captures: DataFrame, with_payload: bool = False) -> DataFrame:
    """Range-read the record of every capture; a stretch of an archive is read front to back by the task that opens it.

    Tasks follow from the bytes behind the captures, not from the few bytes of the captures themselves."""

    def run(batches):
        name, f = None, None
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                out = {k: [] for k in ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")}
                for c in batch.slice(a, 128).to_pylist():
                    if c["archive"] != name:
                        if f is not None:
                            f.close()
                        name = c["archive"]
                        fs, path = file_system(name)
                        f = fs.open_input_file(path)
                    f.seek(c["offset"])
                    r = parse_record(f.read(c["length"]))
                    h, payload = r["headers"], r["payload"]
                    digest, size = h["warc-payload-digest"].removeprefix("sha256:"), int(h["x-payload-length"])
                    response = h["warc-type"] == "response"
                    if response and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"damaged record at {c['archive']}:{c['offset']}")
                    ref = h.get("warc-refers-to")
                    own = h["warc-record-id"][len("<urn:x-page:") : -1]
                    for k, v in (("page_id", None if own == "none" else int(own)), ("url", h["warc-target-uri"]), ("payload_bytes", size), ("payload_digest", digest),
                                 ("record_type", h["warc-type"]), ("refers_to", int(ref[len("<urn:x-page:") : -1]) if ref else None), ("payload", payload if response else None)):
                        out[k].append(v)
                yield out if with_payload else {k: v for k, v in out.items() if k != "payload"}
        if f is not None:
            f.close()

    # Rows of one stretch of an archive go to one task; a large archive is shared between tasks.
    total = captures.agg(F.sum("length")).first()[0] or 0
    n_tasks = min(MOST_TASKS, -(-total // STRETCH) or 1)
    stretch = F.floor(F.col("offset") / STRETCH)
    dealt = captures.repartition(n_tasks, "archive", stretch).sortWithinPartitions("archive", "offset")
    return map_arrow(dealt.select("archive", "offset", "length"), run,
                     "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if with_payload else ""))
