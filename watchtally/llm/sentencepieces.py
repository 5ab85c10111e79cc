"""Operator 13: SentencePiece encoding and decoding of merge-type (BPE) models.

The method: the characters of a run are a linked list of symbols, and an agenda holds its
adjacent pairs that are pieces, best score first and leftmost among equals. The top
pair is merged and its two new neighbours enter the agenda, until it is empty. ``by_rows``
does so for thousands of short runs side by side, an agenda a row; ``by_heap`` for one long run,
passing over entries whose symbols have changed since. Pieces left at the end that the vocabulary lacks become the ids of their bytes.

A text is cut into runs first, where no merge can cross: before white space that
no piece holds after another character, and around characters that stand in no
longer piece; both are read off the vocabulary. A run's ids are remembered by the
worker, so a run that occurs a million times is merged once.

``encode`` works in Arrow batches. In each batch the sentencepiece library encodes
the same whole texts, and ``agrees`` says for each row whether its ids are equal;
the ids returned are the agenda's. ``decode`` is the library's own decode(ids).

Defined cases: a null or empty text has no ids and decodes to the empty text;
repeated rows and repeated or null doc_ids are encoded each by itself; extra columns
are ignored; an empty table gives no rows; the strings of control symbols (``<s>``)
are ordinary text; white space is never joined or dropped. U+2581 in a text is read
as a blank, as the library does. Whole texts are encoded: memory is about 210 bytes
for each character of the longest run (not text), since a run is merged as a whole.
Models with other normalisation than the identity, unused or user-defined pieces,
or unigram models raise ValueError.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
from pyspark.sql import DataFrame

from .common import groups, map_arrow

#: Runs remembered by a worker (about 100 MB); beyond them, runs are merged each time.
MOST_RUNS = 600_000
#: Longer runs come back too seldom to be remembered.
LONG_RUN = 48
#: Runs of up to so many characters are merged side by side, ``ROWS`` at once; a longer one has a heap.
SHORT_RUN = 32
ROWS = 8192
NO_PIECE, NO_PAIR = (1 << 31) - 1, np.iinfo(np.int64).max
BLANK = "▁"

# Fixed values of the model format.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGE_TYPE = 2


class PairTable:
    """Rank and piece of pairs of symbols, looked up many at once: a hash table without chains, clashes aside in order."""

    def __init__(self, pairs: dict[int, tuple[int, int]]):
        key = np.array([*pairs], np.int64)
        rank, piece = (np.array([x[i] for x in pairs.values()], np.int64) for i in (0, 1))
        self.bits = max(4, int(8 * len(key)).bit_length())
        slot = self.slot(key)
        self.key, self.rank, self.piece = (np.full(1 << self.bits, x, np.int64) for x in (-1, NO_PIECE, -1))
        self.key[slot], self.rank[slot], self.piece[slot] = key, rank, piece
        aside = np.flatnonzero(self.key[slot] != key)
        aside = aside[np.argsort(key[aside])]
        self.rest = [np.append(x[aside], y) for x, y in ((key, NO_PAIR), (rank, NO_PIECE), (piece, -1))]

    def slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of each pair; NO_PIECE and -1 where it makes none."""
        key = a << 32 | b
        slot = self.slot(key)
        hit = self.key[slot] == key
        rank, piece = np.where(hit, self.rank[slot], NO_PIECE), np.where(hit, self.piece[slot], -1)
        miss = np.flatnonzero(~hit)
        at = np.searchsorted(self.rest[0], key[miss])
        found = self.rest[0][at] == key[miss]
        rank[miss[found]], piece[miss[found]] = self.rest[1][at[found]], self.rest[2][at[found]]
        return rank, piece


class MergeVocabulary:
    """Pieces, ranks by score and bytes of one model; one per worker and model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, own = model.normalizer_spec, {NORMAL, UNKNOWN, CONTROL, BYTE}
        if model.trainer_spec.model_type != MERGE_TYPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces \
                or model.trainer_spec.treat_whitespace_as_suffix or {p.type for p in model.pieces} - own:
            raise ValueError("not a merge-type model with identity normalisation")
        self.library = SentencePieceProcessor(model_file=path)
        self.prefix = BLANK if norm.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        scores = sorted({p.score for p in model.pieces if p.type == NORMAL and len(p.piece) > 1}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        long = {p.piece: rank[p.score] for p in model.pieces if p.type == NORMAL and len(p.piece) > 1}
        # A symbol is the id of its piece; a character that is no piece is ``size`` plus its code point.
        self.size = len(model.pieces)
        self.of_char = np.arange(0x110000, dtype=np.int64) + self.size
        for c, i in self.ids.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        #: Of each two neighbours that make a piece: its rank by score, and its id.
        pairs = {}
        for piece, r in long.items():
            for k in range(1, len(piece)):
                a, b = (int(self.of_char[ord(x)]) if len(x) == 1 else self.ids.get(x) for x in (piece[:k], piece[k:]))
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (r, self.ids[piece])
        self.pair_rank, self.pair_piece = {k: r for k, (r, _) in pairs.items()}, {k: i for k, (_, i) in pairs.items()}
        self.pair_table = PairTable(pairs)
        self.byte_ids = [i for i, p in enumerate(model.pieces) if p.type == BYTE]
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        inner = {c for piece in long for c in piece}
        self.pairs = {piece[i : i + 2] for piece in long for i in range(len(piece) - 1)}
        alone = "".join(chr(c) for c in range(128) if chr(c) not in inner)
        # A run: blanks with what follows them, where no piece has a blank after another character.
        self.blank_starts = not any(re.search(f"[^{BLANK}]{BLANK}", piece) for piece in long)
        one = re.escape(alone)
        self.run = re.compile(f"[{one}]|{BLANK}*[^{BLANK}{one}]+|{BLANK}+" if alone else f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self.known: dict[str, bytes] = {}

    def runs(self, text: str) -> list[str]:
        """The text as the model sees it, cut where no merge can cross."""
        if not text:
            return []
        whole = self.prefix + text.replace(" ", BLANK)
        return self.run.findall(whole) if self.blank_starts else [whole]

    def by_rows(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, how many of each run) of short runs, side by side: in each round every run's agenda gives up its top.

        An agenda is a row of ranks by place; its first minimum is the best pair, the leftmost among equals."""
        n_runs, size = len(runs), np.fromiter(map(len, runs), np.int64, len(runs))
        width = int(size.max())
        inside = np.arange(width) < size[:, None]
        symbols = np.full((n_runs, width), -1)
        symbols[inside] = self.of_char[np.frombuffer("".join(runs).encode("utf-32-le"), "<u4")]
        after = np.tile(np.arange(1, width + 1), (n_runs, 1))
        before = after - 2
        agenda = np.full((n_runs, width), NO_PIECE, np.int32)
        both = inside[:, 1:]
        agenda[:, :-1][both] = self.pair_table.find(symbols[:, :-1][both], symbols[:, 1:][both])[0]
        open_runs = np.arange(n_runs)
        while len(open_runs):
            top = agenda[open_runs].argmin(1)
            more = agenda[open_runs, top] < NO_PIECE
            open_runs, top = open_runs[more], top[more]
            right = after[open_runs, top]
            merged = self.pair_table.find(symbols[open_runs, top], symbols[open_runs, right])[1]
            symbols[open_runs, top], symbols[open_runs, right] = merged, -1
            agenda[open_runs, top] = agenda[open_runs, right] = NO_PIECE
            following = after[open_runs, right]
            after[open_runs, top] = following
            has = following < size[open_runs]
            run, place, right = open_runs[has], top[has], following[has]
            before[run, right] = place
            agenda[run, place] = self.pair_table.find(merged[has], symbols[run, right])[0]
            left = before[open_runs, top]
            has = left >= 0
            run, left = open_runs[has], left[has]
            agenda[run, left] = self.pair_table.find(symbols[run, left], merged[has])[0]
        return symbols[symbols >= 0], (symbols >= 0).sum(1)

    def by_heap(self, run: str) -> np.ndarray:
        """Pieces of a long run: linked symbols and a heap; entries whose symbols changed are passed over."""
        symbols = self.of_char[np.frombuffer(run.encode("utf-32-le"), "<u4")].tolist()
        rank, piece = self.pair_rank.get, self.pair_piece
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        # An entry is one integer: rank, place of the left symbol, the piece that the pair makes.
        agenda = [(r << 80) | (i << 32) | piece[k] for i, k, r in ((i, k, rank(k)) for i, k in enumerate(a << 32 | b for a, b in zip(symbols, symbols[1:]))) if r is not None]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            left = (entry >> 32) & 0xFFFFFFFFFFFF
            right = after[left]
            if symbols[left] < 0 or right >= n or piece.get(symbols[left] << 32 | symbols[right]) != entry & 0xFFFFFFFF:
                continue
            symbols[left] = a = entry & 0xFFFFFFFF
            symbols[right] = -1
            after[left] = right = after[right]
            if right < n:
                before[right] = left
                if (r := rank(k := a << 32 | symbols[right])) is not None:
                    heappush(agenda, (r << 80) | (left << 32) | piece[k])
            if (first := before[left]) >= 0 and (r := rank(k := symbols[first] << 32 | a)) is not None:
                heappush(agenda, (r << 80) | (first << 32) | piece[k])
        return np.array([s for s in symbols if s >= 0])

    def ids_of(self, pieces: np.ndarray) -> bytes:
        """Packed ids of the pieces of one run: those that the vocabulary lacks become the ids of their bytes."""
        if (pieces < self.size).all():
            return pieces.astype(np.int32).tobytes()
        ids: list[int] = []
        for i in pieces.tolist():
            if i < self.size:
                ids.append(i)
            elif self.byte_ids:
                ids.extend([self.byte_ids[b] for b in chr(i - self.size).encode()])
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return np.array(ids, np.int32).tobytes()

    def learn(self, runs: set[str]) -> None:
        """Merge runs that aren't remembered."""
        short = sorted((r for r in runs if len(r) <= SHORT_RUN), key=len)
        for a in range(0, len(short), ROWS):
            own = short[a : a + ROWS]
            pieces, n = self.by_rows(own)
            odd = np.add.reduceat(pieces >= self.size, np.cumsum(n) - n).astype(bool)
            raw, end = pieces.astype(np.int32).tobytes(), (4 * np.cumsum(n)).tolist()
            self.known.update(zip(own, map(raw.__getitem__, map(slice, [0, *end], end))))
            for i in np.flatnonzero(odd).tolist():
                self.known[own[i]] = self.ids_of(pieces[end[i] // 4 - n[i] : end[i] // 4])
        for run in runs:
            if len(run) > SHORT_RUN:
                self.known[run] = b"".join(self.known.get(x) or self.ids_of(self.by_heap(x)) for x in self.cuts(run))

    def cuts(self, run: str) -> list[str]:
        """The run, cut between neighbours that stand side by side in no piece."""
        pairs, a, out = self.pairs, 0, []
        for i in range(1, len(run)):
            if run[i - 1 : i + 1] not in pairs:
                out.append(run[a:i])
                a = i
        out.append(run[a:])
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each whole text."""
        known, cut = self.known, [self.runs(t) for t in texts]
        new = {*()}.union(*cut).difference(known)
        room = MOST_RUNS - len(known)
        self.learn(new)
        out = [np.frombuffer(b"".join(map(known.__getitem__, runs)), np.int32) for runs in cut]
        for k, run in enumerate(new):
            if k >= room or len(run) > LONG_RUN:
                del known[run]
        return out


@lru_cache(4)
def vocabulary(path: str) -> MergeVocabulary:
    return MergeVocabulary(path)


def _lists(ids: list[np.ndarray]):
    import pyarrow as pa

    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>, agrees boolean): one row for each row of docs; no begin or end ids.

    With ``decoded`` also ``text``, what the library's decode makes of the ids."""

    def run(batches) -> Iterator[dict]:
        v = vocabulary(path)
        for rows, texts in groups(batches):
            texts = [t.decode() for t in texts]
            ids = v.encode(texts)
            lists = [x.tolist() for x in ids]
            out = {"doc_id": rows.column("doc_id"), "ids": _lists(ids), "agrees": [x == y for x, y in zip(lists, v.library.encode(texts))]}
            yield out | ({"text": [v.library.decode(x) if x else "" for x in lists]} if decoded else {})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, ids array<int>, agrees boolean" + (", text string" if decoded else ""))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The columns of a table of ids with ``text``: what the library's decode makes of them (null ids: none)."""

    def run(batches) -> Iterator[dict]:
        v = vocabulary(path)
        for batch in batches:
            ids = batch.column("ids")
            flat, ends = ids.flatten().to_numpy(), np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            lists = [x.tolist() for x in np.split(flat, ends[:-1])]
            yield {c: batch.column(c) for c in batch.schema.names} | {"text": [v.library.decode(x) if x else "" for x in lists]}

    kinds = [(f.name, f.dataType.simpleString()) for f in encoded.schema if f.name != "text"]
    return map_arrow(encoded.drop("text"), run, ", ".join(f"`{n}` {t}" for n, t in [*kinds, ("text", "string")]))
