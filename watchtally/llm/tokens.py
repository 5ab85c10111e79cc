"""Token ids by a public tokenizer file, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

``word_encoder``: a text is cut at white space, where this kind of tokenizer always
cuts, and the ids of each chunk are remembered, so a chunk that occurs a million
times is encoded once per worker. New chunks are encoded together as one text;
since tokens keep their bytes, the sum of token lengths shows where each ends.

``byte_encoder``: byte-level BPE whose merges are in the order of the ids has the
same ids in tiktoken, which is several times faster; its ranks are taken from the
same file. Texts with special tokens, texts with a run of ``LONG_RUN`` or more characters
of white space or without any (tiktoken's pattern needs stack for each of them), and files
whose merges are ordered otherwise go to the tokenizers library.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import cached_property, lru_cache

import numpy as np

from .common import give_back

#: Chunks remembered by a worker (about 70 MB); beyond them, chunks are encoded each time.
MOST_CHUNKS = 250_000
#: Longer chunks come back too seldom to be remembered.
LONG_CHUNK = 24

#: From such runs on tiktoken isn't asked; it fails at about a million.
LONG_RUN = 20_000
_LONG = re.compile(r"\s{%d}|\S{%d}" % (LONG_RUN, LONG_RUN))
_BLANK = re.compile(r"[\x20\x09-\x0D]+")
# White space to Python's split() but not to the tokenizer.
_SEPARATOR = re.compile(r"[\x1c-\x1f]")


def split_on_space(text: str) -> list[str]:
    """Chunks for a tokenizer that composes, lower-cases and drops white space."""
    if text.isascii():
        text = text.lower()
    else:
        text = unicodedata.normalize("NFC", text)
        # Sigma's lower case depends on its place in Python, not in the tokenizer.
        lower = text if "\u03a3" in text else text.lower()
        text = lower if unicodedata.is_normalized("NFC", lower) else text
    return [*filter(None, _BLANK.split(text))] if _SEPARATOR.search(text) else text.split()


class WordEncoder:
    """Encodes whole texts; one per worker and tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For lower-case words of letters alone: no normaliser, no pattern.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        end = spec["model"].get("end_of_word_suffix") or ""
        vocab = spec["model"]["vocab"]
        # One character stands for one byte in byte-level vocabularies.
        self.length = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.length[i] = len(token) - (len(end) if end and token.endswith(end) else 0)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.n_ids = max([len(self.length), *(t["id"] + 1 for t in spec["added_tokens"])])

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, new: list[str], into: dict[str, bytes]) -> list[str]:
        """Add the ids of new chunks; a word before one stop or comma is looked up without it. All that was added."""
        stops = {c: c[:-1] for c in new if c[-1] in ".," and c[:-1].isalpha()}
        words = {*(c for c in new if c not in stops), *(w for w in stops.values() if w not in into)}
        for i in ".,":
            if i not in into:
                into[i] = self.plain(i).tobytes()
                words.discard(i)
        letters = [c for c in words if c.isalpha() and c == c.lower()]
        rest = words.difference(letters)
        ascii_rest = [c for c in rest if c.isascii()]
        for tokenizer, part in ((self.letters, letters), (self.tokenizer, ascii_rest)):
            cuts = [part[a : a + 512] for a in range(0, len(part), 512)]
            for own, e in zip(cuts, tokenizer.encode_batch_fast([" ".join(x) for x in cuts], add_special_tokens=False)):
                ids = np.array(e.ids, np.uint32)
                sizes = [len(c) if c.isascii() else len(c.encode()) for c in own]
                ends = (4 * np.searchsorted(np.cumsum(self.length[ids]), np.cumsum(sizes)) + 4).tolist()
                raw, b = ids.tobytes(), 0
                for c, x in zip(own, ends):
                    into[c] = raw[b:x]
                    b = x
        alone = [c for c in rest if not c.isascii()]
        for c, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            into[c] = np.array(e.ids, np.uint32).tobytes()
        for c, w in stops.items():
            into[c] = into[w] + into[c[-1]]
        return [*words, *stops]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each whole text."""
        known = self.known
        cuts = [None if not t or any(s in t for s in self.special) else split_on_space(t) for t in texts]
        new = {*()}.union(*(c for c in cuts if c)).difference(known)
        forget: list[str] = []
        if new:
            before = len(known)
            added = self._learn([*new], known)
            full = before + len(added) > MOST_CHUNKS
            forget = added if full else [c for c in added if len(c) > LONG_CHUNK]
        out = [np.frombuffer(b"".join(map(known.__getitem__, c)), np.uint32) if c is not None else self.plain(t) if t else np.zeros(0, np.uint32) for c, t in zip(cuts, texts)]
        for c in forget:
            del known[c]
        return out


class ByteEncoder:
    """Byte-level BPE; one per worker and tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.path, self.fast = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        if [vocab[a + b] for a, b in pairs] == [*range(256, 256 + len(pairs))] and spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel":
            import public_tokenizers
            import tiktoken

            # The characters that stand for bytes: printable ones for themselves, the others from U+0100 on.
            own = [b for b in range(256) if chr(b).isprintable() and b != 32 and b < 127 or 161 <= b <= 172 or 174 <= b]
            byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
            ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in self.special}
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def tokenizer(self):
        """Loaded when it is needed."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each whole text."""
        return [np.array(self.fast.encode_ordinary(t) if self.fast and self._plain(t) else self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts]

    def _plain(self, text: str) -> bool:
        return not any(s in text for s in self.special) and (len(text) < LONG_RUN or not _LONG.search(text))


@lru_cache(4)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


@lru_cache(4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def forget_encoders() -> None:
    """Free the encoders of this worker, for tasks of later stages that don't encode."""
    byte_encoder.cache_clear()
    word_encoder.cache_clear()
    give_back()
