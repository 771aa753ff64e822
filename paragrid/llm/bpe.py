"""Whole-text encoding with the tokenizers library and a bounded word cache.

A text of the safe alphabet is split by the tokenizer's own pre-token pattern;
each distinct pre-token is encoded once by the library and kept as its ids'
little-endian bytes in a cache of bounded size.  Any other text, and any that may
hold an added token such as ``<|endoftext|>``, goes to the library whole, so the
ids are those of ``encode(text, add_special_tokens=False)`` in every case.  An empty text has no
ids; callers give null texts as empty ones; texts of any length are encoded
whole.
"""

from __future__ import annotations

import gc
import os
import re
from array import array
from collections.abc import Iterable

#: Characters on which Python's and the library's classes, case and normal forms are known to agree,
#: and the letters, numbers and spaces among them.
SAFE = re.compile("[\t\n\r\x20-\x7e\xa0-\u012f\u0131-\u017e\u2013\u2014\u2018-\u201e\u2022\u2026\u20ac]*")
LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017e"
NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
BLANK = "\t\n\r \xa0"
#: The pre-token patterns of the two tokenizer files, over the safe characters.
CLITICS = "'s|'t|'re|'ve|'m|'ll|'d"
BYTE_PATTERN = f"{CLITICS}| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{BLANK}{LETTER}{NUMBER}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
WORD_PATTERN = f"{CLITICS}|[{LETTER}]+|[{NUMBER}]|[^{BLANK}{LETTER}{NUMBER}]+"


#: Rows of an Arrow batch for encoding (Spark bounds its bytes besides), and characters encoded at a time.
ROWS, CHARACTERS = 4096, 2_000_000


def _heads(tokens: Iterable[str]) -> list[str]:
    """How the tokens begin, as far as case doesn't matter; a text without any of these has none of the tokens."""
    return sorted({re.match(r"[^\w\s]*", t)[0] for t in tokens})


class CachedEncoder:
    """``encode_batch`` gives each text's ids as little-endian uint32 bytes."""

    def __init__(self, path: str, *, cache_words: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.heads = _heads(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.folds = self.tokenizer.normalizer is not None
        self.split = re.compile(WORD_PATTERN if self.folds else BYTE_PATTERN).findall
        self.cache: dict[str, bytes] = {}
        self.cache_words = cache_words

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; a few megabytes at a time share one look for missing words."""
        out: list[bytes] = []
        begin = weight = 0
        collecting = gc.isenabled()
        gc.disable()  # nothing here makes cycles, and millions of short-lived objects would wake the collector
        try:
            for end, text in enumerate(texts, 1):
                weight += len(text)
                if weight >= CHARACTERS or end == len(texts):
                    out += self._encode(texts[begin:end])
                    begin, weight = end, 0
        finally:
            if collecting:
                gc.enable()
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        parts = [self.split(t.lower() if self.folds else t) if SAFE.fullmatch(t) and not any(h in t for h in self.heads) else None for t in texts]
        if len(self.cache) > self.cache_words:
            self.cache = {}
        look = self.cache.get
        found = [None if p is None else list(map(look, p)) for p in parts]  # one look a word; None where it is not known yet
        gaps = [k for k, f in enumerate(found) if f is not None and None in f]
        if gaps:
            missing = list({w for k in gaps for w, ids in zip(parts[k], found[k], strict=True) if ids is None})
            for word, coded in zip(missing, self.tokenizer.encode_batch_fast(missing, add_special_tokens=False), strict=True):
                self.cache[word] = array("I", coded.ids).tobytes()
            get = self.cache.__getitem__
            for k in gaps:
                found[k] = [get(w) if ids is None else ids for w, ids in zip(parts[k], found[k], strict=True)]
        return [self._whole(t) if f is None else b"".join(f) for t, f in zip(texts, found, strict=True)]


_ENCODERS: dict[str, CachedEncoder] = {}


def encoder(path: str) -> CachedEncoder:
    """The worker's encoder of a file, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = CachedEncoder(path)
    return _ENCODERS[path]
