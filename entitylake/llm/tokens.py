"""Byte-level BPE ids by the vocabulary file of a public tokenizer."""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# Fixed: how byte-level tokenizers cut a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CACHED_WORDS = 300_000
CACHED_LENGTH = 48


def _bytes_of_characters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranks(path: str) -> dict[bytes, int] | None:
    """Ids as merge ranks, if the file is a byte-level BPE whose merges are in the order of their ids."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, cutter = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not spec.get("normalizer") and not model.get("ignore_merges")
    if not plain or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space"):
        return None
    vocab, special = model["vocab"], {t["content"] for t in spec.get("added_tokens") or []}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [vocab.get(a + b, -1) for a, b in merges]
    if -1 in ids or any(a >= b for a, b in zip(ids, ids[1:])):
        return None
    written = _bytes_of_characters()
    return {bytes(written[c] for c in token): i for token, i in vocab.items() if token not in special}


def _added(path: str) -> dict[str, int] | None:
    """The tokens that the file adds, with their ids; None if one of them takes more than its own text."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens") or []
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in tokens):
        return None
    return {t["content"]: t["id"] for t in tokens if t["content"]}


class _Words(dict):
    """Ids of a word with a space before it; ``None`` for what cannot stand for itself."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes | None:
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        ids = self.encode(" " + word)
        if len(self) < CACHED_WORDS and len(word) <= CACHED_LENGTH:
            self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit numbers.

    Ids are those of the ``tokenizers`` library for the same file, by its default settings: a text
    is cut at the tokens that the file adds to its vocabulary, special ones too, and each gets its id.
    Where the file allows, what lies between is cut at its single spaces, at which such a tokenizer
    always cuts too, and the ids of words come from a cache of bounded size.
    """

    def __init__(self, path: str) -> None:
        ranks, added = _ranks(path), _added(path)
        self._ids = {}
        if ranks and added is not None:
            self._ids = {token: np.array([i], "<u4").tobytes() for token, i in added.items()}
            core = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._whole = lambda text: np.array(core.encode_ordinary(text), "<u4").tobytes()
            self._words = _Words(self._whole)
        else:
            tokenizer = Tokenizer.from_file(path)
            self._whole = lambda text: np.array(
                tokenizer.encode(text, add_special_tokens=False).ids, "<u4"
            ).tobytes()
            self._words = None
        # the longest of the tokens that begin at a place
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self._ids, key=len, reverse=True))) + ")")

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self._ids):
            parts = self._cut.split(text)  # every second one is a token
            return b"".join(self._ids[part] if i % 2 else self._plain(part) for i, part in enumerate(parts) if part)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if self._words is not None:
            first, *words = text.split(" ")
            if not first[-1:].isspace():
                try:
                    return self._whole(first) + b"".join(map(self._words.__getitem__, words))
                except TypeError:  # a space beside other white space belongs to it
                    pass
        return self._whole(text)


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per file and Python worker, as loading takes a while."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]
