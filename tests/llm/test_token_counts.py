from __future__ import annotations

import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models

from entitylake.llm import token_counts

from odd import odd_rows

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return token_counts.vocabulary(PATH)


@pytest.fixture(scope="module")
def reference(pieces):
    """The same vocabulary in a public unigram model, with bytes for unknown characters."""
    least = min(pieces.values())
    rest = [("<unk>", least)] + [(f"<0x{b:02X}>", least - 20) for b in range(256)]
    model = Tokenizer(models.Unigram(rest + list(pieces.items()), unk_id=0, byte_fallback=True))
    return lambda word: len(model.encode("▁" + word).ids)


def test_matches_a_public_unigram_model(odd, none, reference):
    found = token_counts.token_counts(odd, PATH).collect()
    expected = []
    for row in odd_rows():
        words = re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")
        known = {w: reference(w) if len(w) < 1000 else None for w in set(words)}
        if None not in known.values():
            expected.append((row[0], len(words), sum(known[w] for w in words)))
    own = sorted(map(tuple, found), key=repr)
    assert len(own) == len(odd_rows()) and set(expected) <= set(own)
    assert token_counts.token_counts(none, PATH).count() == 0


def test_all_segmentations_of_short_words():
    pieces = {"a": -1.0, "b": -1.5, "ab": -2.2, "abc": -2.6, "bc": -2.0, "ca": -1.1}

    def best(word: str) -> tuple[float, int]:
        if not word:
            return 0.0, 0
        unknown = min(pieces.values()) - token_counts.PENALTY
        score, count = best(word[1:])
        found = [(score + unknown, count + len(word[0].encode()))]
        for piece, value in pieces.items():
            if word.startswith(piece):
                score, count = best(word[len(piece) :])
                found.append((score + value, count + 1))
        return max(found, key=lambda f: (round(f[0], 9), -f[1]))

    words = [a + b + c + d for a in "abcé" for b in "abcé" for c in "abcé" for d in "abc"]
    for nodes in (5, 10_000):
        trie = token_counts.Trie(pieces, nodes)
        assert [trie.tokens(w) for w in words] == [best(w)[1] for w in words]
        assert len(trie.score) <= nodes
