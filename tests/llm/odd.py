"""Rows with everything that may go wrong in them."""

from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside or return; they must pass through as plain data.
CLASHING = "key string, row string, fp long, size string, target string, starts string, id1 long, part int, found string, label string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(f"{draw.choice(WORDS)}{draw.randrange(50)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, repeated rows, near copies, shared passages."""
    shared = prose(1, 60)
    near = prose(2, 300)
    texts = [
        None, "", " \t\n", "one", "two words", "ein Wort mit \x1c Zeichen", "\x01 a\x00b <|endoftext|>  c ",
        prose(3, 40) + "\n" + shared + " " + prose(4, 40), shared + "\n" + prose(5, 10), prose(6, 35),
        prose(6, 35), near, near.replace(" ", "  ", 1), near + " end", "same " * 120, prose(7, 30_000),
        "word" * 50_000, "Released under the MIT License.\n\nAll rights reserved.", "ÀÉ ÜÖ straße ŉ 漢字 🙂",
    ]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, "text without a key", "en", "s1", None), (None, None, None, None, None)]
    return rows + rows[7:9] + [rows[12]] * 2
