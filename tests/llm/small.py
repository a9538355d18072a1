"""Small tables with awkward rows, and plain versions of shared definitions."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def prose(rng, count):
    parts = ["ka", "lo", "mi", "ru", "té", "son", "vel", "ga", "di", "ñu"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(count))


def awkward_rows(seed=1):
    """Null and empty texts, null ids and sources, repeated rows, a very long text, odd white space."""
    rng = random.Random(seed)
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \n\t ", "en", "a", 5), (None, "no id " * 20, "en", "b", 1),
        (None, None, None, None, None), (4, "one", "en", "b", 3), (4, "one", "en", "b", 3), (5, prose(rng, 30_000), "en", "a", 1),
        (6, "x" * 50_000, "en", "c", 1), (7, "a\x0bb\x0cc d e f g", "en", None, 9), (8, prose(rng, 60), "fr", "c", 1),
        (9, prose(rng, 60).upper() + "\n" + "same line\n" * 30, "fr", "a", 1), (-5, "\x00 nul \\ back", "", "", -1),
    ]
    return rows
