"""Small tables and plain-Python versions of the operators' contracts."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, __size string, "
          "ids string, spans string, root long, size long, `a b` string")
LONG_LINE = "This exact footer line is repeated in a great many documents"


def rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, a clashing column."""
    out = [
        (1, None, "en", "a", None, "x"), (2, "", None, None, 0, None), (3, " \t\n ", "en", "a", 4, "x"),
        (4, "One two three four five six seven eight nine ten. " * 4, "en", "b", 200, "x"),
        (5, "Été là-bas, où ça? " * 30 + "\n" + LONG_LINE, "fr", "b", 1, None),
        (6, "word", "en", "c", 4, "x"), (7, "\U0001F600 日本語 text\r\nwith\x0bodd\x85white", "en", "c", 9, "x"),
        (None, "null id text " + LONG_LINE, "en", "a", 1, "x"), (None, None, None, None, None, None),
        (8, "a" * 5000, "en", "z", 5000, "x"), (9, "unique words " * 3 + "\n\n" + LONG_LINE, "en", "a", 1, "x"),
    ]
    out += [(k, f"Document number {k} says something of its own here\n  {LONG_LINE.upper() if k % 2 else LONG_LINE}\t\nend {k}",
             "en", "hot", 10, "x") for k in range(10, 22)]
    out += [(40, "the same text over and over again, a copy of itself", "en", "hot", 1, "x")] * 3
    out += [(41, "the same text over and over again, a copy of itself", "en", "b", 1, "x")]
    out += [(42, " ".join(f"w{k % 97}" for k in range(6000)), "de", "hot", 1, "x")]
    return [(*r, "i", None, 1, r[4], "z") for r in out]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
