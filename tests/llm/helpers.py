"""Small tables for the operators on text."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 60_000 + "end"
#: NULLs in every column, empty and blank texts, one of 300,000 characters, repeated rows, a NULL id
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, LONG, "en", "b", len(LONG)),
    (5, "the same text in two rows", "en", "a", 25),
    (5, "the same text in two rows", "en", "a", 25),
    (6, "the same text in two rows", "de", "b", 25),
    (None, "a text without an id", "en", None, 20),
]


def frame(spark, rows, clash: bool = False):
    """Documents of (doc_id, text) or whole rows; with ``clash``, further columns named as the operators' own."""
    rows = [r if len(r) == 5 else (*r, "en", "a", len(r[1] or "")) for r in rows]
    if not clash:
        return spark.createDataFrame(rows, SCHEMA)
    names = ("row", "size", "kept", "key", "node", "digest", "taken", "n", "_kept_id", "hash", "bytes", "print")
    return spark.createDataFrame([(*r, *names) for r in rows], SCHEMA + "".join(f", `{c}` string" for c in names))


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def read(spark, sf: str, name: str = "documents"):
    return spark.read.parquet(f"{sf}/{name}.parquet")
