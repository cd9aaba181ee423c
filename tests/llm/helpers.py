"""Small tables with everything that may go wrong in a column, and plain versions to compare with."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names the operators use inside; as extra columns they must neither clash nor change.
CLASHING = ("fp", "n", "key", "h", "g", "p", "first", "host", "lines", "page", "hash", "mask", "item_id",
            "words", "label", "place", "score", "part", "rank", "length", "chunk", "base", "text_key", "digest",
            "__listed", "__host", "__lines_dropped", "__bad", "__text_key", "__score", "__gone", "__key", "__id",
            "__salt", "__copy", "row", "gone", "listed", "of", "salt", "copy", "bad", "dropped", "id")
EXTRA = ", ".join(f"{c} string" for c in CLASHING)


def words(seed: int, n: int, size: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}x" for _ in range(n)]


def prose(seed: int, sentences: int, of: int = 9) -> str:
    return " ".join(" ".join(words(seed * 1000 + i, of)).capitalize() + "." for i in range(sentences))


def docs(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def messy(spark):
    """Null ids, texts and sources, empty, blank, tiny and very long texts, repeated rows, clashing names."""
    long = " ".join(words(5, 60_000))
    rows = [
        (None, prose(1, 6), None), (None, None, None), (1, None, "a"), (2, "", "a"), (3, " \t\n ", "a"),
        (4, "one", "b"), (5, long, "b"), (6, prose(2, 8), "b"), (6, prose(2, 8), "b"), (6, prose(3, 8), "b"),
        (7, prose(2, 8), None), (8, "Ünïcode ß 漢字 🙂 <|endoftext|> it's _x_ 12 ²", "a"), (9, "a\r\nb\n\n\nc\x0bd\x01e", "a"),
    ]
    full = [(*r[:2], None, r[2], None, *["kept"] * len(CLASHING)) for r in rows]
    return spark.createDataFrame(full, f"{DOCS}, {EXTRA}")


def empty(spark):
    return spark.createDataFrame([], f"{DOCS}, {EXTRA}")


def unchanged(before, after) -> None:
    """Every row left is a row that was there, apart from text and length."""
    assert after.columns == before.columns
    others = [c for c in before.columns if c not in ("text", "n_chars")]
    had = [tuple(r[c] for c in others) for r in before.collect()]
    for r in after.collect():
        had.remove(tuple(r[c] for c in others))
