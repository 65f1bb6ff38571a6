"""Documents with nulls, empty and long texts, ties, repeated rows and extra
columns whose names the operators use themselves."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
EXTRA = ["id", "key", "text_key", "fp", "grp", "size", "shard", "spans", "ids", "score", "component_id",
         "held_out", "label", "line", "term", "item_id", "block", "n"]


def long_text(words: int = 30_000, seed: int = 5) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(words))


def texts() -> list[tuple[int | None, str | None]]:
    same = "one two three four five six seven eight nine ten"
    return [(None, "a text without an id"), (None, "a text without an id"), (None, same), (1, None), (2, ""),
            (3, " \t\n "), (4, long_text()), (5, same), (5, same), (6, same), (7, same + " eleven"),
            (8, "Ärger mit Öl, und ΣΊΣΥΦΟΣ   x"), (9, "123 456 !!"), (10, "a"), (11, "x" * 5000),
            (12, "mail to jo.doe+x@mail.example.org or +49 (30) 123-456, ip 10.0.0.255, card 4111 1111 1111 1111"),
            (13, "ends with <|endoftext|> and <|startoftext|>\r\n\x0b\x1c\x85 tail"), (13, "same id, other text")]


def documents(spark, rows=None):
    """The edge documents with the columns of ``documents`` and extra ones."""
    rows = texts() if rows is None else rows
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in EXTRA)
    full = [(i, t, None if i is None else ("en", "de")[i % 2], "s", None if t is None else len(t),
             *[f"{c}!" for c in EXTRA]) for i, t in rows]
    return spark.createDataFrame(full, schema)
