"""Rows that every operator has to stand."""

from __future__ import annotations

AWKWARD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n\r\x0b\x0c ", None),
    (4, "word", None),
    (5, "Émile ſecret \U0001f600 naïve İstanbul", "b"),
    (6, "long " * 30_000, "b"),
    (7, "\n\n\nsame line of text here\nsame line of text here\n", "c"),
    (7, "\n\n\nsame line of text here\nsame line of text here\n", "c"),
    (8, "SAME line of text here", "c"),
    (None, "an id is missing here and that must not hurt anything at all", "c"),
    (None, None, None),
    (-5, "a negative id with the same line of text here\nsame line of text here", "a"),
]
