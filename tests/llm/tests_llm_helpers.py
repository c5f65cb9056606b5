from __future__ import annotations

import random


def words_of(text):
    return (text or "").encode().split()


def odd_rows():
    """Null, empty and blank texts, a null id, repeated rows, no ASCII, a very long word and text."""
    rng = random.Random(5)
    many = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(50)) for _ in range(4000))
    return [
        (1, None), (2, ""), (3, " \t\n "), (None, "one two three four five six"), (5, "one two three four five six"),
        (5, "one two three four five six"), (6, "x" * 50_000), (7, many), (8, many), (9, "éÀß 　 \U0001f600 a\x0bb\x0cc"),
    ]
