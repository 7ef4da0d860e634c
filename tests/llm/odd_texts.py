"""Invented prose for tests."""

from __future__ import annotations

import random

SYLLABLES = "the on er ing tion an re at ou st nd ha en or it ed is es".split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(SYLLABLES, k=draw.randint(1, 3))) for _ in range(words))
