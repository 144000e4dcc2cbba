import random

import pytest

WORDS = "the of and stone river walked quickly over under mountain yellow garden letters written because children".split()


@pytest.fixture
def prose():
    """A function: n invented words from a seed."""

    def make(n: int, seed: int) -> str:
        draw = random.Random(seed)
        return " ".join(draw.choice(WORDS) + draw.choice(["", "s", "ing", "ed", "er"]) for _ in range(n))

    return make
