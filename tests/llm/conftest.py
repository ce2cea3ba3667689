from __future__ import annotations

import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(f"{rng.choice(WORDS)}{rng.randint(0, 60)}" for _ in range(n))


@pytest.fixture(scope="session")
def make(spark):
    """A documents table of (doc_id, text) or (doc_id, text, lang) rows, with extra columns of clashing names."""

    def table(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None, 1, "x", 2, "y") for r in rows]
        return spark.createDataFrame(full, DDL + ", fp int, th string, lines_removed int, component_id string")

    return table
