from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, doc string, fp string, h int, n_words string, lang_pred string"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def edge_texts() -> dict[int, str | None]:
    """Texts of odd shapes, copies, near copies and shared passages, by id."""
    rng = random.Random(7)
    out: dict[int, str | None] = {0: None, 1: "", 2: " \n\t ", 3: "one", 4: "One two\tthree", 5: "ONE TWO three", 6: "été 中文 \U0001f600"}
    base = words(rng, 120)
    out |= {10: base, 11: base, 12: base.upper(), 13: base + " tail", 14: "head " + base.replace("w1 ", "x1 ", 1)}
    for i in range(20, 45):  # a chain of edits: linked one by one, not all with all
        parts = base.split()
        for k in range((i - 20) // 2):
            parts[5 * k % 110] = f"e{i // 2}x{k}"
        out[i] = " ".join(parts)
    passage = words(rng, 60)
    for i in range(50, 60):
        out[i] = f"{words(rng, 30)} {passage}\n{words(rng, rng.randrange(50))}"
    out[60] = "a" * 50_000
    out[61] = "a" * 50_000
    out[62] = " ".join(["again"] * 3000)
    out[63] = " ".join(["again"] * 2000) + " end"
    out[64] = words(rng, 8000, 9000)
    out[65] = out[64][2000:30000]
    return out


@pytest.fixture(scope="session")
def edge_docs(spark, edge_texts):
    """Those texts as documents with clashing extra columns; id 10 is there twice."""
    rows = [(i, t, "en", "s", None if t is None else len(t), "n", "d", "f", 1, "x", "y") for i, t in edge_texts.items()]
    rows.append(rows[list(edge_texts).index(10)])
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
