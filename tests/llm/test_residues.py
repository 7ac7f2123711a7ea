"""Hard negatives: exact products, windows, and every awkward row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feira.llm import residue_negatives


@pytest.mark.parametrize("size", [3, 300, 2**20, 2**26])
def test_products_are_exact(size):
    rng = np.random.default_rng(size)
    for dim in (1, 64, 300):
        a, b = (rng.integers(-size, size, (n, dim), endpoint=True) for n in (7, 11))
        a[0], b[0], b[1] = size, size, -size
        assert (residue_negatives.Products(a, b).of(0, 7) == a @ b.T).all()


def test_products_beyond_64_bits_are_refused():
    big = np.full((1, 4), 2**31)
    with pytest.raises(ValueError, match="64 bits"):
        residue_negatives.Products(big, big)


def brute(rows, every):
    vectors = [(k, label, [int(np.floor(256 * float(x))) for x in v]) for k, v, label in rows
               if k is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for k, label, x in {(k, label, tuple(x)) for k, label, x in vectors if k % every == 0}:
        scored = [(-sum(a * b for a, b in zip(x, y)), d, other) for d, other, y in vectors if d != k and len(y) == len(x)]
        for s, p, _ in sorted(t for t in scored if t[2] == label)[:5]:
            window = sorted(t[:2] for t in scored if t[2] != label and 80 * -s <= 100 * -t[0] <= 100 * -s)[:5]
            out += [(k, p, n + 1, d, -s, -t) for n, (t, d) in enumerate(window)]
    return sorted(out)


def frame(spark, rows):
    made = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return made.withColumns({"id": F.lit("x"), "ask": F.lit(1), "rank": F.lit(0), "positives": F.lit(2)}).repartition(3)


def found(spark, rows, every):
    return sorted(tuple(r) for r in residue_negatives.mine(frame(spark, rows), every).collect())


def test_negatives_agree_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(residue_negatives, "VECTORS_AT_ONCE", 40)
    monkeypatch.setattr(residue_negatives, "ANCHORS_AT_ONCE", 7)
    monkeypatch.setattr(residue_negatives, "SCORES_AT_ONCE", 100)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 6))
    rows = [(k, [float(np.float32(x)) for x in centres[k % 5] + rng.normal(size=6) * 0.3], int(k % 3) if k % 3 else int(k % 4)) for k in range(300)]
    rows += [(k, rows[0][1], k % 4) for k in range(300, 400)]  # many equal vectors
    rows += [(600, None, 1), (610, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (620, [float("nan")] * 6, 1), (630, [float("-inf")] * 6, 1), (640, [], 1),
             (None, rows[1][1], 1), (650, rows[1][1], None), (660, [1.0, 2.0], 1), (661, [0.5, 1.0], 1), (662, [0.5, 1.0], 2), (670, [1.0], 1),
             (-10, rows[3][1], 2), rows[10], rows[10], (20, rows[7][1], 3), (30, [0.0] * 6, 2)]
    got = found(spark, rows, 10)
    assert got == brute(rows, 10) and len(got) > 300 and any(r[0] == 660 for r in got)
    assert found(spark, [], 10) == [] and found(spark, rows[:1], 10) == []


def test_one_hot_id(spark, monkeypatch):
    """A third of the rows have one id, and another third one vector."""
    monkeypatch.setattr(residue_negatives, "VECTORS_AT_ONCE", 16)
    rng = np.random.default_rng(1)
    rows = [(5 if k % 3 == 0 else k, [1.0, 0.5] if k % 3 == 1 else rng.normal(size=2).astype(np.float32).tolist(), k % 2) for k in range(120)]
    assert found(spark, rows, 5) == brute(rows, 5)
