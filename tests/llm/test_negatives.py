"""Hard negatives against brute force: clusters, ties, awkward rows, thresholds that must fall."""

import math

import numpy as np
import pytest
from llm_common import importable  # noqa: F401
from pyspark.sql import functions as F

from ledgerlog.llm import negatives


def brute(rows, every, k=5, least=(80, 100)):
    usable = []
    for key, vector, label in rows:
        if key is None or label is None or vector is None or not all(x is not None and math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * x) for x in vector]
        if sum(x * x for x in whole) < 2**62:
            usable.append((key, whole, label))
    out = []
    done = set()
    for key, vector, label in sorted(usable, key=lambda r: (r[0], r[2], np.array(r[1], np.int32).tobytes())):
        if key % every or key in done:
            continue
        done.add(key)
        scored = [(-sum(a * b for a, b in zip(vector, v)), i, g) for i, v, g in usable
                  if i != key and len(v) == len(vector)]
        for s, i, _ in sorted(r for r in scored if r[2] == label)[:k]:
            fits = sorted(r for r in scored if r[2] != label and least[0] * -s <= least[1] * -r[0] <= least[1] * -s)
            out += [(key, i, n + 1, j, -s, -t) for n, (t, j, _) in enumerate(fits[:k])]
    return sorted(out)


def found(spark, rows, every, **kw):
    df = spark.createDataFrame([(k, v, g, 1, "x") for k, v, g in rows],
                               "vec_id bigint, embedding array<double>, label int, id int, anchor string").repartition(3)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % every == 0, **kw).collect())


def clusters(n, dim, labels, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] * 0.3 + rng.choice([0.02, 0.1, 0.3]) * rng.standard_normal(dim)
        rows.append((i, v.tolist(), int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("dim,scale", [(64, 1.0), (37, 100.0), (3, 1.0)])
def test_matches_brute_force(spark, dim, scale):
    rows = [(k, [x * scale for x in v], g) for k, v, g in clusters(500, dim, 4)]
    rows += [(1000 + i, rows[i][1], i % 4) for i in range(100)]
    want = brute(rows, 20)
    assert len(want) > 300 and found(spark, rows, 20) == want


def test_awkward_rows(spark):
    rows = clusters(120, 8, 3, 5)
    rows += [(200, None, 0), (210, [None] + [1.0] * 7, 0), (220, [math.nan] * 8, 1), (230, [math.inf] * 8, 1),
             (240, [0.0] * 8, 0), (250, [0.0] * 8, 1), (260, [1e300] * 8, 1), (270, [1.0] * 5, 0), (280, [2.0] * 5, 0),
             (290, [1.5] * 5, 2), (300, [], 0), (310, [], 1), (320, [], 0), (None, [1.0] * 8, 0), (330, [1.0] * 8, None),
             (340, [2.0**20] * 8, 0), (350, [2.0**20 + 1] * 8, 0), (360, [2.0**20 - 5] * 8, 1), (-10, [0.5] * 8, 0),
             (0, rows[0][1], 1), (0, rows[5][1], 2), (7, rows[7][1], 0), (7, rows[7][1], 0), (370, [-1.0] * 8, 5)]
    assert found(spark, rows, 10) == brute(rows, 10)


def test_hot_group_of_copies(spark):
    """A third of all rows is one vector, under two labels: ties go to the smallest keys."""
    rows = clusters(400, 16, 3, 8)
    rows = [(k, rows[0][1] if k % 3 == 0 else v, k % 2 if k % 3 == 0 else g) for k, v, g in rows]
    assert found(spark, rows, 9) == brute(rows, 9)


def test_thresholds_fall_until_windows_fill(spark, monkeypatch):
    """Skewed scores leave the first guess empty; later rounds must find the rows all the same."""
    monkeypatch.setattr(negatives, "FIRST", 0.01)
    monkeypatch.setattr(negatives, "GROWTH", 8)
    rows = clusters(300, 16, 3, 11)
    assert found(spark, rows, 25) == brute(rows, 25)


def test_index_omits_what_norms_cover():
    rng = np.random.default_rng(1)
    columns = rng.standard_normal((40, 5))
    rest = negatives.suffix_norms(columns)
    assert len(rest) == 4 and not rest[-1].any()
    for i, start in enumerate(range(0, 40, negatives.STRETCH)):
        assert np.allclose(rest[i], np.linalg.norm(columns[start:], axis=0))


def test_few_rows_and_empty(spark):
    assert found(spark, [(0, [1.0, 0.0], 0)], 1) == []
    assert found(spark, [(0, [1.0], 0), (1, [1.0], 0), (2, [0.9], 1)], 2) == [(0, 1, 1, 2, 65536, 58880)]
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    out = negatives.hard_negatives(df, F.lit(True))
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert out.collect() == []
