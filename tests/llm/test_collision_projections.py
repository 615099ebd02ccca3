import math
import random

import numpy as np
import pytest

from tablewright.llm.collision_projections import Projections, near_vectors
from tests.llm.support import CLASHES, roots


def test_needed_count_is_calibrated():
    rule = Projections.calibrated(0.93)
    rng = np.random.default_rng(3)
    apart = rng.normal(size=(20_000, rule.n_lines)) * math.sqrt(2 - 2 * 0.93)
    hits = (np.abs(apart) <= rule.window).sum(axis=1)
    assert (hits >= rule.needed).mean() >= 0.9995
    assert (hits >= rule.needed + 3).mean() < 0.9995


def pairs_at(cosine, n, dims, rng):
    x = rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = rng.normal(size=(n, dims))
    y -= (x * y).sum(axis=1)[:, None] * x
    y /= np.linalg.norm(y, axis=1)[:, None]
    return x, cosine * x + math.sqrt(1 - cosine**2) * y


@pytest.mark.parametrize("n_vectors", [50, 5000, 200_000])
def test_pairs_at_the_threshold_meet_and_collide(n_vectors):
    """Nearly all of them, though the lines of a table grow with the number of vectors."""
    rule = Projections.calibrated(0.93, n_vectors=n_vectors)
    x, y = pairs_at(0.93, 2000, 64, np.random.default_rng(4))
    (a, p), (b, q) = rule.places(x), rule.places(y)
    assert p.shape == (2000, rule.tables)
    assert (p == q).any(axis=1).mean() > 0.995
    assert (rule.collisions(a, b) >= rule.needed).mean() > 0.995
    exact = np.abs((x - y) @ rule.lines(64)[0][:, : rule.n_lines]) <= rule.window
    assert (rule.collisions(a, b) >= exact.sum(axis=1)).all()


def test_vectors_meet_few_others_by_chance():
    """A stated share of all pairs, which falls as the number of vectors grows."""
    rng = np.random.default_rng(5)
    met = []
    for n in (500, 2000, 8000):
        units = rng.normal(size=(n, 64))
        _, buckets = Projections.calibrated(0.93, n_vectors=n).places(units / np.linalg.norm(units, axis=1)[:, None])
        sizes = [np.unique(column, return_counts=True)[1] for column in buckets.T]
        met.append(sum(float((s * (s - 1)).sum()) for s in sizes) / n)
    assert max(met) < 100 and met[2] < 3 * met[0]
    assert met[2] / 8000 < 0.02


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(40):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 9))):
            v = base + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.25])
            rows.append((rng.integers(0, 3).item(), (v * rng.choice([0.01, 1.0, 1e3])).tolist()))
    rows += [
        (None, [1.0] * 16),
        (0, None),
        (0, []),
        (0, [0.0] * 16),
        (0, [float("nan")] + [1.0] * 15),
        (0, [float("inf")] + [1.0] * 15),
        (0, [None] + [1.0] * 15),
        (1, [1.0] * 16),
        (1, [2.0] * 16),
        (1, [1.0] * 8),
        (2, [1e300] * 16),
        (2, [1e-300] * 16),
    ]
    return [(i, *row) for i, row in enumerate(rows)]


def table(spark, rows):
    kinds = ", ".join(f"`{c}` string" for c in CLASHES if c != "label")
    more = [None] * (len(CLASHES) - 1)
    return spark.createDataFrame(
        [(*row, *more) for row in rows], f"vec_id long, label int, embedding array<double>, {kinds}"
    ).repartition(3)


def usable(label, v):
    return label is not None and v and None not in v and np.isfinite(v).all() and any(v)


def expected_links(rows):
    out = []
    for i, (a, label, v) in enumerate(rows):
        for b, other, w in rows[:i]:
            if label == other and usable(label, v) and usable(other, w) and len(v) == len(w):
                x, y = (np.array(u) / np.abs(u).max() for u in (v, w))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
                    out.append((a, b))
    return out


def held_against_all_pairs(spark, rows, **more):
    links = expected_links(rows)
    root = roots([r[0] for r in rows], links)
    got = {r.vec_id: r for r in near_vectors(table(spark, rows), **more).collect()}
    assert len(got) == len(rows)
    for key, r in got.items():
        assert r.n_links == sum(key in pair for pair in links), key
        assert (r.component_id, r.kept) == (root[key], root[key] == key)


def test_all_pairs(spark):
    rows = vectors(1)
    random.Random(1).shuffle(rows)
    assert len(expected_links(rows)) > 50
    held_against_all_pairs(spark, rows)


def test_crowded_cells(spark):
    rows = vectors(2)
    held_against_all_pairs(spark, rows, block_vectors=9)


def test_many_vectors_of_one_label(spark):
    """Recall over all links of a table with one label, copies and a crowd of near copies."""
    rng = np.random.default_rng(7)
    base = rng.normal(size=(6000, 32))
    near = base[:1500] + rng.normal(size=(1500, 32)) * 0.25
    crowd = base[0] + rng.normal(size=(400, 32)) * 0.15
    x = np.concatenate([base, near, crowd, np.repeat(base[1:2], 300, axis=0)])
    df = spark.createDataFrame([(i, 1, v) for i, v in enumerate(x.tolist())], "vec_id long, label int, embedding array<double>")
    units = x / np.linalg.norm(x, axis=1)[:, None]
    links = np.zeros(len(x), int)
    for i in range(0, len(x), 500):
        links[i : i + 500] = (units[i : i + 500] @ units.T >= 0.93).sum(axis=1) - 1
    got = np.zeros(len(x), int)
    for r in near_vectors(df, block_vectors=128).collect():
        got[r.vec_id] = r.n_links
    assert (got <= links).all() and got.sum() >= 0.999 * links.sum()


def test_ids_null_and_repeated(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(None, 1, v), (5, 1, v), (5, 1, v), (7, 1, [-1.0, 0.0, 0.0]), (None, 2, v)]
    got = sorted(
        (r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in near_vectors(table(spark, rows)).collect()
    )
    assert got == [(0, 0, 0, True), (0, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (7, 0, 7, True)]


def test_no_rows(spark):
    assert near_vectors(table(spark, [])).collect() == []
