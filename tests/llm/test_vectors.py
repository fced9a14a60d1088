"""Linked vectors against all cosines."""

from collections import Counter

import numpy as np
import pytest

from tripflow.llm import vector_dedup as v
from tripflow.llm.queries import importable

SCHEMA = "vec_id long, embedding array<double>, label int, node long, cell string"


def awkward():
    draw = np.random.default_rng(2)
    base = draw.standard_normal((4, 16))
    rows = []
    for group, count in ((0, 60), (1, 25), (2, 3), (3, 1)):
        for _ in range(count):
            rows.append((base[group] + 0.035 * draw.standard_normal(16), group % 2))
    rows += [(draw.standard_normal(16), i % 3) for i in range(150)]
    rows += [(base[0], 0)] * 4 + [(3 * base[0], 0), (-base[0], 0), (base[0], 2), (base[0], None)]
    # A chain, each linked with the next alone.
    angles = np.arange(12) * 0.19
    rows += [(np.concatenate(([np.cos(a), np.sin(a)], np.zeros(14))), 7) for a in angles]
    bad = [None, [], [0.0] * 16, [1.0, None], [1.0, float("nan")], [float("inf"), 1.0]]
    lists = [(i, [float(x) for x in vector], label) for i, (vector, label) in enumerate(rows)]
    lists += [(900 + i, vector, 0) for i, vector in enumerate(bad)]
    lists += [(950, [1e200, 2e200], 0), (951, [1e-200, 2e-200], 0), (952, [-0.0, 1.0], 0)]
    lists += [(953, [0.0, 1.0], 0), (953, [1.0, 0.0], 0), (None, [1.0, 0.0], 0)]
    return lists


def usable(vector):
    return (
        vector is not None
        and len(vector) > 0
        and all(x is not None and np.isfinite(x) for x in vector)
        and any(vector)
    )


def brute(rows, cosine=0.98):
    unit = [
        np.array(x) / np.abs(x).max() if usable(x) and label is not None else None
        for _, x, label in rows
    ]
    unit = [x / np.linalg.norm(x) if x is not None else None for x in unit]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for b in range(len(rows)):
        for a in range(b):
            alike = unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2]
            if alike and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[a] += 1
                links[b] += 1
                root[find(b)] = find(a)
    least = {}
    for at, row in enumerate(rows):
        own = [x for x in (least.get(find(at)), row[0]) if x is not None]
        least[find(at)] = min(own, default=None)
    return Counter(
        (row[0], links[at], least[find(at)], row[0] == least[find(at)])
        for at, row in enumerate(rows)
    )


@pytest.mark.parametrize(
    "params",
    [
        v.CollisionParams(),
        v.CollisionParams(leaf_rows=40, halo=5.0),
        v.CollisionParams(leaf_rows=7, halo=5.0, projections=48),
    ],
)
def test_linked_vectors_by_all_cosines(spark, params):
    importable(spark)
    rows = awkward()
    table = spark.createDataFrame([(*row, 1, "c") for row in rows], SCHEMA).repartition(3)
    found = Counter(map(tuple, v.linked_vectors(table, params).collect()))
    assert found == brute(rows)
    assert v.linked_vectors(table.limit(0)).count() == 0


def test_collisions_are_window_meetings():
    at = np.random.default_rng(1).standard_normal((70, 9))
    want = (np.abs(at[:, None] - at[None]) <= 0.3).sum(axis=2)
    assert (v.collisions(at, 10, 40, 0.3) == want[10:40]).all()


def test_enough_collisions_keep_pairs_at_the_threshold():
    params = v.CollisionParams()
    draw = np.random.default_rng(5)
    apart = draw.standard_normal((200_000, params.projections)) * params.distance
    met = (np.abs(apart) <= params.window * params.distance).sum(axis=1)
    assert (met < params.enough).mean() <= 1.5 * params.miss
    far = draw.standard_normal((200_000, params.projections)) * 1.2
    met = (np.abs(far) <= params.window * params.distance).sum(axis=1)
    assert (met >= params.enough).mean() < 1e-4


def test_recall_where_cells_are_cut_many_times(spark):
    """Pairs just above the threshold, in cells of few rows: nine in ten at least are found."""
    draw = np.random.default_rng(8)
    base = draw.standard_normal((600, 24))
    base /= np.linalg.norm(base, axis=1)[:, None]
    side = draw.standard_normal((600, 24))
    side -= (side * base).sum(axis=1)[:, None] * base
    side /= np.linalg.norm(side, axis=1)[:, None]
    near = 0.981 * base + np.sqrt(1 - 0.981**2) * side
    rows = [(i, [*map(float, x)], 1) for i, x in enumerate(np.concatenate([base, near]))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = v.linked_vectors(table, v.CollisionParams(leaf_rows=64)).collect()
    linked = {r.vec_id for r in found if r.component_id == r.vec_id % 600 and r.n_links > 0}
    assert len(linked) >= 0.98 * len(rows)


def test_roots_of_a_chain():
    chain = np.arange(50)
    assert (v.roots(51, [(chain, chain + 1)]) == 0).all()
    assert v.roots(3, []).tolist() == [0, 1, 2]
