"""Near-duplicate vectors against all cosines."""

import math

import numpy as np
import pytest

from salesmart.llm import lattice

SCHEMA = "vec_id long, embedding array<float>, rep int, pivot int, cell int, mark int, raw int, row int"


def brute(rows, threshold=0.9):
    usable = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    units = {k: np.array(rows[k][1], np.float32).astype(float) for k in usable}
    units = {k: v / np.linalg.norm(v) for k, v in units.items()}
    links = {k: [] for k in range(len(rows))}
    for i in usable:
        for j in usable:
            if i < j and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold:
                links[i].append(j)
                links[j].append(i)
    out, seen = [], {}
    for k in links:
        if k in seen:
            continue
        group, todo = [], [k]
        while todo:
            x = todo.pop()
            if x not in group:
                group.append(x)
                todo += links[x]
        least = min((rows[g][0] for g in group if rows[g][0] is not None), default=None)
        seen |= dict.fromkeys(group, least)
    for k, (vec, _) in enumerate(rows):
        out.append((vec, len(links[k]), seen[k], vec == seen[k] or seen[k] is None))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) if x is not None else None for x in v] if v is not None else None, 1, 1, 1, 1, 1, 1) for i, v in rows], SCHEMA)


def found(result):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in result.collect()), key=str)


def planted():
    rng = np.random.default_rng(3)
    rows, centres = [], rng.standard_normal((40, 24))
    for k, c in enumerate(centres):
        for m in range(1 + 9 * (k % 4 == 0) + 150 * (k == 0)):
            rows.append((1000 * k + m, (c + rng.standard_normal(24) * (0.02 if m % 2 else 0.12)).tolist()))
    rows += [(50_000 + k, rows[0][1]) for k in range(30)]
    bridge = centres[0] / np.linalg.norm(centres[0])
    other = centres[1] / np.linalg.norm(centres[1])
    rows += [(60_000 + k, (bridge * math.cos(a) + (other - bridge * (bridge @ other)) * math.sin(a) / np.linalg.norm(other - bridge * (bridge @ other))).tolist())
             for k, a in enumerate(np.linspace(0, 1.4, 12))]
    return rows


@pytest.mark.parametrize("block", [lattice.BLOCK, 7])
def test_links_and_components(spark, block):
    """Groups of copies, equal vectors and a chain of neighbours; small blocks deal every group over tasks."""
    rows = planted()
    got, want = found(lattice.near_duplicates(frame(spark, rows), recall=0.9999, block=block)), brute(rows)
    assert got == want


def test_edge_vectors(spark):
    v = [1.0, 2.0, -3.0]
    rows = [(1, v), (2, [2.0, 4.0, -6.0]), (2, v), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [float("nan"), 1.0, 1.0]), (7, [float("inf"), 1.0, 1.0]),
            (8, [None, 1.0, 1.0]), (9, [1.0, 2.0, -3.0, 0.0]), (None, v), (None, [5.0, -1.0, 0.0]), (10, [-1.0, -2.0, 3.0]), (11, [-0.0, 1e-30, 0.0]), (12, [0.0, 1e30, 0.0])]
    assert found(lattice.near_duplicates(frame(spark, rows))) == brute(rows)
    assert found(lattice.near_duplicates(frame(spark, []))) == []


def test_recall_at_the_threshold():
    """Pairs exactly at the threshold share a cell as often as the setting says, at every size."""
    rng = np.random.default_rng(12)
    for n in (1000, 50_000):
        how = lattice.settings(n)
        a, b = rng.standard_normal((2, 600, 64))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= (a * b).sum(1, keepdims=True) * a
        b = 0.9 * a + math.sqrt(0.19) * b / np.linalg.norm(b, axis=1, keepdims=True)
        hit = np.zeros(600, bool)
        for t in range(how.tables):
            plane = rng.standard_normal((64, 8 * how.blocks))
            x, y = (lattice.cell_keys((v @ plane / how.width).reshape(600, how.blocks, 8), how.probes, t) for v in (a, b))
            hit |= (x[:, :, None] == y[:, None, :]).any((1, 2))
        assert hit.mean() >= 0.92


def test_nearest_point():
    """No root vector leads from the nearest point to a nearer one; points are of E8."""
    x = np.random.default_rng(1).standard_normal((500, 8)) * 3
    p = lattice.nearest_e8(x)
    own = ((x - p) ** 2).sum(1)
    for r in lattice.ROOTS:
        assert (((x - p - r) ** 2).sum(1) >= own - 1e-9).all()
    assert np.allclose(p.sum(1) % 2, 0) and np.allclose((2 * p) % 1, 0)
