import numpy as np
import pytest

from helpers import smallest_reachable
from opsledger.llm import cross_polytope

INF, NAN = float("inf"), float("nan")


def brute(vectors, cosine=0.9):
    """(links, smallest reachable) of plain cosines in double precision."""
    sound = {}
    for i, v in vectors:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            sound[i] = np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float))
    pairs = [(i, j) for i in sound for j in sound if i < j and len(sound[i]) == len(sound[j]) and sound[i] @ sound[j] >= cosine]
    links = {i: 0 for i, _ in vectors}
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    return links, smallest_reachable([i for i, _ in vectors], pairs)


def test_the_transform_keeps_lengths_and_inverts_itself():
    x = np.random.default_rng(1).normal(size=(5, 64))
    y = cross_polytope.hadamard(x)
    np.testing.assert_allclose(np.linalg.norm(y, axis=1), np.linalg.norm(x, axis=1))
    np.testing.assert_allclose(cross_polytope.hadamard(y), x)


@pytest.mark.parametrize("block", [512, 20])
def test_links_of_a_crowd_and_of_odd_rows(spark, monkeypatch, block):
    """A crowd of near equal vectors, copies, scaled copies, and rows that link with nothing."""
    monkeypatch.setattr(cross_polytope, "BLOCK", block)
    draw = np.random.default_rng(7)
    center = draw.normal(size=32)
    rows = [(k, (center + 0.25 * draw.normal(size=32)).astype(np.float32).tolist()) for k in range(70)]
    rows += [(100 + k, draw.normal(size=32).astype(np.float32).tolist()) for k in range(60)]
    rows += [(200 + k, rows[80][1]) for k in range(5)] + [(210, [2 * x for x in rows[90][1]])]
    rows += [(300, None), (301, []), (302, [0.0] * 32), (303, [NAN] * 32), (304, [INF] + [1.0] * 31), (305, [None] + [1.0] * 31), (306, rows[0][1][:16]), (307, [1.0, 0.0]), (308, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, None, 3) for i, v in rows], "vec_id long, embedding array<float>, label int, n_links int")
    links, component = brute(rows)
    found = cross_polytope.near_vectors(df).collect()
    assert len(found) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == {i: (links[i], component[i], component[i] == i) for i, _ in rows}


def test_null_ids_and_an_empty_table(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id or 0, r.n_links, r.kept) for r in cross_polytope.near_vectors(df).collect()) == [(0, 0, True), (1, 0, True)]
    assert cross_polytope.near_vectors(df.limit(0)).collect() == []


def test_recall_at_the_threshold():
    """Pairs of cosine 0.9 exactly meet in a bucket nearly always, random ones hardly ever."""
    draw, rule = np.random.default_rng(3), cross_polytope.Rule()
    x = draw.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = draw.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    keys = [cross_polytope.bucket_keys(v, rule) for v in (x, 0.9 * x + np.sqrt(1 - 0.81) * z, z)]
    meet = [(keys[0][:, :, None] == k[:, None, :]).any(axis=(1, 2)).mean() for k in keys[1:]]
    assert meet[0] > 0.97 and meet[1] < 0.02
