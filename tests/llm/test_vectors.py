import numpy as np

from wardline.llm import common
from wardline.llm.vectors import hadamard, local_roots, near_vectors


def brute(rows, least=0.95):
    good = {}
    for i, (key, v) in enumerate(rows):
        if key is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            a = np.asarray(v, np.float32).astype(float)
            good[i] = a / np.linalg.norm(a)
    links = {i: [j for j in good if j != i and len(good[i]) == len(good[j]) and good[i] @ good[j] >= least] for i in good}
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((key, len(links.get(i, ())), low))
    return out


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(common, "BLOCK", 40)  # groups of several blocks
    r = np.random.default_rng(2)
    rows = []
    for c in range(30):
        centre = r.normal(size=24)
        rows += [(len(rows) + i, (centre + r.normal(size=24) * 0.22).tolist()) for i in range(1 + 4 * (c % 5))]
    hot = r.normal(size=24)
    rows += [(1000 + i, (hot + r.normal(size=24) * 0.05).tolist()) for i in range(150)]
    rows += [(2000 + i, hot.tolist()) for i in range(20)] + [(2000, hot.tolist())]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 24), (3003, [float("nan")] * 24), (3004, [None] * 24), (3005, [float("inf")] + [1.0] * 23), (None, hot.tolist()), (3006, [1.0]), (3007, [2.0]), (3008, [-1.0]), (3009, [1e30] * 24)]
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "vec_id long, embedding array<float>, id int, e string")
    got = [(x["vec_id"], x["n_links"], x["component_id"]) for x in near_vectors(df).collect()]
    key = lambda t: tuple(-1 if v is None else v for v in t)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert near_vectors(df.limit(0)).count() == 0


def test_hadamard_is_orthogonal():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose(hadamard(hadamard(x)), 64 * x)


def test_local_roots():
    assert local_roots(np.array([4, 3, 1]), np.array([3, 2, 0]), 6).tolist() == [0, 0, 2, 2, 2, 5]


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 400)] + [(500, 500)]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 400)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
