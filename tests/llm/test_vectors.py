"""Operators on vectors, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright import llm
from tablewright.llm import neighbours, vectordup
from tablewright.llm.components import components

NAN, INF = float("nan"), float("inf")
ODD = [(9001, None, 1), (9002, [0.0] * 8, 1), (9003, [NAN] + [1.0] * 7, 1), (9004, [INF] + [1.0] * 7, 1), (9005, [None] + [1.0] * 7, 1),
       (9006, [], 1), (None, [1.0] * 8, 1), (9007, [1.0] * 5, 1), (9008, [1.0] * 5, 1), (9010, [1.0] * 8, None)]


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for name in ("id", "vec", "tab", "share", "cell", "tile", "rep", "size", "component"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def cloud(seed=0, n=300, dim=8):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((12, dim))
    points = centres[draw.integers(0, 12, n)] + draw.standard_normal((n, dim)) * 0.25
    points[5::50] = points[4]  # equal vectors
    return [(int(i), [float(x) for x in np.float32(p)], int(i % 3)) for i, p in enumerate(points)]


def test_links_and_components(spark):
    rows = cloud() + ODD
    good = {i: (np.array(v), l) for i, v, l in cloud() + [(9007, [1.0] * 5, 1), (9008, [1.0] * 5, 1)]}
    reach, links = {i: i for i in good}, dict.fromkeys(good, 0)

    def root(i):
        while reach[i] != i:
            i = reach[i]
        return i
    for a, (x, lx) in good.items():
        for b, (y, ly) in good.items():
            if a != b and lx == ly and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                links[a] += 1
                reach[max(root(a), root(b))] = min(root(a), root(b))
    assert sum(links.values()) > 300
    found = vectordup.near_duplicates(vectors(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        i = r["vec_id"]
        expected = (links[i], root(i), root(i) == i) if i in good else (0, i, True)
        assert (r["n_links"], r["component_id"], r["kept"]) == expected, i


def test_vectors_of_one_id_have_links_of_their_own(spark):
    rows = [(5, [1.0, 0.01, 0.0], 1), (5, [0.0, 0.0, 1.0], 1), (7, [1.0, 0.0, 0.0], 1)]
    found = vectordup.near_duplicates(vectors(spark, rows)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found) == [(5, 0, 5, True), (5, 1, 5, True), (7, 1, 5, False)]


def test_tiles_give_up_only_what_cannot_link():
    draw = np.random.default_rng(3)
    a, b = draw.standard_normal((40, 30)), draw.standard_normal((50, 30))
    b[:20] = a[:20] + draw.standard_normal((20, 30)) * 0.3
    cosine = (a @ b.T) / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)
    axes = vectordup.principal_axes(a)
    for threshold in (-0.2, 0.5, 0.93):
        assert (vectordup.linked(a, b, axes, threshold) == (cosine >= threshold)).all()


def test_vectors_of_nothing(spark):
    empty = vectors(spark, [])
    assert vectordup.near_duplicates(empty).count() == 0
    assert neighbours.nearest(empty, "id % 2 = 0").count() == 0


def brute(rows, asked, k):
    good = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = min(good.get(i, v), v)
    return {q: sorted((float(np.sqrt(((np.array(v) - np.array(good[q])) ** 2).sum())), i) for i, v in good.items()
                      if i != q and len(v) == len(good[q]))[:k] for q in good if asked(q)}


def test_neighbours_of_a_small_table_and_of_odd_rows(spark):
    rows = cloud(1, 60) + ODD + [(3, [0.0] * 7 + [1.0], 0)]
    found = neighbours.nearest(vectors(spark, rows), "id % 3 = 0 or id = 9008").collect()
    expected = brute(rows, lambda i: i % 3 == 0 or i == 9008, 10)
    hits = 0
    for q, near in expected.items():
        mine = sorted((r["rank"], r["score"], r["vec_id"]) for r in found if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, len(near) + 1))
        hits += len({m[2] for m in mine} & {i for _, i in near})
    assert hits >= 0.9 * len(found)
    assert {r["query_id"] for r in found} <= set(expected)


def test_a_query_without_neighbours_in_its_cells_is_compared_with_all(spark):
    rows = [(0, [1000.0, 0.0, 0.0], 0)] + [(i, [float(i), 1.0, 0.0], 0) for i in range(1, 40)]
    found = neighbours.nearest(vectors(spark, rows), "id = 0").collect()
    assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"])] == list(range(39, 29, -1))


def test_recall(spark):
    folder = "/root/testdata/sf0.1"
    found = llm.queries()["op3_nearest_neighbours"](spark, folder).collect()
    rows = [(r["vec_id"], list(r["embedding"]), 0) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    expected = brute(rows, lambda i: i % 100 == 0, 10)
    hits = sum(len({r["vec_id"] for r in found if r["query_id"] == q} & {i for _, i in near}) for q, near in expected.items())
    assert len(found) == 10 * len(expected) and hits >= 0.9 * len(found)


def test_probes_come_in_order_of_cost():
    place = np.random.default_rng(0).uniform(0, 5, 8)
    cells = neighbours.probe_cells(place, 60)
    inside = place - np.floor(place)
    steps = cells - np.floor(place).astype(int)
    cost = np.where(steps < 0, inside ** 2, np.where(steps > 0, (1 - inside) ** 2, 0)).sum(axis=1)
    assert len({tuple(c) for c in cells}) == 60 and (np.diff(cost) >= -1e-12).all()


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(30)], [(0, i) for i in range(1, 50)], [(5, 3), (3, 5), (9, 9), (8, 7)],
                                   [(i, (i * 7) % 41) for i in range(41)]])
def test_components(spark, edges):
    reach = {}
    for a, b in edges:
        if a != b:
            reach.setdefault(a, a), reach.setdefault(b, b)
            while reach[a] != a:
                a = reach[a]
            while reach[b] != b:
                b = reach[b]
            reach[max(a, b)] = min(a, b)

    def root(i):
        return i if reach[i] == i else root(reach[i])
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == {i: root(i) for i in reach}
