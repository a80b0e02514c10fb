"""Nearest neighbours against all pairs."""

from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from txscore.llm.forest import _MEETING, Forest, _dealt, nearest_neighbours, planes, strings
from txscore.llm.queries import QUERIES


def brute(rows, nearest=5, step=50):
    vectors = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            vectors.setdefault(i, []).append(np.array(v, np.float64))
    cosine = lambda a, b: float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))
    result = {}
    for q in sorted(i for i in vectors if i % step == 0):
        scored = []
        for i, own in vectors.items():
            values = [cosine(a, b) for a in vectors[q] for b in own if len(a) == len(b)]
            if i != q and values:
                scored.append((-round(max(values), 12), i))
        result[q] = [(i, -s) for s, i in sorted(scored)[:nearest]]
    return result


def rows_of(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


def recall(found, expected):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in own}) for q, own in expected.items())
    return hits / sum(map(len, expected.values()))


def test_query_recall(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/embeddings.parquet")
    expected = brute(list(zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist())))
    found = rows_of(QUERIES["op4_prefix_forest"](spark, sf_dir))
    assert {q: len(own) for q, own in found.items()} == {q: 5 for q in expected}
    assert recall(found, expected) >= 0.9
    for q, own in found.items():
        assert [s for _, s in own] == sorted((s for _, s in own), reverse=True)
        scores = dict(expected[q])
        assert all(abs(scores[i] - s) < 1e-9 for i, s in own if i in scores)


def make(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_groups_parts_and_copies(spark):
    """Small groups, so that prefixes, parts and the way back to whole trees all occur."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.1 * rng.normal(size=8)).tolist()) for i in range(600)]
    rows += [(i, rows[50][1]) for i in range(600, 760)]  # one very common vector
    rows += [(1000, (-centres[0]).tolist())]
    expected = brute(rows)
    found = rows_of(nearest_neighbours(make(spark, rows), forest=Forest(group=16, group_most=24)))
    assert set(found) == set(expected) and all(len(own) == 5 for own in found.values())
    assert recall(found, expected) >= 0.9
    split = rows_of(nearest_neighbours(make(spark, rows), step=10, forest=Forest(group=16, group_most=24)))
    assert recall(split, brute(rows, step=10)) >= 0.9
    assert [i for i, _ in found[50]] == [600, 601, 602, 603, 604] and [i for i, _ in found[600]] == [50, 601, 602, 603, 604]


def test_no_meeting_holds_many_vectors_or_queries(spark):
    """All vectors in one group, every other one a query: both sides are cut, and each query meets
    each vector of the group once."""
    rng = np.random.default_rng(5)
    forest = Forest(trees=2, group=16, group_most=32)
    codes = strings(rng.normal(size=(400, 4)), forest)
    nodes = spark.createDataFrame([(k, 4, row.tolist(), [0.0]) for k, row in enumerate(codes)],
                                  "node long, dim int, codes array<long>, vector array<double>")
    index, own = _dealt(nodes, nodes.filter("node % 2 = 0"), forest, 0)
    left, right = ([tuple(r) for r in df.select(*_MEETING, "node").collect()] for df in (index, own))
    assert max(Counter(r[:-1] for r in left).values()) <= 2 * forest.group_most
    assert max(Counter(r[:-1] for r in right).values()) <= 2 * forest.group_most
    assert len({r[3] for r in left}) == 13 and len({r[4] for r in left}) == 7
    beside = {}
    for *meeting, node in right:
        beside.setdefault(tuple(meeting), []).append(node)
    met = Counter((r[0], r[-1], query) for r in left for query in beside.get(r[:-1], ()))
    assert len(met) == 2 * 400 * 200 and set(met.values()) == {1}


def test_vectors_of_groups_without_queries_stay(spark):
    forest = Forest(trees=1, bits=4)
    nodes = spark.createDataFrame([(k, 4, [k], [0.0]) for k in range(16)],
                                  "node long, dim int, codes array<long>, vector array<double>")
    index, _ = _dealt(nodes, nodes.filter("node = 5"), forest, 2)
    assert sorted(r.node for r in index.collect()) == [4, 5, 6, 7]


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (None, [1.0, 0.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5]), (9, [1.0, 0.0, 0.0]),
            (50, [3.0, -0.0]), (100, [0.0, 0.0])]
    df = make(spark, rows)
    clash = df.selectExpr("*", "'x' as node", "'x' as code", "'x' as id", "'x' as vector", "'x' as part")
    found = rows_of(nearest_neighbours(clash))
    assert {q: [i for i, _ in own] for q, own in found.items()} == {0: [1, 50, 8], 50: [0, 1, 8]}
    assert all(abs(s - 1) < 1e-12 for s in [found[0][0][1], found[0][1][1]])
    assert nearest_neighbours(df.limit(0)).collect() == []
    assert nearest_neighbours(make(spark, [(50, [1.0])])).collect() == []


def test_near_vectors_share_longer_prefixes():
    rng = np.random.default_rng(1)
    one = rng.normal(size=(1, 32))
    near, far = strings(one + 0.05 * rng.normal(size=(1, 32)), Forest())[0], strings(rng.normal(size=(1, 32)), Forest())[0]
    own = strings(one, Forest())[0]
    length = lambda a: np.mean([48 - int(x).bit_length() for x in (a ^ own)])
    assert length(near) > length(far) + 2
    assert np.allclose(planes(32, Forest())[:, :32].T @ planes(32, Forest())[:, :32], np.eye(32))
