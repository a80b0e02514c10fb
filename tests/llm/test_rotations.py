"""Near-duplicate vectors against the cosines of all pairs."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from brute import union_smallest
from pyspark.sql import functions as F

from txscore.llm.queries import QUERIES
from txscore.llm.rotations import (Plan, directions, encode, key_plan, least_estimate, near_vectors, rotation,
                                   spanning, units)


CLASHING = ("node", "weight", "key", "key_a", "code", "factor", "keys", "n", "hub", "label", "kept", "component_id")


def plain(rows, least=0.9):
    """Rows (id, n_links, component_id, kept) from all pairs of distinct rows."""
    def taken(i, v):
        return i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    own = sorted({(i, tuple(x + 0.0 for x in v)) for i, v in rows if taken(i, v)})
    links, partners = [], {key: 0 for key in own}
    for dim in {len(v) for _, v in own}:
        some = [key for key in own if len(key[1]) == dim]
        m = np.array([v for _, v in some])
        m = m / np.abs(m).max(axis=1, keepdims=True)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        near = m @ m.T >= least - 1e-12
        np.fill_diagonal(near, False)
        for key, n in zip(some, near.sum(axis=1).tolist()):
            partners[key] = n
        links += [(some[a], some[b]) for a, b in zip(*np.nonzero(near))]
    # Keys are sorted, so the smallest key of a component has its smallest id.
    smallest = {key: least_key[0] for key, least_key in union_smallest(own, links).items()}
    result = []
    for i, v in rows:
        key = (i, tuple(x + 0.0 for x in v)) if taken(i, v) else None
        component = smallest[key] if key else i
        result.append((i, partners[key] if key else 0, component, i is not None and i == component))
    return sorted(result, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def around(rng, centre, cosine, n):
    """Vectors at this cosine to a centre."""
    z = rng.standard_normal((n, len(centre)))
    z -= (z @ centre)[:, None] * centre
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    return cosine * centre + math.sqrt(1 - cosine * cosine) * z


@pytest.fixture(scope="module")
def mixed():
    """Loose and tight groups, chains, copies, and vectors without structure."""
    rng = np.random.default_rng(4)
    d = 32
    free = units(rng.standard_normal((150, d)))
    parts = [free, around(rng, free[0], 0.995, 80), around(rng, free[1], 0.96, 60), around(rng, free[2], 0.94, 40)]
    chain = [free[3]]
    for _ in range(25):
        chain.append(units(around(rng, chain[-1], 0.93, 1))[0])
    parts += [np.array(chain), 3.5 * free[:10], free[4:5].repeat(12, axis=0)]
    vectors = np.concatenate(parts)
    ids = rng.permutation(len(vectors)) * 3
    return [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)]


@pytest.mark.parametrize("block, small", [(512, 32), (512, 2), (7, 4)])
def test_groups_chains_and_copies(spark, mixed, block, small, monkeypatch):
    monkeypatch.setattr("txscore.llm.rotations.SMALL", small)
    df = spark.createDataFrame(mixed, "vec_id long, embedding array<double>").repartition(3)
    got = rows_of(near_vectors(df, plan=Plan(miss=1e-6, block=block)))
    assert got == plain(mixed)


def test_query_over_a_given_table(spark):
    path = "/root/testdata/sf0.01"
    table = pq.read_table(f"{path}/embeddings.parquet")
    rows = list(zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist()))
    assert rows_of(QUERIES["op11_rotation_codes"](spark, path)) == plain(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.3, -0.2, 0.9, 0.1]
    rows = [(1, v), (1, v), (2, v), (3, None), (4, []), (5, [0.0] * 4), (6, [nan, 1.0, 1.0, 1.0]),
            (7, [inf, 1.0, 1.0, 1.0]), (8, [None, 1.0, 1.0, 1.0]), (None, v), (9, [3 * x for x in v]),
            (10, v[:3]), (11, [1.0]), (12, [2.0]), (13, [-1.0]), (14, [0.0, -0.0, 1.0]), (15, [-0.0, 0.0, 1.0]),
            (16, [1e300, 1e300]), (17, [1e-300, 1e-300]), (18, [1.0, 0.0]), (19, v), (19, [-x for x in v]),
            (20, [-x for x in v])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(
        "*", *(F.lit("clash").alias(name) for name in CLASHING), F.lit(2).alias("id"))
    got = near_vectors(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert rows_of(got) == plain(rows)
    assert near_vectors(df.limit(0)).collect() == []
    floats = df.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding")).filter("vec_id > 17")
    assert floats.count() == near_vectors(floats).count()


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(9)
    d = 64
    x = units(rng.standard_normal((20_000, d)))
    for cosine in (0.0, 0.5, 0.9):
        z = units(rng.standard_normal(x.shape))
        z = units(z - (z * x).sum(axis=1, keepdims=True) * x)
        y = cosine * x + math.sqrt(1 - cosine * cosine) * z
        codes, factor = encode(x, 11)
        estimate = ((y @ rotation(d, 11)) * directions(codes)).sum(axis=1) / factor
        error = estimate - cosine
        assert abs(error.mean()) < 4 * error.std() / math.sqrt(len(error))
        assert (estimate >= least_estimate(factor, 128, cosine, 5.0)).all()
        if cosine == 0:  # hardly any pair without likeness is computed anew
            assert (estimate >= least_estimate(factor, 128, 0.9, 5.0)).mean() < 1e-3


def test_pairs_at_the_least_cosine_are_found_as_often_as_planned(spark):
    rng = np.random.default_rng(12)
    x = units(rng.standard_normal((1500, 48)))
    pairs = np.concatenate([x, np.concatenate([around(rng, v, 0.9005, 1) for v in x])])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(pairs)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = near_vectors(df, plan=Plan(miss=0.01)).filter("vec_id >= 1500 and component_id = vec_id - 1500")
    assert found.count() >= 1500 * 0.975
    keys = key_plan(3000, 48, 0.9, 0.01)
    assert keys.parts * 6 + keys.signs >= math.log2(3000)


def test_hot_group_takes_rows_in_proportion(spark, monkeypatch):
    """A tight group is counted, not compared."""
    import txscore.llm.rotations as module

    rng = np.random.default_rng(3)
    centre = units(rng.standard_normal((1, 64)))[0]
    vectors = np.concatenate([around(rng, centre, 0.996, 900), units(rng.standard_normal((900, 64)))])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    written = {}
    original = module.written_table

    def counting(df, name, *more):
        table = original(df, name, *more)
        written[name] = table.count()
        return table

    monkeypatch.setattr(module, "written_table", counting)
    got = rows_of(near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert got == plain(rows)
    # 900 vectors have 404,550 links.
    assert written["balls"] > 800
    assert max(written[name] for name in ("maybe", "with-hubs", "blocks")) < 30_000


def test_spanning_links_connect_what_all_links_connect():
    rng = np.random.default_rng(1)
    for n in (1, 5, 40):
        for share in (0.0, 0.05, 0.3, 1.0):
            a = np.triu(rng.random((n, n)) < share, 1)
            a = a | a.T
            found = spanning(a)
            assert all(a[i, j] for i, j in found) and len(found) < n
            assert union_smallest(range(n), map(tuple, np.argwhere(a))) == union_smallest(range(n), map(tuple, found))
