"""Near duplicates against all pairs."""

import random
import re

import numpy as np
import pytest

from txscore.llm.circulant import (BANDS, ROWS, near_duplicates, permute, signatures)
from txscore.llm.components import components, join_components
from txscore.llm.queries import QUERIES

from brute import lower, union_smallest

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(rows, size=4):
    sets = {}
    for i, text in rows:
        words = WORD.findall(lower(text or ""))
        sets[i] = frozenset(tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[:n]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = union_smallest(ids, links)
    return {i: (len(sets[i]), root[i], root[i] == i) for i in ids}


def rows_of(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_query_matches_all_pairs(spark, sf_dir, documents):
    assert rows_of(QUERIES["op3_circulant_minhash"](spark, sf_dir)) == brute(documents)


@pytest.mark.parametrize("block", [8, 512])
def test_large_group_of_near_copies(make_docs, block):
    """Copies of one text with random edits: many share buckets, only some are linked."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 14)):
            words[rng.randrange(len(words))] = f"e{rng.random()}"
        rows.append((i, " ".join(words)))
    assert rows_of(near_duplicates(make_docs(rows), block=block)) == brute(rows)


def test_edges(edge_docs, no_docs):
    rows = near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by_id[1] == by_id[1][:1] == [(0, 1, True)] and by_id[2] == [(0, 2, True)] and by_id[3] == [(0, 3, True)]
    assert by_id[4] == [(1, 4, True)] and by_id[None] == [(2, None, True)]
    assert by_id[6][0][1:] == (6, True) and by_id[7] == [(77, 6, False)] * 2 and by_id[8][0][1] == 6
    assert near_duplicates(no_docs).collect() == []


def test_second_permutation_is_a_bijection():
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    assert len(np.unique(permute(x, np.empty_like(x)))) == len(x)


def test_coordinates_estimate_similarity():
    rng = np.random.default_rng(3)
    one = rng.integers(1, 1 << 62, 1000).astype(np.uint64)
    other = np.concatenate([one[:800], rng.integers(1, 1 << 62, 200).astype(np.uint64)])
    a, b = signatures([one, other], BANDS * ROWS * 4)
    assert abs((a == b).mean() - 800 / 1200) < 0.06


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(139, 41), (200, 201)]
    ids = {x for link in links for x in link}
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.id: r.component for r in components(df).collect()}
    assert found == union_smallest(ids, links)
    more = join_components(components(df), spark.createDataFrame([(201, 40), (300, 301)], "a long, b long"))
    ids |= {300, 301}
    assert {r.id: r.component for r in more.collect()} == union_smallest(ids, [*links, (201, 40), (300, 301)])
