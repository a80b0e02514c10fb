"""Repeated byte strings against all windows."""

import hashlib
import random

import numpy as np
import pytest

from txscore.llm.queries import QUERIES
from txscore.llm.suffixes import COVER, PERIOD, anchors, remove_repeats, sample_ranks
from txscore.llm.suffixes import _words
from txscore.llm.words import prefix_hash


def brute(rows, length=200):
    seen = {}
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, raw in raws:
        for k in range(len(raw) - length + 1):
            seen[raw[k:k + length]] = seen.get(raw[k:k + length], 0) + 1
    result = []
    for i, raw in raws:
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if seen[raw[k:k + length]] > 1:
                gone[k:k + length] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        result.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(result, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_query_matches_all_windows(spark, sf_dir, documents):
    expected = brute(documents)
    assert sum(r[2] for r in expected) > 0
    assert rows_of(QUERIES["op7_difference_cover"](spark, sf_dir)) == expected


def text(seed, size):
    return "".join(random.Random(seed).choices("abcé ", k=size))


BASE = text(0, 900)
ROWS = [(1, BASE), (2, text(1, 100) + BASE[100:500] + text(2, 50)), (3, "a" * 700), (4, "aaab" * 100),
        (5, text(3, 30) + BASE[300:480] + text(4, 30)), (6, BASE[300:480]), (7, BASE), (8, ""), (9, text(5, 150)),
        (10, text(6, 20) + BASE[:250] + text(7, 9) + BASE[:250]), (11, None)]


@pytest.mark.parametrize("options", [{}, {"most_contexts": 1}, {"length": 64, "gram": 16}, {"length": 40, "gram": 8}])
def test_overlaps_periods_and_boundaries(make_docs, options):
    assert rows_of(remove_repeats(make_docs(ROWS), **options)) == brute(ROWS, options.get("length", 200))


def test_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert rows_of(remove_repeats(edge_docs)) == brute(rows)
    assert remove_repeats(no_docs).collect() == []


def test_cover_has_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_sample_ranks_are_suffix_order():
    raw = ("ab" * 40 + text(8, 60) + "ab" * 40).encode()
    data = np.frombuffer(raw, np.uint8)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    positions = np.arange(0, len(raw), 3)
    ranks = sample_ranks(_words(padded), positions, np.full(len(positions), len(raw)))
    by_rank = positions[np.argsort(ranks)].tolist()
    assert by_rank == sorted(positions.tolist(), key=lambda p: raw[p:])


def test_every_window_has_one_anchor():
    raw = np.frombuffer(text(9, 1000).encode(), np.uint8)
    _, _, first, last, offset = anchors(*prefix_hash(raw), 0, len(raw), 200, 32)
    assert np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)]).tolist() == list(range(len(raw) - 199))
    assert (offset >= last - first).all() and (offset <= 168).all()
