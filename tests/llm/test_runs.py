"""Periodic runs against a version that tries every period at every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from brute import prose

from txscore.llm.queries import QUERIES
from txscore.llm.runs import Run, find_runs, periodic_runs, squared_differences


def plain_runs(x, least=6, times=4):
    found = []
    for q in range(1, len(x) // times + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            own = x[i:j + q]
            if len(own) >= max(least, times * q) and all(
                    any(own[k] != own[k + d] for k in range(len(own) - d)) for d in range(1, q)):
                found.append((i, len(own), q))
            i = max(j, i + 1)
    return sorted(found)


def plain_row(doc_id, text, planted=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if planted and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {k for start, length, q in runs for k in range(start + q, start + length)}
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2] or (
                run[1] * best[2] == best[1] * run[2] and (run[0], run[2]) < (best[0], best[2])):
            best = run
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join("%d,%d,%d\n" % run for run in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def made_up(rng):
    x = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(0, 100))]
    for _ in range(rng.randint(0, 3)):
        own = [rng.randrange(4) for _ in range(rng.randint(1, 25))]
        at = rng.randint(0, len(x))
        x[at:at] = own * rng.randint(2, 6) + own[:rng.randint(0, len(own))]
    return x


def test_all_runs_of_many_made_up_texts():
    rng = random.Random(5)
    for _ in range(400):
        texts = [made_up(rng) for _ in range(rng.randint(1, 4))]
        ends, wanted, before = np.cumsum([len(x) for x in texts]), [], 0
        for x in texts:
            wanted += [Run(i + before, length, q) for i, length, q in plain_runs(x)]
            before += len(x)
        assert find_runs(np.array(sum(texts, []), np.int64), ends) == wanted


def test_no_run_reaches_over_the_end_of_a_text():
    assert find_runs(np.zeros(10, np.int64), [5, 10]) == []
    assert find_runs(np.zeros(12, np.int64), [6, 12]) == [Run(0, 6, 1), Run(6, 6, 1)]


@pytest.mark.parametrize("q", [1, 2, 3, 4, 5, 10, 11, 20, 21, 42, 43, 85, 1000])
def test_least_length_of_each_scale(q):
    own = list(range(1, q + 1))
    for left in range(4):
        x = [-k for k in range(left)] + (own * 6)[:max(6, 4 * q)] + [99999, 99998]
        assert [r[1:] for r in find_runs(np.array(x) + 5, [len(x)])] == [(max(6, 4 * q), q)]
        short = x[:left] + x[left + 1:]
        assert not find_runs(np.array(short) + 5, [len(short)])


def test_sums_are_exact_integers():
    rng = np.random.default_rng(2)
    for block in (2, 8, 64, 512):
        most = int(((15 * 2 ** 27) // block) ** 0.5)
        blocks = rng.integers(0, most, (5, block)).astype(np.uint64)
        windows = rng.integers(0, most, (5, 2 * block)).astype(np.uint64)
        blocks[0], windows[0] = 0, most - 1  # the largest sum there can be
        got = squared_differences(blocks, windows, block // 2)
        for k in range(5):
            for d in range(block // 2):
                gap = blocks[k].astype(int) - windows[k, d:d + block].astype(int)
                assert got[k, d] == int((gap * gap).sum())


def test_long_texts_of_one_run_and_of_none():
    n = 200_000
    assert find_runs(np.zeros(n, np.int64), [n]) == [Run(0, n, 1)]
    assert find_runs(np.arange(n) % 997, [n]) == [Run(0, n, 997)]
    assert find_runs(np.arange(n) % 50_001, [n]) == []
    assert find_runs(np.arange(n), [n]) == []


def test_query_over_the_small_table(spark, sf_dir, documents):
    got = rows_of(QUERIES["op12_block_convolution"](spark, sf_dir))
    assert got == sorted((plain_row(*row) for row in documents), key=str)
    assert sum(row[1] > 0 for row in got) > 5


def test_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect() if len(r.text or "") < 10_000]
    short = edge_docs.filter("text is null or length(text) < 10000")
    for planted in (True, False):
        assert rows_of(periodic_runs(short, planted)) == sorted(
            (plain_row(*row, planted) for row in rows), key=str)
    assert periodic_runs(edge_docs).count() == edge_docs.count()
    assert periodic_runs(no_docs).collect() == []


def test_ties_texts_and_spans(make_docs):
    text = "x  y\t" + "a b " * 4 + "c d " * 4 + "z z   " + prose(4, 5) + " w" * 7
    row = periodic_runs(make_docs([(1, text)])).first()
    assert [tuple(r) for r in row.runs] == [(2, 8, 2), (10, 8, 2), (25, 7, 1)]
    assert (row.start, row.period, row.exponent_milli) == (25, 1, 7000)
    assert row.collapsed == "x y a b c d z z   " + prose(4, 5) + " w"
    tie = periodic_runs(make_docs([(1, "a b a b a b a b " + "c d " * 4)])).first()
    assert (tie.n_runs, tie.start, tie.period) == (2, 0, 2)
