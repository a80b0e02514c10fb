"""Decontamination against every window."""

import hashlib
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st

from brute import lower, prose
from txscore.llm.decontaminate import contamination, drop_contaminated, winnow
from txscore.llm.queries import QUERIES
from txscore.llm.words import U64

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items):
    windows = {}
    for item, text in items:
        words = WORD.findall(lower(text or ""))
        size = min(13, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[k:k + size]), set()).add(item)
    result = []
    for i, text in docs:
        words, hit, found = WORD.findall(lower(text or "")), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if own := windows.get(tuple(words[k:k + size])):
                    hit.update(range(k, k + size))
                    found |= own
        names = ",".join(sorted(str(x) for x in found if x is not None))
        result.append((i, len(words), len(hit), len({x for x in found if x is not None}),
                       hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(result, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_matches_every_window(spark, sf_dir, documents):
    items = pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()
    expected = brute(documents, [(x["item_id"], x["text"]) for x in items])
    assert any(r[5] for r in expected)
    assert rows_of(QUERIES["op5_winnowing"](spark, sf_dir)) == expected


ITEMS = [(1, prose(50, 20)), (2, prose(51, 13)), (3, "short item"), (4, None), (5, "!!"), (6, prose(50, 20)),
         (None, prose(52, 15)), (7, "the the the the the the the the the the the the the the")]
DOCS = [(1, prose(60, 30) + " " + prose(50, 20) + ". " + prose(61, 30)), (2, prose(51, 13).upper()),
        (3, "a SHORT, item; here"), (4, " ".join(prose(51, 13).split()[1:])), (5, prose(52, 15)),
        (6, "the " * 40), (7, None), (8, ""), (8, ""), (9, prose(50, 13) + " " + prose(50, 20))]


@pytest.mark.parametrize("index_bytes", [64 << 20, 700])
def test_windows_short_items_and_parts(spark, make_docs, index_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = make_docs(DOCS)
    assert rows_of(contamination(docs, items, index_bytes=index_bytes)) == brute(DOCS, ITEMS)
    kept = sorted(r.doc_id for r in drop_contaminated(docs, items, index_bytes=index_bytes).collect())
    assert kept == sorted(r[0] for r in brute(DOCS, ITEMS) if not r[5])


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, prose(1, 80), "x")], "item_id long, text string, words string")
    rows = contamination(edge_docs, items).collect()
    assert len(rows) == edge_docs.count()
    assert sorted(r.doc_id for r in rows if r.contaminated) == [6, 7, 7, 8]
    assert drop_contaminated(edge_docs, items).columns == edge_docs.columns
    assert contamination(no_docs, items).collect() == []
    assert not any(r.contaminated for r in contamination(edge_docs, items.limit(0)).collect())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=13, max_size=60), st.lists(st.integers(0, 3), max_size=20),
       st.lists(st.integers(0, 3), max_size=20))
def test_shared_windows_share_a_fingerprint(shared, before, after):
    one, other = np.array(shared, U64), np.array([*before, *shared, *after], U64)
    grams = lambda x: {tuple(x[k:k + 5].tolist()) for k in winnow(x)}
    assert grams(one) & grams(other)
