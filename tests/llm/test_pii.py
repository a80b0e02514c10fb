"""Personal data: base spans by plain patterns, the field's recursions, and what it adds."""

import hashlib
import itertools
import re
import time

import numpy as np

from txscore.llm.pii import (FEATURES, KINDS, Span, all_spans, base_spans, find_personal_data, fit, learn_field, luhn,
                             marginals, read_region, regions, viterbi)
from txscore.llm.queries import QUERIES


def brute(text):
    digits = lambda x: re.sub("[^0-9]", "", x)
    text = text or ""
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
              if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]
    return [(k, m.start(), m.end()) for k, m in found]


def test_query_matches_plain_patterns(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in QUERIES["op8_semi_markov"](spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    for i, text in documents:
        joined = [f"{k}:{a}:{b}" for k, a, b in brute(text)]
        assert rows[i].base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(filter(None, rows[i].spans.split(",")))
        assert [rows[i][f"n_{k}"] for k in KINDS] == [sum(x.startswith(k) for x in joined) for k in KINDS]


def test_base_spans_of_odd_texts():
    for text in ["a@b.c@d.e x@y a.b@c-d.e.f.", "1.2.3.4.5 999.1.1.1 1.2.3 00001.2.3.04 1.2.3.256", "@@ a@@b.c .@a.b",
                 "+1 (234) 567-8901 +12345678 ++1 2 3 4 5 6 7 8 +(1) 2", "4111-1111 1111-1111 4111  1111 1111 1111",
                 "é" * 3 + "a@b.co", "1" * 300, "+" + "1" * 300, "%" * 300 + "@x.y"]:
        assert [tuple(s) for s in base_spans(text)] == brute(text)


def segmentations(region):
    """Every choice of candidates without overlaps, with their kinds."""
    n = len(region.first)
    for size in range(n + 1):
        for chosen in itertools.combinations(range(n), size):
            spans = sorted((region.first[k], region.last[k]) for k in chosen)
            if all(a[1] < b[0] for a, b in zip(spans, spans[1:])):
                yield from ([*zip(chosen, kinds)] for kinds in itertools.product(range(len(KINDS)), repeat=size))


def test_recursions_match_all_segmentations():
    region = read_region("+12345678 9876543")
    assert 2 <= len(region.first) <= 6
    weights = np.random.default_rng(0).normal(size=(FEATURES, len(KINDS)))
    scores = region.features @ weights
    every = list(segmentations(region))
    totals = np.array([sum(scores[k, kind] for k, kind in s) for s in every])
    share = np.exp(totals - np.logaddexp.reduce(totals))
    expected = np.zeros(scores.shape)
    for s, p in zip(every, share):
        for k, kind in s:
            expected[k, kind] += p
    assert np.allclose(marginals(region, weights), expected)
    best = every[int(totals.argmax())]
    assert sorted(viterbi(region, weights)) == sorted(
        (int(region.first[k]), int(region.last[k]), kind) for k, kind in best)


def test_field_splits_what_the_patterns_run_together():
    numbers = [f"+1 ({200 + k}) 555-{1000 + 7 * k}" for k in range(60)]
    cards = [c for c in (str(4000000000000000 + 12345678901 * k) for k in range(600)) if luhn(c)][:40]
    field = fit([(x, [(0, len(x), "phone")]) for x in numbers] + [(x, [(0, 16, "card")]) for x in cards]
                + [(str(1234567 + k), []) for k in range(30)]
                + [(str(4000000000000001 + k), []) for k in range(30) if not luhn(str(4000000000000001 + k))])
    text = f"call {numbers[3]} {cards[5]} now"
    assert base_spans(text) == []
    spans, base = all_spans(text, field)
    assert base == [] and [(s.kind, text[s.start:s.end]) for s in spans] == [("card", cards[5]), ("phone", numbers[3])]


def test_edges(edge_docs, no_docs):
    rows = find_personal_data(edge_docs, learn_field(edge_docs)).collect()
    assert len(rows) == edge_docs.count()
    found = {r.doc_id: r for r in rows}
    text = next(r.text for r in edge_docs.collect() if r.doc_id == 12)
    assert [tuple(s) for s in found[12].base] == brute(text) != []
    assert found[1].spans == found[2].spans == []
    assert find_personal_data(no_docs, learn_field(no_docs)).collect() == []


def plain_spans(text, weights):
    """All spans with every region and every choice compared with every base span."""
    base = [Span(*s) for s in brute(text)]
    spans = list(base)
    for a, b in regions(text or "") if weights is not None else ():
        if any(s.start <= a and b <= s.end for s in base):
            continue
        region = read_region(text[a:b])
        for i, j, kind in viterbi(region, weights):
            own = Span(KINDS[kind], a + region.bounds[i], a + region.bounds[j + 1])
            if not any(s.start < own.end and own.start < s.end for s in base):
                spans.append(own)
    return sorted(spans, key=lambda s: (KINDS.index(s.kind), s.start))


MORE = "/root/testdata/sf0.01"


def test_whole_query_matches_a_plain_version(spark):
    table = spark.read.parquet(f"{MORE}/documents.parquet")
    weights = learn_field(table)
    assert weights is not None
    rows = {r.doc_id: r.spans for r in QUERIES["op8_semi_markov"](spark, MORE).collect()}
    for i, text in table.select("doc_id", "text").collect():
        assert rows[i] == ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(text, weights))


DENSE = " ".join(f"user{k}@host{k % 7}.example.org, +1 (269) 555-{k % 9000 + 1000}; 10.{k % 250}.3.4 {4000000000000000 + k}"
                 for k in range(24_000))


def test_long_texts_dense_in_hits_take_time_in_proportion(spark):
    weights = learn_field(spark.read.parquet(f"{MORE}/documents.parquet"))
    short = DENSE[:20_000]
    assert all_spans(short, weights)[0] == plain_spans(short, weights)
    assert len(DENSE) > 1_500_000
    started = time.monotonic()
    spans, base = all_spans(DENSE, weights)
    assert len(base) > 60_000 and time.monotonic() - started < 60
