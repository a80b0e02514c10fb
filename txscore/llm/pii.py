"""Personal data: fixed patterns, and a semi-Markov conditional random field.

The patterns give the base spans. The field is learned from them on a bounded sample of
regions, and reads every region of every text: it scores whole candidate spans for each kind by
features of the whole span, and dynamic programming over ends and bounded span lengths chooses
boundaries and kinds jointly. Spans it chooses that touch no base span are added; base spans
always stay.

A region is a stretch that can hold a candidate: an address around an @, or a run of digits and
the characters numbers are written with, with at least `LEAST_DIGITS` digits. Everything
outside of regions can only be unlabelled, so the regions of a text are independent.

Defined results: null and empty texts have no spans; texts are read whole, of any length; equal
scores prefer unlabelled text, then the shorter span, then the kind listed first; without
anything to learn from, nothing is added; an empty table gives no rows. Repeated rows and null
ids are read like others. Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txscore.llm.tasks import clean_table, map_batches, written_table

KINDS = ("email", "ip", "card", "phone")
#: Regions the field is learned from (per kind of content), passes over them, and step size.
EXAMPLES, PASSES, STEP = 150, 12, 0.3
#: Characters up to which a region is an example.
EXAMPLE_CHARS = 400
#: Bounds of a candidate span: atoms, and digits where there is no @.
MOST_ATOMS, LEAST_DIGITS = 24, 7

# The contract's patterns: fixed values.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NUMBERS = re.compile(r"[0-9+(][0-9+().\x20/-]{6,}")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]*@[A-Za-z0-9._%+@-]*")
_ATOM = re.compile(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if k % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses, found from each @, so that long runs are read once."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
        free = m.end() if m else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by kind as listed, then by start."""
    spans = [Span("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if "." in text:
        spans += [Span("ip", m.start(), m.end()) for m in _IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                         for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(Span("card", m.start(), m.end()))
    if "+" in text:
        spans += [Span("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                  if 8 <= len(_digits(m.group())) <= 15]
    return spans


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches that can hold a candidate, without overlaps."""
    found = [(m.start(), m.end()) for m in _NUMBERS.finditer(text)
             if len(_digits(m.group())) >= LEAST_DIGITS]
    if "@" in text:
        found += [(m.start(), m.end()) for m in _ADDRESS.finditer(text)]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


class Region(NamedTuple):
    """Atoms of a region and its candidate spans: first and last atom, and features."""

    bounds: list[int]
    first: np.ndarray
    last: np.ndarray
    features: np.ndarray


FEATURES = 25


def features(span: str, before: str, after: str) -> list[bool]:
    """What the whole span, and the characters beside it, look like."""
    digits = _digits(span)
    n = len(digits)
    address = "@" in span
    local, _, domain = span.partition("@")
    labels = domain.split(".")
    whole_domain = address and len(labels) > 1 and all(labels) and not set(domain) & set("@_%+")
    parts = span.split(".")
    quad = len(parts) == 4 and all(p.isdigit() for p in parts)
    number = not address
    plain = number and set(span) <= set("0123456789 -")
    dialled = number and set(span) <= set("0123456789 ().+-") and "+" not in span[1:]
    odd = "  " in span or "--" in span
    return [
        True, address, bool(address and local and whole_domain),
        bool(address and not (local and whole_domain)),
        address and bool(before) and before in _LOCAL_CHARS,
        address and (after[:1].isalnum() or after[:1] == "-"),
        address and after[:1] == "." and after[1:].isalnum(),
        quad, quad and all(len(p) <= 3 and int(p) <= 255 for p in parts),
        quad and not all(len(p) <= 3 and int(p) <= 255 for p in parts),
        number and bool(before) and before.isdigit(), number and after[:1].isdigit(),
        number and after[:1] in (".", "-"), plain and 16 <= n <= 19 and not odd,
        plain and 16 <= n <= 19 and luhn(digits) and not odd,
        plain and 16 <= n <= 19 and not luhn(digits), plain and not 16 <= n <= 19,
        dialled and span[:1] == "+" and 8 <= n <= 15, dialled and span[:1] == "+",
        dialled and span[:1] != "+", number and not dialled, number and n < 8,
        number and 8 <= n <= 15, number and n > 19, span[:1] in "( " or span[-1:] in " (.-",
    ]


def read_region(text: str) -> Region:
    """The candidates of one region: addresses with one @, and numbers without letters."""
    atoms = list(_ATOM.finditer(text))
    bounds = [m.start() for m in atoms] + [len(text)]
    kinds = ["@" if m.group() == "@" else "d" if m.group()[0].isdigit() and m.group().isascii()
             else "a" if m.group().isalpha() and m.group().isascii() else m.group() for m in atoms]
    first, last, rows = [], [], []
    for i, kind in enumerate(kinds):
        if kind not in ("d", "a", "+", "("):
            continue
        ats = letters = digits = 0
        for j in range(i, min(i + MOST_ATOMS, len(atoms))):
            own = kinds[j]
            ats += own == "@"
            letters += own == "a"
            digits += bounds[j + 1] - bounds[j] if own == "d" else 0
            if ats > 1 or own in " ()/" and (ats or letters):
                break
            if own in ("d", "a", ")") and (ats or not letters and digits >= LEAST_DIGITS):
                a, b = bounds[i], bounds[j + 1]
                first.append(i)
                last.append(j)
                rows.append(features(text[a:b], text[a - 1:a] if a else "", text[b:b + 2]))
    return Region(bounds, np.array(first, np.int64), np.array(last, np.int64),
                  np.array(rows, np.float64).reshape(-1, FEATURES))


def _by_end(region: Region) -> list[list[int]]:
    ends: list[list[int]] = [[] for _ in region.bounds]
    for k, j in enumerate(region.last.tolist()):
        ends[j + 1].append(k)
    return ends


def viterbi(region: Region, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """The best segmentation: (first atom, last atom, kind) of its labelled spans."""
    if not len(region.first):
        return []
    scores = region.features @ weights
    kind, score = scores.argmax(axis=1), scores.max(axis=1)
    best, back = [0.0], [-1]
    for end, spans in enumerate(_by_end(region)[1:], 1):
        value, choice = best[end - 1], -1
        for k in sorted(spans, key=lambda k: -region.first[k]):
            if best[region.first[k]] + score[k] > value + 1e-12:
                value, choice = best[region.first[k]] + score[k], k
        best.append(value)
        back.append(choice)
    chosen, at = [], len(best) - 1
    while at > 0:
        k = back[at]
        if k >= 0:
            chosen.append((int(region.first[k]), int(region.last[k]), int(kind[k])))
        at = int(region.first[k]) if k >= 0 else at - 1
    return chosen[::-1]


def marginals(region: Region, weights: np.ndarray) -> np.ndarray:
    """Probability of each candidate span and kind, by the forward-backward recursions."""
    scores = region.features @ weights
    ends = _by_end(region)
    n = len(ends)
    total = np.logaddexp.reduce(scores, axis=1)
    starts: list[list[int]] = [[] for _ in range(n)]
    for k, i in enumerate(region.first.tolist()):
        starts[i].append(k)
    forward, backward = np.zeros(n), np.zeros(n)
    for end in range(1, n):
        forward[end] = np.logaddexp.reduce(
            [forward[end - 1], *(forward[region.first[k]] + total[k] for k in ends[end])])
    for start in range(n - 2, -1, -1):
        backward[start] = np.logaddexp.reduce(
            [backward[start + 1], *(backward[region.last[k] + 1] + total[k] for k in starts[start])])
    return np.exp(forward[region.first, None] + scores + backward[region.last + 1, None] - forward[-1])


def fit(examples: list[tuple[str, list[tuple[int, int, str]]]]) -> np.ndarray | None:
    """Weights that maximise the likelihood of labelled regions (text, spans of it)."""
    prepared = []
    for text, spans in examples:
        region = read_region(text)
        gold = np.zeros((len(region.first), len(KINDS)))
        place = {b: k for k, b in enumerate(region.bounds)}
        index = {(i, j): k for k, (i, j) in enumerate(zip(region.first.tolist(), region.last.tolist()))}
        known = [(index.get((place.get(a, -1), place.get(b, -1) - 1)), KINDS.index(kind))
                 for a, b, kind in spans]
        if len(region.first) and all(k is not None for k, _ in known):
            for k, kind in known:
                gold[k, kind] = 1
            prepared.append((region, gold))
    if not any(gold.any() for _, gold in prepared):
        return None
    weights, seen = np.zeros((FEATURES, len(KINDS))), np.full((FEATURES, len(KINDS)), 1e-6)
    for _ in range(PASSES):
        for region, gold in prepared:
            slope = region.features.T @ (gold - marginals(region, weights)) - 1e-4 * weights
            seen += slope ** 2
            weights += STEP * slope / np.sqrt(seen)
    return weights


class _Covered:
    """Spans by start, asked whether any of them holds or touches a stretch."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted(spans, key=lambda s: s.start)
        self.starts = [s.start for s in self.spans]
        self.furthest = list(accumulate((s.end for s in self.spans), max))

    def holds(self, start: int, end: int) -> bool:
        k = bisect_right(self.starts, start)
        return k > 0 and self.furthest[k - 1] >= end

    def touches(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.furthest[k - 1] > start

    def inside(self, start: int, end: int) -> list[Span]:
        return [s for s in self.spans[bisect_left(self.starts, start):bisect_left(self.starts, end)]
                if s.end <= end]


def all_spans(text: str | None, weights: np.ndarray | None) -> tuple[list[Span], list[Span]]:
    """Base and added spans by kind, then start; and the base spans alone."""
    if not text:
        return [], []
    base = base_spans(text)
    added = []
    if weights is not None:
        covered = _Covered(base)
        for a, b in regions(text):
            if covered.holds(a, b):
                continue  # nothing of the region is free
            region = read_region(text[a:b])
            for i, j, kind in viterbi(region, weights):
                own = Span(KINDS[kind], a + region.bounds[i], a + region.bounds[j + 1])
                if not covered.touches(own.start, own.end):
                    added.append(own)
    if not added:
        return base, base
    return sorted(base + added, key=lambda s: (KINDS.index(s.kind), s.start)), base


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[str, str, str]] = []
        for text in batch.column("text").to_pylist():
            if not text:
                continue
            covered = _Covered(base_spans(text))
            for a, b in regions(text):
                if b - a <= EXAMPLE_CHARS:
                    inside = covered.inside(a, b)
                    group = ",".join(sorted({s.kind for s in inside})) or "none"
                    out.append((group, text[a:b], ";".join(
                        f"{s.start - a},{s.end - a},{s.kind}" for s in inside)))
        yield pa.RecordBatch.from_pydict({name: pa.array([x[k] for x in out], pa.string())
                                          for k, name in enumerate(("content", "region", "spans"))})


def learn_field(docs: DataFrame, examples: int = EXAMPLES) -> np.ndarray | None:
    """Weights from at most `examples` different regions (of `EXAMPLE_CHARS` at most) for each
    combination of kinds in them, chosen by hash."""
    texts = clean_table(docs, text="text").filter("text is not null")
    found = map_batches(texts, _examples, "content string, region string, spans string").distinct()
    rank = F.row_number().over(Window.partitionBy("content").orderBy(F.xxhash64("region"), "region"))
    rows = written_table(found.withColumn("rank", rank).filter(F.col("rank") <= examples),
                         "regions").orderBy("content", "rank").collect()
    return fit([(r.region, [(int(a), int(b), kind) for a, b, kind in
                            (x.split(",") for x in r.spans.split(";") if x)]) for r in rows])


SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_personal_data(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """(doc_id, spans, base) of each row (doc_id, text): all spans, and the patterns' alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(x, weights) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "spans": pa.array([[s._asdict() for s in spans] for spans, _ in found], _SPANS),
                "base": pa.array([[s._asdict() for s in base] for _, base in found], _SPANS)})

    return map_batches(clean_table(docs, doc_id="doc_id", text="text"), work,
                       f"doc_id long, spans {SPANS}, base {SPANS}")
