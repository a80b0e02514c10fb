"""Secret scans: fixed patterns, and formats learned from what they find.

The patterns give the base spans. The strings they find, labelled by pattern, teach one
probabilistic automaton per label (see `automata`), and strings that no pattern found teach one of
ordinary text. Candidates are all runs of the characters that labelled strings are made of,
letters, digits and `+/_.=-`, of `SHORTEST` or more, as the patterns label, and what base spans
leave of such runs. Each is scored by how likely its format is; it is added if it is at least
as likely as all but the least likely hundredth of a label's examples, and likelier than as
ordinary text. Base spans always stay.

Scores depend on the classes of a string's characters only, so a task remembers them by these;
runs and base spans are walked once, side by side, so a text takes time in proportion to its length.

Defined results: null and empty texts have no spans; texts are scanned whole, of any length; a
label without examples has no automaton, and without any nothing is added; equal scores go to the
label listed first; repeated rows and null ids are scanned like others; an empty table gives no
rows, and teaches nothing. Other columns are not read by `find_secrets`, and passed through by
`mask_secrets`.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txscore.llm.automata import Automaton, classes
from txscore.llm.tasks import clean_table, map_batches, prepare, written_table

KINDS = ("assign", "access", "hex")
#: Examples that each automaton is learned from, and characters of each that are used; an example
#: that is longer teaches no end.
EXAMPLES, EXAMPLE_CHARS = 2000, 128
#: Formats whose scores a task remembers, and characters up to which they are.
REMEMBERED, SHORT = 100_000, 64
#: Share of a label's examples that may be less likely than a candidate that is added.
LEAST_LIKELY = 0.01

# The contract's patterns: fixed values.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "api")

#: Runs that hold what the other two patterns find.
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: The least length of a string that a pattern labels, and so of a candidate.
SHORTEST = 6


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by start, then by kind as listed."""
    found = []
    low = text.lower()
    if any(word in low for word in _KEYWORDS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                found.append((m.start(), 0, m.end()))
    for run in _RUN.finditer(text):  # the other two kinds lie within such runs
        inside = run.group()
        at = run.start()
        if "AKIA" in inside:
            found.extend((at + m.start(), 1, at + m.end()) for m in _ACCESS.finditer(inside)
                         if m.end() - m.start() >= 20)
        if len(inside) >= 24:
            found.extend((at + m.start(), 2, at + m.end()) for m in _HEX.finditer(inside))
    return [Span(KINDS[k], start, end, 0.0) for start, k, end in sorted(found)]


def candidates(text: str, base: list[Span], least: int = SHORTEST) -> Iterator[tuple[int, int, str]]:
    """Runs of at least `least` characters outside of base spans, which are sorted by start; and
    the classes of their characters."""
    shape = classes(text)
    k, n, covered = 0, len(base), 0
    for m in re.finditer(r"[dhlHL+/_.=-]{%d,}" % least, shape):
        at, end = m.span()
        at = max(at, covered)
        while k < n and base[k].start < end:
            if base[k].start - at >= least:
                yield at, base[k].start, shape[at:base[k].start]
            covered = max(covered, base[k].end)
            at = max(at, covered)
            k += 1
        if end - at >= least:
            yield at, end, shape[at:end]


class Formats(NamedTuple):
    """An automaton and a threshold for each label, and the automaton of ordinary text."""

    labels: tuple[tuple[str, Automaton, float], ...]
    ordinary: Automaton | None

    def judge(self, shape: str) -> tuple[str, float] | None:
        """The label, if any, and the score of a string given by the classes of its characters."""
        usual = self.ordinary.score_classes(shape) if self.ordinary else None
        best = None
        for kind, automaton, least in self.labels:
            score = automaton.score_classes(shape)
            if score >= least and (usual is None or score > usual) and (not best or score > best[1]):
                best = kind, score
        return best


class _Judge(dict):
    """Judgements by shape, remembered for short ones."""

    def __init__(self, formats: Formats):
        super().__init__()
        self.formats = formats

    def __missing__(self, shape: str):
        found = self.formats.judge(shape)
        if len(shape) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[shape] = found
        return found


def all_spans(text: str | None, formats: Formats, judge: dict | None = None) -> tuple[list[Span], int]:
    """Base spans and learned ones by start, base first; and how many are base."""
    if not text:
        return [], 0
    judge = _Judge(formats) if judge is None else judge
    base = base_spans(text)
    spans = [(s.start, KINDS.index(s.kind), s) for s in base]
    for start, end, shape in candidates(text, base) if formats.labels else ():
        judged = judge[shape]
        if judged:
            spans.append((start, len(KINDS) + KINDS.index(judged[0]),
                          Span(f"like_{judged[0]}", start, end, judged[1])))
    return [s for _, _, s in sorted(spans, key=lambda x: x[:2])], len(base)


def _examples(most: int):
    """The `most` different examples of each kind in a task that come first by hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[str, list[tuple[int, str]]] = {}
        known: dict[str, set[str]] = {}

        def offer(kind: str, value: str) -> None:
            heap, own = heaps.setdefault(kind, []), known.setdefault(kind, set())
            order = zlib.crc32(value.encode())
            if value in own or len(heap) >= most and order > -heap[0][0]:
                return
            heapq.heappush(heap, (-order, value))
            own.add(value)
            if len(heap) > most:
                own.discard(heapq.heappop(heap)[1])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                if not text:
                    continue
                base = base_spans(text)
                for s in base:
                    value = text[s.start:s.end]
                    offer(s.kind, _ASSIGN.match(value).group(2) if s.kind == "assign" else value)
                for start, end, _ in candidates(text, base):
                    offer("ordinary", text[start:end])
        rows = [(kind, value, -order) for kind, heap in heaps.items() for order, value in heap]
        yield pa.RecordBatch.from_pydict({
            name: pa.array([row[k] for row in rows], kind) for k, (name, kind) in enumerate((
                ("kind", pa.string()), ("value", pa.string()), ("place", pa.int64())))})

    return work


def learn_formats(docs: DataFrame, examples: int = EXAMPLES) -> Formats:
    """Automata from at most `examples` different strings per label, chosen by hash."""
    texts = clean_table(docs, text="text").filter("text is not null")
    found = map_batches(texts, _examples(examples), "kind string, value string, place long").distinct()
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("place", "value"))
    chosen = written_table(found.withColumn("rank", rank).filter(F.col("rank") <= examples)
                           .select("kind", "value"), "examples").collect()
    by_kind: dict[str, list[str]] = {}
    for row in chosen:
        by_kind.setdefault(row.kind, []).append(row.value)
    labels = []
    for kind in KINDS:
        if own := sorted(by_kind.get(kind, [])):
            automaton = Automaton.learn(own, most=EXAMPLE_CHARS)
            scores = sorted(automaton.score(x) for x in own)
            labels.append((kind, automaton, scores[int(len(scores) * LEAST_LIKELY)]))
    ordinary = sorted(by_kind.get("ordinary", []))
    return Formats(tuple(labels), Automaton.learn(ordinary, most=EXAMPLE_CHARS) if ordinary else None)


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                             ("score", pa.float64())]))


def find_secrets(docs: DataFrame, formats: Formats) -> DataFrame:
    """(doc_id, spans, n_base) of each row; the base spans have score 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(formats)
        for batch in batches:
            found = [all_spans(text, formats, judge) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "spans": pa.array([[s._asdict() for s in spans] for spans, _ in found], _SPANS),
                "n_base": pa.array([n for _, n in found], pa.int64())})

    return map_batches(clean_table(docs, doc_id="doc_id", text="text"), work,
                       f"doc_id long, spans {SPANS}, n_base long")


def masked(text: str | None, formats: Formats, mark: str, judge: dict | None = None) -> str | None:
    """The text with every stretch of spans replaced by the mark."""
    spans, _ = all_spans(text, formats, judge)
    parts, at = [], 0
    for s in spans:
        if s.start >= at:
            parts += [text[at:s.start], mark]
        at = max(at, s.end)
    return "".join(parts) + text[at:] if spans else text


def mask_secrets(docs: DataFrame, formats: Formats, mark: str = "[SECRET]") -> DataFrame:
    """The rows with all their columns, their secrets replaced; only texts go to Python."""
    prepare(docs.sparkSession)

    @F.arrow_udf("string")
    def masking(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = _Judge(formats)
        for batch in texts:
            yield pa.array([masked(x, formats, mark, judge) for x in batch.to_pylist()], pa.string())

    return docs.withColumn("text", masking(F.col("text")))
