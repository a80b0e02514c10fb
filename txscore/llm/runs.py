"""Periodic runs of words, found by block convolution.

A run is a stretch of consecutive words with smallest period q, at least `LEAST` words and
`TIMES` periods long, that no neighbouring word extends. Its words after the first q are what a
text without the repetition would not have.

Each period belongs to one dyadic scale: with blocks of B words, B the largest power of two up to
(3q + 1) / 2, a run of four periods holds a whole aligned block and the block's repetition q words
on. So at each scale every block is sought in the window of words that starts with the scale's
shortest period. The sum of squared differences of block and window, at every distance at once,
is a convolution; a number-theoretic transform gives it as an exact integer, as word numbers are
folded so that no sum reaches the modulus. Where it is zero the distance seeds an extension, on
the words themselves, to both sides as far as words q apart are equal.

Two things keep the work in proportion. A block can only occur in its window if each of its words
occurs again within the scale's longest period, so blocks with another word are not transformed.
And what lies in a run found already, of period q, has only multiples of q as distances, so such
blocks and distances are left out. Texts of about a megabyte together are worked on side by side;
one text is one unit of work, whatever its length.

Defined results: null, empty and blank texts have no words and no runs; a null id is no number,
so its text is taken as it is; rows that repeat give equal rows; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txscore.llm.tasks import clean_table, map_batches, slices

#: A run has at least this many words, and this many times its period.
LEAST, TIMES = 6, 4
#: A prime with roots of unity of all orders up to 2^27, and one that generates its group.
PRIME, GENERATOR = 15 * (1 << 27) + 1, 31
#: Numbers in a batch of transforms.
BATCH = 1 << 19

U64 = np.uint64
_P = U64(PRIME)

SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>, "
          "collapsed string")


class Run(NamedTuple):
    """A run by the place of its first word, its number of words, and its smallest period."""

    start: int
    length: int
    period: int


@functools.cache
def _roots(order: int, inverse: bool) -> list[np.ndarray]:
    """For each level of a transform, the powers of its root of unity."""
    levels = []
    size = order
    while size > 1:
        root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
        root = pow(root, -1, PRIME) if inverse else root
        steps = np.ones(size // 2, U64)
        done = 1
        while done < len(steps):  # twice as many powers each time
            factor = U64(pow(root, done, PRIME))
            steps[done:2 * done] = steps[:done][:len(steps) - done] * factor % _P
            done *= 2
        levels.append(steps)
        size //= 2
    return levels


def transform(rows: np.ndarray) -> np.ndarray:
    """The transform of each row, modulo the prime, in bit-reversed order."""
    count, order = rows.shape
    size = order
    for steps in _roots(order, False):
        parts = rows.reshape(count, order // size, 2, size // 2)
        low, high = parts[:, :, 0], parts[:, :, 1]
        out = np.empty_like(parts)
        out[:, :, 0] = (low + high) % _P
        out[:, :, 1] = (low + (_P - high)) % _P * steps % _P
        rows, size = out.reshape(count, order), size // 2
    return rows


def back(rows: np.ndarray) -> np.ndarray:
    """The rows whose transforms these are, from bit-reversed order."""
    count, order = rows.shape
    size = 2
    for steps in reversed(_roots(order, True)):
        parts = rows.reshape(count, order // size, 2, size // 2)
        low, high = parts[:, :, 0], parts[:, :, 1] * steps % _P
        out = np.empty_like(parts)
        out[:, :, 0] = (low + high) % _P
        out[:, :, 1] = (low + (_P - high)) % _P
        rows, size = out.reshape(count, order), size * 2
    return rows * U64(pow(order, -1, PRIME)) % _P


def squared_differences(blocks: np.ndarray, windows: np.ndarray, distances: int) -> np.ndarray:
    """For each row, the sums of squared differences of a block and its window at each distance.

    A block has a power of two of numbers, a window twice as many; the sums must stay below the
    prime."""
    count, size = blocks.shape
    padded = np.zeros((count, 2 * size), U64)
    padded[:, :size] = blocks[:, ::-1]
    product = back(transform(padded) * transform(windows) % _P)[:, size - 1:size - 1 + distances]
    own = (blocks * blocks).sum(axis=1, dtype=U64)
    sums = np.zeros((count, 2 * size + 1), U64)
    np.cumsum(windows * windows, axis=1, out=sums[:, 1:])
    other = sums[:, size:size + distances] - sums[:, :distances]
    total = own[:, None] + other
    return (total % _P + U64(2) * (_P - product)) % _P


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(block, shortest, longest period) of each scale up to this period."""
    block, low = 2, 1
    while low <= longest:
        high = -(-(4 * block - 1) // 3) - 1
        if block == 2:  # 2 is a multiple of 1, so it comes after it
            yield 2, 1, 1
            low = 2
        yield block, low, high
        block, low = 2 * block, high + 1


class _Found:
    """Runs by where they start in all the words, asked for what covers a stretch."""

    def __init__(self):
        self.runs: list[Run] = []
        self._arrays = None

    def add(self, run: Run) -> None:
        self.runs.append(run)
        self._arrays = None

    def covering(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The period of a run that covers each stretch, or 0."""
        if not self.runs:
            return np.zeros(len(begin), np.int64)
        if self._arrays is None:
            runs = sorted(self.runs)
            starts, lengths, periods = np.array(runs, np.int64).T
            ends = starts + lengths
            furthest = np.maximum.accumulate(ends)
            leader = np.maximum.accumulate(np.where(ends == furthest, np.arange(len(runs)), 0))
            self._arrays = starts, furthest, periods[leader]
        starts, furthest, periods = self._arrays
        at = np.searchsorted(starts, begin, side="right") - 1
        return np.where((at >= 0) & (furthest[at] >= end), periods[at], 0)


def _same_from(x: np.ndarray, i: int, j: int, most: int) -> int:
    """How many words from i on equal those from j on, up to `most`."""
    done, step = 0, 64
    while done < most:
        step = min(step, most - done)
        differ = x[i + done:i + done + step] != x[j + done:j + done + step]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + step, step * 2
    return most


def _same_before(x: np.ndarray, i: int, j: int, most: int) -> int:
    """How many words before i equal those before j, up to `most`."""
    done, step = 0, 64
    while done < most:
        step = min(step, most - done)
        differ = x[i - done - step:i - done] != x[j - done - step:j - done]
        if differ.any():
            return done + int(differ[::-1].argmax())
        done, step = done + step, step * 2
    return most


def _prime_factors(n: int) -> Iterator[int]:
    f = 2
    while f * f <= n:
        if n % f == 0:
            yield f
            while n % f == 0:
                n //= f
        f += 1
    if n > 1:
        yield n


def _is_smallest(x: np.ndarray, begin: int, end: int, period: int) -> bool:
    """Whether a stretch of several periods has no shorter one; that would divide it."""
    return all(_same_from(x, begin, begin + period // f, end - begin - period // f)
               < end - begin - period // f for f in _prime_factors(period))


def _next_gaps(x: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How far on each word occurs again in its text; where it does not, a very large number."""
    gaps = np.full(len(x), np.iinfo(np.int64).max // 2)
    order = np.argsort(x, kind="stable")
    here, there = order[:-1], order[1:]
    again = (x[here] == x[there]) & (text[here] == text[there])
    gaps[here[again]] = (there - here)[again]
    return gaps


def find_runs(x: np.ndarray, ends: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """All runs in texts laid end to end, given by word numbers and the texts' ends.

    Runs come with places in the whole array, sorted; none reaches over the end of a text.
    `times` is 4 or more, which the scales rely on."""
    if not len(x) or times < 4:
        if times < 4:
            raise ValueError("runs have four periods at least")
        return []
    ends = np.asarray(ends, np.int64)
    sizes = np.diff(ends, prepend=0)
    text = np.repeat(np.arange(len(ends)), sizes)
    stop = np.repeat(ends, sizes)
    gaps = _next_gaps(x, text)
    found = _Found()
    widest, width = gaps, 1  # the largest gap in each aligned block of `width` words
    for block, low, high in scales(int(sizes.max()) // times):
        while width < block:
            widest = np.maximum(widest[:len(widest) // 2 * 2:2], widest[1::2])
            width *= 2
        starts = np.flatnonzero(widest <= high) * block
        starts = starts[(starts + low + block <= stop[starts])]
        known = found.covering(starts, np.minimum(starts + high + block, stop[starts]))
        starts = starts[(known == 0) | (known > block)]
        if len(starts):
            _seed(x, ends, text, starts, block, low, high, found, least, times)
    return sorted(found.runs)


def _seed(x: np.ndarray, ends: np.ndarray, text: np.ndarray, starts: np.ndarray, block: int,
          low: int, high: int, found: _Found, least: int, times: int) -> None:
    """Find the blocks' occurrences at the scale's distances, and extend them to runs."""
    fold = U64(int(((PRIME - 1) // block) ** 0.5))
    # Beyond the last word stands what no block holds once its text is asked for.
    values = np.concatenate([x.astype(U64) % fold, np.zeros(low + 2 * block, U64)])
    at_once = max(1, BATCH // (2 * block))
    reached: dict[int, int] = {}
    for k in range(0, len(starts), at_once):
        begin = starts[k:k + at_once]
        own = begin[:, None] + np.arange(2 * block)
        sums = squared_differences(values[own[:, :block]], values[own + low], high - low + 1)
        row, step = np.nonzero(sums == 0)
        s, distance = begin[row], low + step
        stop = s + distance + block
        inside = stop <= ends[text[s]]
        s, distance, stop = s[inside], distance[inside], stop[inside]
        known = found.covering(s, stop)
        common = np.gcd(known, distance)
        fresh = (known == 0) | ((common != known) & (block < known - common))
        for i, q in zip(s[fresh].tolist(), distance[fresh].tolist()):
            if reached.get(q, -1) > i:
                continue  # in a stretch of this distance that has been extended
            first = int(ends[text[i] - 1]) if text[i] else 0
            last = int(ends[text[i]])
            after = i + _same_from(x, i, i + q, last - i - q)
            if after - i < block:
                continue  # folded numbers were equal, the words are not
            before = i - _same_before(x, i, i + q, i - first)
            reached[q] = after
            length = after + q - before
            if length >= max(least, times * q) and _is_smallest(x, before, before + length, q):
                found.add(Run(before, length, q))


def planted_order(doc_id: int, n: int) -> np.ndarray:
    """Which of its n words stands at each place of a document, by the rule that makes one
    document in ten repeat a part of itself."""
    h = zlib.crc32(str(doc_id).encode())
    order = np.arange(n)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        order[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return order


def strongest(runs: list[Run]) -> Run | None:
    """The run with the most periods; among equals the first, then the one of shortest period."""
    return min(runs, key=lambda r: (-Fraction(r.length, r.period), r.start, r.period), default=None)


def dropped(runs: list[Run], n: int) -> np.ndarray:
    """Which of n words stand in a run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for r in runs:
        edge[r.start + r.period] += 1
        edge[r.start + r.length] -= 1
    return np.cumsum(edge[:-1]) > 0


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _row(doc_id: int | None, words: list[bytes], runs: list[Run]) -> dict:
    if runs:
        gone = dropped(runs, len(words))
        words = [w for w, out in zip(words, gone.tolist()) if not out]
    kept = b" ".join(words)
    best = strongest(runs)
    return {
        "doc_id": doc_id, "n_runs": len(runs),
        "start": best and best.start, "length": best and best.length, "period": best and best.period,
        "exponent_milli": best and 1000 * best.length // best.period,
        "runs_sha256": _digest("".join(f"{r.start},{r.length},{r.period}\n" for r in runs).encode()),
        "collapsed_sha256": _digest(kept), "runs": [r._asdict() for r in runs],
        "collapsed": kept.decode()}


_ARROW = pa.schema([
    *((name, pa.int64()) for name in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")),
    ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
    ("runs", pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))),
    ("collapsed", pa.string())])


def _scanning(planted: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch):
                raw, ids = data.tobytes(), rows.column("doc_id").to_pylist()
                numbers: dict[bytes, int] = {}
                texts, parts = [], []
                for doc_id, a, b in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist()):
                    words = raw[a:b].split()  # at blanks and at the bytes 9 to 13
                    own = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
                    if planted and doc_id is not None:
                        order = planted_order(doc_id, len(words))
                        if len(order) and order[-1] != len(order) - 1:
                            own, words = own[order], [words[k] for k in order.tolist()]
                    texts.append(words)
                    parts.append(own)
                ends = np.cumsum([len(own) for own in parts])
                of: list[list[Run]] = [[] for _ in texts]
                for run in find_runs(np.concatenate(parts), ends):
                    k = int(np.searchsorted(ends, run.start, side="right"))
                    of[k].append(run._replace(start=run.start - int(ends[k]) + len(texts[k])))
                yield pa.RecordBatch.from_pylist(
                    [_row(*row) for row in zip(ids, texts, of)], schema=_ARROW)

    return work


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """Runs of each document (doc_id, text), the strongest one, and the text without repetitions.

    With `planted`, words are first put in the order of `planted_order`."""
    return map_batches(clean_table(docs, doc_id="doc_id", text="text"), _scanning(planted), SCHEMA)
