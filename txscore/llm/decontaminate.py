"""Benchmark decontamination by winnowing.

Both sides keep the smallest hash of each `SPAN` consecutive k-grams of words, so any shared
run of `window` words holds a k-gram that both sides kept. Fingerprints are joined, and each
hit is extended left and right word by word; a run of `window` words or more marks the
document's words in it. An item shorter than a window is one window, found by its own gram.

Defined results: a null, empty or wordless text has no words, no hits, and is not contaminated;
an item without words is found nowhere; an item id that repeats counts once per document, as do
equal passages; repeated documents are judged one by one; null item ids are not listed;
an empty table of documents gives no rows, an empty benchmark no hits. Other columns are not read, so their names do not matter. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.llm.tasks import clean_table, keep_texts, map_batches, slices, written_table
from txscore.llm.words import ALNUM, U64, grams, split_words

#: Words in a window, and words in a fingerprinted gram.
WINDOW, GRAM = 13, 5
#: Above this many bytes the benchmark's fingerprints are not held by every task.
INDEX_BYTES = 64 << 20

RESULT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
          "contaminated boolean")


def winnow(words: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Positions of the grams kept: the smallest hash of each window, the rightmost of ties."""
    hashes = grams(words, gram)
    span = window - gram + 1
    if len(hashes) < span:
        return np.zeros(0, np.int64)
    best, at = hashes[:len(hashes) - span + 1].copy(), np.zeros(len(hashes) - span + 1, np.int64)
    for k in range(1, span):
        other = hashes[k:k + len(best)]
        smaller = other <= best
        np.copyto(best, other, where=smaller)
        at[smaller] = k
    at += np.arange(len(best))
    return at[np.r_[True, at[1:] != at[:-1]]]


class ItemIndex:
    """Items as word hashes, with their fingerprints sorted for lookup."""

    def __init__(self, ids: list, words: list[np.ndarray], window: int, gram: int):
        self.window, self.gram = window, gram
        self.ids, self.words = ids, words
        keys, item, place, length = [], [], [], []
        for number, hashes in enumerate(words):
            if len(hashes) >= window:
                at, size = winnow(hashes, window, gram), gram
                found = grams(hashes, gram)[at]
            elif len(hashes):
                at, size = np.zeros(1, np.int64), len(hashes)
                found = grams(hashes, size)
            else:
                continue
            keys.append(found)
            item.append(np.full(len(at), number))
            place.append(at)
            length.append(np.full(len(at), size if len(hashes) < window else 0))
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        keys, item = join(keys, U64), join(item, np.int64)
        place, length = join(place, np.int64), join(length, np.int64)
        self.tables = {}
        for size in np.unique(length).tolist():
            chosen = np.flatnonzero(length == size)
            chosen = chosen[np.argsort(keys[chosen], kind="stable")]
            self.tables[size] = (keys[chosen], item[chosen], place[chosen])

    def hits(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Runs (first word, end, item) of a document that hold a whole window of an item."""
        n = len(words)
        for size, (keys, item, place) in self.tables.items():
            if size:
                at, hashes = np.arange(max(0, n - size + 1)), grams(words, size)
            else:
                at = winnow(words, self.window, self.gram)
                hashes = grams(words, self.gram)[at] if len(at) else np.zeros(0, U64)
            if not len(at):
                continue
            low = np.searchsorted(keys, hashes, side="left")
            found = np.flatnonzero(low < len(keys))
            found = found[keys[low[found]] == hashes[found]]
            done: dict[tuple[int, int], int] = {}
            for k in found.tolist():
                p = int(at[k])
                row = int(low[k])
                while row < len(keys) and keys[row] == hashes[k]:
                    number, q = int(item[row]), int(place[row])
                    row += 1
                    if size:
                        if np.array_equal(words[p:p + size], self.words[number]):
                            yield p, p + size, number
                        continue
                    # Hits on one diagonal belong to the same run as long as they lie inside it.
                    if done.get((number, p - q), -1) >= p + self.gram:
                        continue
                    left, right = extend(words, p, self.words[number], q)
                    done[number, p - q] = right
                    if right - left >= self.window:
                        yield left, right, number


def extend(a: np.ndarray, p: int, b: np.ndarray, q: int) -> tuple[int, int]:
    """The longest run of equal words around a[p] and b[q], as positions in a."""
    ahead = min(len(a) - p, len(b) - q)
    differ = np.flatnonzero(a[p:p + ahead] != b[q:q + ahead])
    right = p + (int(differ[0]) if len(differ) else ahead)
    back = min(p, q)
    differ = np.flatnonzero(a[p - back:p] != b[q - back:q])
    left = p - (back - 1 - int(differ[-1]) if len(differ) else back)
    return left, right


def judge(words: np.ndarray, index: ItemIndex) -> tuple[int, list[int]]:
    """How many words are hit, and the items with occurring windows."""
    hit, items = None, set()
    for left, right, number in index.hits(words):
        if hit is None:
            hit = np.zeros(len(words), bool)
        hit[left:right] = True
        items.add(number)
    return (int(hit.sum()) if hit is not None else 0), sorted(items)


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in slices(batch):
            words = split_words(data, offsets, ALNUM)
            yield pa.RecordBatch.from_pydict({
                "item_id": rows.column("item_id"),
                "words": pa.ListArray.from_arrays(words.first.astype(np.int32),
                                                  words.hash.view(np.int64))})


def _digest(ids) -> str:
    named = sorted({str(x) for x in ids if x is not None})
    return hashlib.sha256(",".join(named).encode()).hexdigest()


def _rows(ids: pa.Array, counts: list[tuple[int, int, list]], key: str = "doc_id") -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        key: ids,
        "n_words": pa.array([n for n, _, _ in counts], pa.int64()),
        "n_hit": pa.array([h for _, h, _ in counts], pa.int64()),
        "n_items": pa.array([len({x for x in i if x is not None}) for _, _, i in counts], pa.int64()),
        "items_sha256": pa.array([_digest(i) for _, _, i in counts], pa.string()),
        "contaminated": pa.array([_contaminated(h, n) for n, h, _ in counts], pa.bool_())})


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM,
                  index_bytes: int = INDEX_BYTES) -> DataFrame:
    """One row per document: words, words hit, items that occur, and the verdict.

    `docs` has doc_id and text, `items` has item_id and text. A benchmark up to `index_bytes`
    of words and fingerprints goes to every task, and documents are not shuffled; a larger one
    is cut into parts of that size, each of which judges all documents in its own pass, and
    the hits are united per document.
    """
    docs = clean_table(docs, doc_id="doc_id", text="text")
    hashed, parts = _indexed(items, index_bytes)
    if parts == 1:
        return map_batches(docs, _judging(_load(hashed, window, gram)), RESULT)
    return _by_parts(docs, hashed, parts, window, gram).select(*_columns(RESULT))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM,
                      index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows, with all their columns, that are not contaminated."""
    hashed, parts = _indexed(items, index_bytes)
    if parts == 1:
        return keep_texts(docs, _keeping(_load(hashed, window, gram)))
    rows = written_table(docs.select(F.struct(*docs.columns).alias("whole"), F.col("text")), "rows")
    judged = _by_parts(rows, hashed, parts, window, gram).filter("not contaminated")
    return judged.select("whole.*")


def _columns(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _indexed(items: DataFrame, index_bytes: int) -> tuple[DataFrame, int]:
    """The items' words, written, and in how many parts tasks can hold them."""
    items = clean_table(items, item_id="item_id", text="text").select(
        F.col("item_id").cast("string"), "text")
    hashed = written_table(map_batches(items, _item_words, "item_id string, words array<long>"),
                           "benchmark_words")
    total = hashed.agg(F.sum(24 * F.size("words") + 64)).first()[0] or 0
    return hashed, -(-int(total) // index_bytes) or 1


def _load(hashed: DataFrame, window: int, gram: int) -> ItemIndex:
    table = hashed.toArrow()
    words = [np.asarray(x, np.int64).view(U64) for x in table.column("words").to_pylist()]
    return ItemIndex(table.column("item_id").to_pylist(), words, window, gram)


def _judging(index: ItemIndex):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch):
                words = split_words(data, offsets, ALNUM)
                counts = []
                for i in range(rows.num_rows):
                    own = words.hash[words.first[i]:words.first[i + 1]]
                    hit, found = judge(own, index)
                    counts.append((len(own), hit, [index.ids[k] for k in found]))
                yield _rows(rows.column("doc_id"), counts)

    return work


def _keeping(index: ItemIndex):
    def judged(data: np.ndarray, offsets: np.ndarray) -> list[bool]:
        words = split_words(data, offsets, ALNUM)
        return [not _contaminated(judge(words.hash[a:b], index)[0], int(b - a))
                for a, b in zip(words.first[:-1], words.first[1:])]

    return judged


def _contaminated(hit: int, words: int) -> bool:
    return hit > 0 and 20 * hit >= words


def _by_parts(docs: DataFrame, hashed: DataFrame, parts: int, window: int, gram: int) -> DataFrame:
    """Documents are numbered once; each part of the benchmark gives runs of hit words; the
    runs of a document meet in one row, whose size the document bounds."""
    numbered = written_table(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    runs = None
    for part in range(parts):
        index = _load(hashed.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(parts)) == part),
                      window, gram)
        found = map_batches(numbered.select("row", "text"), _finding(index),
                            "row long, first int, last int, item string")
        runs = found if runs is None else runs.unionByName(found)
    runs = runs.groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("runs"),
                                   F.collect_set("item").alias("items"))
    united = map_batches(numbered.join(runs, "row", "left").select("row", "text", "runs", "items"),
                         _uniting, RESULT.replace("doc_id", "row"))
    return numbered.drop("text").join(united, "row")


def _finding(index: ItemIndex):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch):
                words = split_words(data, offsets, ALNUM)
                ids = rows.column("row").to_pylist()
                found = [(ids[i], left, right, index.ids[k]) for i in range(rows.num_rows)
                         for left, right, k in index.hits(words.hash[words.first[i]:words.first[i + 1]])]
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array([x[0] for x in found], pa.int64()),
                    "first": pa.array([x[1] for x in found], pa.int32()),
                    "last": pa.array([x[2] for x in found], pa.int32()),
                    "item": pa.array([x[3] for x in found], pa.string())})

    return work


def _uniting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in slices(batch):
            words = split_words(data, offsets, ALNUM)
            counts = []
            for i, (runs, items) in enumerate(zip(rows.column("runs").to_pylist(),
                                                  rows.column("items").to_pylist())):
                hit = np.zeros(words.first[i + 1] - words.first[i], bool)
                for run in runs or ():
                    hit[run["first"]:run["last"]] = True
                counts.append((len(hit), int(hit.sum()), items or []))
            yield _rows(rows.column("row"), counts, "row")
