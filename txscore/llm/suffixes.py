"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

Every byte covered by a string of `LENGTH` bytes that also starts elsewhere goes. Each window of
`LENGTH` bytes has an anchor, the smallest hash among its short grams; equal windows have equal
anchors at equal places, so windows are only compared within a bucket of one anchor hash, and
windows whose anchor occurs once are unique. Where an anchor's context, the bytes that its
windows reach, occurs twice, all its windows repeat.

Buckets with several different contexts are sorted a block at a time, one copy of each context. A block's text is its contexts, laid so that
anchors stand at multiples of the cover's period. First the suffixes at cover-sample positions
are ranked; then each bucket's window suffixes are sorted by their first `PERIOD` bytes, and
longer ties by the rank of the next sample position, so no sort looks further than a period.
Windows that repeat stand next to each other, and are confirmed byte by byte.

A task holds one block. A bucket with more than `MOST_CONTEXTS` contexts, however many, is not
sorted in one task: its windows are counted by a 128-bit hash of their bytes, which any number
of tasks share.

Equal texts are one text that occurs several times. Defined results: null and empty texts have
no bytes; texts shorter than `LENGTH` lose nothing; repeated rows are copies of one another, so
they lose all bytes if they have `LENGTH` or more; null ids are like others; an
empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.llm.tasks import clean_table, map_batches, slices, written_table
from txscore.llm.words import U64, mix, prefix_hash

LENGTH, GRAM = 200, 32
PERIOD = 32
MOST_CONTEXTS = 16_384
#: Blocks are this many bytes of contexts on average.
BLOCK_BYTES = 1 << 20
#: Texts are read in pieces of at most this many window starts; places in one fit 24 bits.
PIECE = 1 << 23


def difference_cover(period: int) -> list[int]:
    """Residues such that every difference modulo the period is one of two of them (greedy)."""
    cover, missing = [0, 1], set(range(period)) - {0, 1, period - 1}
    while missing:
        best = max(range(period), key=lambda x: len(missing & {d % period for c in cover
                                                              for d in (x - c, c - x)}))
        cover.append(best)
        missing -= {d % period for c in cover for d in (best - c, c - best)}
    return sorted(cover)


COVER = difference_cover(PERIOD)


def anchors(sums: np.ndarray, down: np.ndarray, begin: int, end: int, length: int, gram: int):
    """Anchors of the text at bytes begin to end: hash, context hash, first and last window start
    (relative to begin) and the anchor's distance from the first window."""
    parts = []
    for piece in range(begin, max(begin, end - length + 1), PIECE):
        stop = min(end, piece + PIECE + length - 1)
        h = mix((sums[piece + gram:stop + 1] - sums[piece:stop + 1 - gram]) * down[piece:stop + 1 - gram])
        # The leftmost of the smallest: order by hash, then by place.
        best = (h & ~U64(0xFFFFFF)) | np.arange(len(h), dtype=U64)
        width, span = 1, length - gram + 1
        while 2 * width <= span:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        if width < span:
            best = np.minimum(best[:len(best) - (span - width)], best[span - width:])
        place = (best & U64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], len(place)] - 1
        own = h[place[first]]
        a, b = piece + first, piece + last + length
        context = mix((sums[b] - sums[a]) * down[a] + mix((b - a).astype(U64) << U64(20)
                                                         | (place[first] - first).astype(U64)))
        parts.append((own, context, first + piece - begin, last + piece - begin, place[first] - first))
    if not parts:
        none = np.zeros(0, np.int64)
        return none.astype(U64), none.astype(U64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*parts))


def packed(first: np.ndarray, last: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """First window start, windows after it and the anchor's distance in one number."""
    return (first << 16) | ((last - first) << 8) | offset


def _anchoring(length: int, gram: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch):
                sums, down = prefix_hash(data)
                found = [anchors(sums, down, a, b, length, gram)
                         for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                sizes = [len(x[0]) for x in found]
                own, context, first, last, offset = (np.concatenate(x) for x in zip(*found))
                each = pa.StructArray.from_arrays(
                    [pa.array(own.view(np.int64)), pa.array(context.view(np.int64)),
                     pa.array(packed(first, last, offset))], ["hash", "context", "place"])
                yield pa.RecordBatch.from_pydict({
                    "row": rows.column("row"), "text_key": rows.column("text_key"),
                    "anchors": pa.ListArray.from_arrays(np.r_[0, np.cumsum(sizes)].astype(np.int32), each)})

    return work


def _cutting(length: int):
    """Contexts of a text's anchors, as bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch):
                out: dict[str, list] = {"row": [], "hash": [], "place": [], "hot": [], "bytes": []}
                for wanted, begin in zip(rows.column("wanted").to_pylist(), offsets.tolist()):
                    for w in wanted:
                        first = begin + (w["place"] >> 16)
                        out["row"].append(w["row"])
                        out["hash"].append(w["hash"])
                        out["place"].append(w["place"])
                        out["hot"].append(w["hot"])
                        out["bytes"].append(data[first:first + (w["place"] >> 8 & 255) + length].tobytes())
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_pydict({k: pa.array(v, kind)
                                                  for (k, v), kind in zip(out.items(), kinds)})

    return work


def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as one big-endian number; zeros follow the text."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(U64)
    total = np.zeros(len(text), U64)
    for k in range(8):
        total = (total << U64(8)) | padded[k:k + len(text)]
    return total


def _ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Dense ranks by several keys, the first counting most."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def sample_ranks(words: np.ndarray, positions: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes at these positions, each up to its context's end, refined 8 bytes at
    a time for those that still tie."""
    rank = np.zeros(len(positions), np.int64)
    tied, step = np.arange(len(positions)), 0
    while len(tied):
        at = positions[tied] + step
        inside = at < ends[tied]
        key = np.where(inside, words[np.minimum(at, len(words) - 1)], U64(0))
        # Bytes beyond the context's end count as none, shorter suffixes first.
        rest = np.minimum(ends[tied] - at, 8)
        cut = (rest > 0) & (rest < 8)
        key[cut] &= ~((U64(1) << (U64(64) - U64(8) * rest[cut].astype(U64))) - U64(1))
        fresh = _ranks([rank[tied], key, np.maximum(rest, 0)])
        # Leave room: a refined rank stays below the next coarse one.
        order = np.argsort(fresh, kind="stable")
        base = rank[tied][order]
        first = np.flatnonzero(np.r_[True, base[1:] != base[:-1]])
        start = np.repeat(first, np.diff(np.r_[first, len(base)]))
        group = np.flatnonzero(np.r_[True, np.diff(fresh[order]) != 0])
        place = np.repeat(group, np.diff(np.r_[group, len(order)]))
        rank[tied[order]] = base + place - start
        size = np.repeat(np.diff(np.r_[group, len(order)]), np.diff(np.r_[group, len(order)]))
        open_ = np.zeros(len(order), bool)
        open_[order] = (size > 1)
        tied, step = tied[open_ & inside & (rest == 8)], step + 8
    return rank


def repeated_windows(contexts: list[bytes], buckets: np.ndarray, offsets: np.ndarray,
                     length: int) -> list[np.ndarray]:
    """For each context, which of its windows also stand in another context of its bucket."""
    # Lay the contexts so that anchors are at multiples of the period.
    sizes = np.array([len(c) for c in contexts])
    lead = (-offsets) % PERIOD
    room = -(-(lead + sizes) // PERIOD) * PERIOD
    start = np.cumsum(room) - room + lead
    text = np.zeros(int(room.sum()) + length + 8, np.uint8)
    for c, s in zip(contexts, start.tolist()):
        text[s:s + len(c)] = np.frombuffer(c, np.uint8)
    words = _words(text)
    counts = sizes - length + 1
    owner = np.repeat(np.arange(len(contexts)), counts)
    begin = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    window = start[owner] + begin
    apart = begin - offsets[owner]  # place of the window's start beside the anchor
    # Only windows at a place that several contexts of the bucket reach can be equal.
    group = buckets[owner] * 512 + apart + 256
    several = np.flatnonzero(np.bincount(group, minlength=1)[group] > 1)
    flags = np.zeros(len(window), bool)
    if not len(several):
        return np.split(flags, np.cumsum(counts)[:-1])
    group, window = group[several], window[several]
    # The cover sample of every context.
    ends = start + sizes
    position = np.arange(len(text))
    which = np.searchsorted(start, position, side="right") - 1
    inside = (which >= 0) & (position < ends[np.maximum(which, 0)])
    chosen = np.flatnonzero(inside & np.isin(position % PERIOD, COVER))
    rank = np.full(len(text) + PERIOD, -1, np.int64)
    rank[chosen] = sample_ranks(words, chosen, ends[which[chosen]])
    # From a residue to the next sample position; windows that may be equal have one residue.
    ahead = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])
    keys = [group] + [words[window + 8 * k] for k in range(PERIOD // 8)] \
        + [rank[window + ahead[window % PERIOD]]]
    order = np.lexsort(keys[::-1])
    near = group[order[1:]] == group[order[:-1]]
    for k in [8 * k for k in range(length // 8)] + [length - 8]:
        near[near] = words[window[order[1:][near]] + k] == words[window[order[:-1][near]] + k]
    flags[several[order[1:][near]]] = True
    flags[several[order[:-1][near]]] = True
    return np.split(flags, np.cumsum(counts)[:-1])


def runs_of(flags: np.ndarray, first: int) -> list[dict]:
    """Runs of flagged window starts."""
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return [{"a": first + a, "b": first + b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


def _sorting(length: int):
    def work(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates(["row", "place"])  # a text may be in several equal rows
        places = block["place"].to_numpy()
        flags = repeated_windows(list(block["bytes"]), pd.factorize(block["hash"])[0], places & 255, length)
        runs = [runs_of(f, first) for f, first in zip(flags, (places >> 16).tolist())]
        return pd.DataFrame({"row": block["row"], "runs": pd.Series(runs, block.index, object)})

    return work


def _windows(length: int):
    """Every window of a context by a 128-bit hash of its bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"row": [], "start": [], "window": []}
            for row, place, raw in zip(*(batch.column(x).to_pylist() for x in ("row", "place", "bytes"))):
                count = len(raw) - length + 1
                out["row"] += [row] * count
                out["start"] += range(place >> 16, (place >> 16) + count)
                out["window"] += [hashlib.blake2b(raw[k:k + length], digest_size=16).digest()
                                  for k in range(count)]
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(out["row"], pa.int64()), "start": pa.array(out["start"], pa.int64()),
                "window": pa.array(out["window"], pa.binary())})

    return work


def _removing(length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch):
                out: dict[str, list] = {"n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
                for copied, runs, a, b in zip(rows.column("copied").to_pylist(), rows.column("runs").to_pylist(),
                                              offsets[:-1].tolist(), offsets[1:].tolist()):
                    own, marks = data[a:b], np.zeros(b - a + 1, np.int32)
                    if copied and b - a >= length:
                        runs = [{"a": 0, "b": b - a - length + 1}]
                    for run in runs or ():  # starts a to b, each covering `length` bytes
                        marks[run["a"]] += 1
                        marks[run["b"] + length - 1] -= 1
                    gone = np.cumsum(marks)[:-1] > 0
                    kept = own[~gone].tobytes()
                    out["n_removed"].append(int(gone.sum()))
                    out["n_spans"].append(int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum()))
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    out["kept"].append(kept)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": rows.column("doc_id"), "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                    "n_removed": pa.array(out["n_removed"], pa.int64()),
                    "n_spans": pa.array(out["n_spans"], pa.int64()),
                    "kept_sha256": pa.array(out["kept_sha256"], pa.string()),
                    "kept": pa.array(out["kept"], pa.binary())})

    return work


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                  most_contexts: int = MOST_CONTEXTS) -> tuple[DataFrame, DataFrame]:
    """For keyed texts (doc_id, text_key, text): the keys that occur several times, and for each
    other key the runs of window starts that repeat."""
    texts = docs.filter(F.length(F.col("text").cast("binary")) >= length)
    keys = texts.groupBy("text_key").agg(F.count("*").alias("n"), F.min("doc_id").alias("rep"))
    keys = written_table(keys, "text_keys")
    found = written_table(map_batches(
        texts.select(F.monotonically_increasing_id().alias("row"), "text_key", "text"),
        _anchoring(length, gram), "row long, text_key binary, "
        "anchors array<struct<hash:long,context:long,place:long>>"), "anchors")
    names, each = found.select("row", "text_key"), found.select("row", F.inline("anchors"))
    # Written, so that the join below deals out both sides itself and a hot anchor can be split.
    repeated = written_table(each.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1")
                             .select("hash"), "repeated")
    known = written_table(each.join(repeated, "hash"), "known")
    contexts = written_table(known.groupBy("hash", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("at")), "contexts")
    first = F.shiftright("place", 16)
    same = known.join(contexts.filter("n > 1").select("hash", "context"), ["hash", "context"], "left_semi") \
        .select("row", F.struct(first.alias("a"), (
            first + F.shiftright("place", 8).bitwiseAND(255) + 1).alias("b")).alias("run"))

    buckets = contexts.groupBy("hash").agg(F.count("*").alias("k"), F.count_if(F.col("n") == 1).alias("single")) \
        .filter("k > 1 and single > 0").select("hash", (F.col("k") > most_contexts).alias("hot"))
    wanted = contexts.join(buckets, "hash").select("at.*", "hash", "hot").join(names, "row")
    wanted = wanted.groupBy("text_key").agg(F.collect_list(F.struct("row", "hash", "place", "hot")).alias("wanted"))
    # One row of each text: by key and id, so that copies do not meet in one task.
    wanted = wanted.join(keys, "text_key").select(F.col("text_key").alias("key"), "rep", "wanted")
    one = texts.join(wanted, (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    cut = written_table(map_batches(one.select("text", "wanted"), _cutting(length),
                                    "row long, hash long, place long, hot boolean, bytes binary"), "cut")
    plain = cut.filter("not hot")
    size = plain.agg(F.sum(F.length("bytes"))).first()[0] or 0
    blocks = max(1, -(-int(size) // BLOCK_BYTES))
    sorted_ = plain.withColumn("block", F.pmod(F.xxhash64("hash"), F.lit(blocks))).groupBy("block") \
        .applyInPandas(_sorting(length), "row long, runs array<struct<a:long,b:long>>")
    sorted_ = sorted_.select("row", F.explode("runs").alias("run"))
    runs = same.union(sorted_)
    large = cut.filter("hot").select("row", "place", "bytes")
    if not large.isEmpty():
        windows = map_batches(large, _windows(length), "row long, start long, window binary")
        windows = written_table(windows.distinct(), "windows")
        twice = windows.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window")
        runs = runs.union(windows.join(twice, "window").select("row", F.struct(
            F.col("start").alias("a"), (F.col("start") + 1).alias("b")).alias("run")))
    runs = runs.groupBy("row").agg(F.collect_list("run").alias("runs"))
    runs = runs.join(names, "row").join(keys.filter("n = 1").select("text_key"), "text_key")
    return keys.filter("n > 1").select("text_key"), written_table(runs.select("text_key", "runs"), "runs")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row (doc_id, text)."""
    docs = clean_table(docs, doc_id="doc_id", text="text").withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("text_key", F.unhex(F.md5("text")))
    copied, runs = repeated_runs(docs, length, gram, most_contexts)
    copied = copied.withColumn("copied", F.lit(True))
    known = runs.join(copied, "text_key", "full")
    marked = docs.join(known, "text_key", "left").select(
        "doc_id", "text", F.coalesce("copied", F.lit(False)).alias("copied"),
        F.when(F.col("copied").isNull(), F.col("runs")).alias("runs"))
    return map_batches(marked, _removing(length),
                       "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                       "kept binary")
