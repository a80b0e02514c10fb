"""Near-duplicate detection by circulant MinHash.

A document's set is its distinct word shingles. Two fixed permutations of the 32-bit numbers
make all signature coordinates: the first scatters the shingles, and coordinate k is the
smallest value of the second one after a circular shift by k. Coordinates are grouped into
bands; documents that agree in a band are candidates, and a link needs the exact Jaccard
similarity of the full sets.

Equal texts are one node, named by its smallest id. A band's bucket is never expanded into all
its pairs: first each member is compared with the bucket's hub, and the links found are turned
into components; only buckets that still hold several components go on, with another hub, and
what then remains is compared block by block, without pairs of one component, and only similar
pairs leave a block. Pairs whose signatures
are far below the threshold (see `MARGIN`) are not compared exactly.

Chance of missing a link of similarity s: (1 - s^ROWS)^BANDS, 3e-6 at s = 0.8; and that of the
margin, below 1e-7 at s = 0.8.

Defined results: null, empty and wordless texts have no shingles and are linked with nothing;
rows with a null id take no part, and stay (component null, kept true); rows that repeat an id
and text get equal results; if an id comes with several texts, each row follows its own text,
and links of any of them count; an empty
table gives no rows. Other columns are not read. Shingles are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.llm.components import components, join_components
from txscore.llm.tasks import clean_table, map_batches, slices, written_table
from txscore.llm.words import SPACED, U64, grams, mix, split_words

BANDS, ROWS = 32, 5
SHINGLE = 4
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Share of equal coordinates below which a pair is not compared exactly: with 160 coordinates
#: this is over five standard deviations below 0.8.
MARGIN = 0.63
#: Pairs whose full sets are compared in one task.
PAIRS_A_TASK = 2000
#: Members of a block in the last comparison.
BLOCK = 512

_NONE = np.zeros(0, U64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct shingles of a text, sorted; of fewer words, the whole sequence as one."""
    if not len(words):
        return _NONE
    return np.unique(grams(words, min(size, len(words))) if len(words) >= size
                     else mix(grams(words, len(words)) + U64(len(words))))


def scatter(sets: np.ndarray) -> np.ndarray:
    """The first permutation, on numbers taken from 64-bit shingles."""
    return (mix(sets ^ U64(0xA5A5A5A55A5A5A5A)) >> U64(32)).astype(np.uint32)


def permute(x: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The second permutation: a bijection of the 32-bit numbers."""
    np.right_shift(x, np.uint32(16), out=out)
    out ^= x
    out *= np.uint32(0x7FEB352D)
    y = out >> np.uint32(15)
    out ^= y
    out *= np.uint32(0x846CA68B)
    np.right_shift(out, np.uint32(16), out=y)
    out ^= y
    return out


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """A row of coordinates for each non-empty set."""
    sizes = np.array([len(s) for s in sets])
    result = np.empty((len(sets), coordinates), np.uint32)
    if not len(sets):
        return result
    begin = 0
    while begin < len(sets):  # so many sets at a time that the arrays stay in the cache
        end = begin + max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), 32_768)))
        first = np.r_[0, np.cumsum(sizes[begin:end])[:-1]]
        x = scatter(np.concatenate(sets[begin:end]))
        out = np.empty_like(x)
        for k in range(coordinates):
            # Shifting the numbers is shifting the permutation, in a circle of 2^32.
            result[begin:end, k] = np.minimum.reduceat(permute(x, out), first)
            x += np.uint32(1)
        begin = end
    return result


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    keys = np.empty((len(signature), bands), U64)
    for band in range(bands):
        total = np.full(len(signature), band, U64)
        for k in range(band * rows, band * rows + rows):
            total = mix(total + signature[:, k].astype(U64) + U64(0x9E3779B97F4A7C15))
        keys[:, band] = total
    return keys


def _sets(rows, data, offsets, size: int) -> list[np.ndarray]:
    words = split_words(data, offsets, SPACED)
    return [shingles(words.hash[words.first[i]:words.first[i + 1]], size)
            for i in range(rows.num_rows)]


def _signing(size: int, bands: int, rows_: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch):
                sets = _sets(rows, data, offsets, size)
                full = np.flatnonzero([len(s) > 0 for s in sets])
                signature = signatures([sets[i] for i in full], bands * rows_)
                keys = band_keys(signature, bands, rows_)
                ends = np.zeros(rows.num_rows, np.int64)
                ends[full] = 1
                ends = np.r_[0, np.cumsum(ends)]
                low = signature.astype(np.uint8)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": rows.column("doc_id"), "text_key": rows.column("text_key"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "bands": pa.ListArray.from_arrays((ends * bands).astype(np.int32),
                                                      keys.reshape(-1).view(np.int64)),
                    "low": pa.array([low[ends[i]].tobytes() if ends[i + 1] > ends[i] else None
                                     for i in range(rows.num_rows)], pa.binary())})

    return work


def _collecting_sets(size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch):
                sets = _sets(rows, data, offsets, size)
                yield pa.RecordBatch.from_pydict({
                    "node": rows.column("node"), "text_key": rows.column("text_key"),
                    "items": pa.array([s.tobytes() for s in sets], pa.binary()),
                    "short": pa.array([np.unique((s >> U64(32)).astype(np.uint32)).tobytes()
                                       for s in sets], pa.binary())})

    return work


def _estimating(margin: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = _matrix(batch.column("low_a")), _matrix(batch.column("low_b"))
                near = np.flatnonzero((a == b).mean(axis=1) >= margin)
                yield batch.select(["a", "b"]).take(pa.array(near))

    return work


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _confirming(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k, (one, other) in enumerate(zip(batch.column("items_a"), batch.column("items_b"))):
                a, b = np.frombuffer(one.as_buffer(), U64), np.frombuffer(other.as_buffer(), U64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * common >= percent * (len(a) + len(b) - common):
                    keep.append(k)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return work


def _comparing(margin: float, percent: int):
    """Pairs of two blocks with different labels that are similar by their shortened sets, which
    the confirmation follows; each pair comes from the first band it shares."""
    # Shortening merges few shingles: a half percent makes up for far more.
    least = (percent - 0.5) / 100

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        low = np.stack([np.frombuffer(x, np.uint8) for x in frame["low"]])
        bands = np.stack([np.asarray(x, np.int64) for x in frame["bands"]])
        node, label = frame["node"].to_numpy(), frame["label"].to_numpy()
        side, band = frame["side"].to_numpy(), frame["band"].iloc[0]
        sets = [np.frombuffer(x, np.uint32) for x in frame["short"]]
        size = np.array([len(x) for x in sets])
        right = np.flatnonzero(side != 0)
        pairs = [np.zeros((0, 2), np.int64)]
        for i in np.flatnonzero(side != 1):
            rest = right[(label[right] != label[i]) & ((side[right] == 1) | (right > i))]
            rest = rest[np.minimum(size[rest], size[i]) >= least * np.maximum(size[rest], size[i])]
            rest = rest[(low[rest] == low[i]).mean(axis=1) >= margin] if len(rest) else rest
            if len(rest):
                first = bands[rest, (bands[rest] == bands[i]).argmax(axis=1)]
                rest = rest[first == band]
                common = np.array([len(np.intersect1d(sets[i], sets[k], assume_unique=True))
                                   for k in rest])
                rest = rest[common >= least * (size[i] + size[rest] - common)]
                pairs.append(np.stack([np.full(len(rest), node[i]), node[rest]], axis=1))
        found = np.sort(np.concatenate(pairs), axis=1)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return work


def _open(members: DataFrame, labels: DataFrame, at_most: int) -> DataFrame:
    """(band, node, label) of the buckets that still hold several components."""
    labelled = members.join(labels.withColumnRenamed("id", "node"), "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("label"))
    several = labelled.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")) \
        .filter("x <> y").select("band")
    return written_table(labelled.join(several, "band"), "open", at_most)


def _blocks(open_: DataFrame, nodes: DataFrame, sets: DataFrame, block: int, margin: float,
            percent: int) -> DataFrame:
    """Pairs of different components within a bucket that are similar.

    Members with the bucket's most common label are compared with the others, and the others
    with each other, a block against a block.
    """
    sizes = open_.groupBy("band", "label").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("band").agg(F.max(F.struct("n", "label")).alias("main"),
                                      F.sum("n").alias("n"))
    parts = lambda n: F.ceil(n / F.lit(block)).cast("int")
    members = open_.join(sizes, "band").select(
        "band", "node", "label", (F.col("label") == F.col("main.label")).alias("is_main"),
        parts(F.col("main.n")).alias("n_main"), parts(F.col("n") - F.col("main.n")).alias("n_rest"))
    members = members.withColumn("own", F.expr(
        "cast(pmod(xxhash64(node), if(is_main, n_main, n_rest)) as int)"))
    meets = F.expr("""
        if(is_main,
           transform(sequence(0, n_rest - 1), i -> struct(0 as kind, i as i, own as j, 1 as side)),
           concat(transform(sequence(0, n_main - 1), j -> struct(0 as kind, own as i, j as j, 0 as side)),
                  transform(sequence(0, n_rest - 1), j -> struct(1 as kind, least(own, j) as i,
                      greatest(own, j) as j, if(own = j, 2, if(own < j, 0, 1)) as side))))""")
    placed = members.select("band", "node", "label", F.explode(meets).alias("at")).select(
        "band", "node", "label", "at.*")
    placed = placed.join(nodes.select("node", "low", "bands"), "node") \
        .join(sets.select("node", "short"), "node")
    return placed.groupBy("band", "kind", "i", "j").applyInPandas(
        _comparing(margin, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                    bands: int = BANDS, rows: int = ROWS, margin: float = MARGIN,
                    block: int = BLOCK) -> DataFrame:
    """Documents (doc_id, text) with n_shingles, component_id and kept."""
    docs = clean_table(docs, doc_id="doc_id", text="text").withColumn(
        "text_key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    signed = written_table(map_batches(
        docs, _signing(shingle, bands, rows),
        "doc_id long, text_key binary, n_shingles long, bands array<long>, low binary"), "signed")
    known = signed.filter("doc_id is not null")
    nodes = written_table(
        known.filter("n_shingles > 0").groupBy("text_key")
        .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"),
             F.first("low").alias("low")), "nodes")
    in_band = nodes.select("node", F.explode("bands").alias("band"))
    shared = in_band.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("hub")) \
        .filter("n > 1")
    buckets = written_table(in_band.join(shared, "band"), "buckets")

    # By id and text, so copies of one text do not meet in one task.
    wanted = buckets.select("node").distinct().join(nodes.select("node", "text_key"), "node")
    texts = docs.join(wanted.withColumnRenamed("text_key", "node_key"),
                      (F.col("doc_id") == F.col("node")) & (F.col("text_key") == F.col("node_key")))
    sets = written_table(map_batches(texts.select("node", "text_key", "text"),
                                     _collecting_sets(shingle),
                                     "node long, text_key binary, items binary, short binary")
                         .dropDuplicates(["node", "text_key"]), "sets")

    def side(table: DataFrame, column: str, name: str) -> DataFrame:
        return table.select(F.col("node").alias(name), F.col(column).alias(f"{column}_{name}"))

    def near(pairs: DataFrame) -> DataFrame:
        lows = pairs.join(side(nodes, "low", "a"), "a").join(side(nodes, "low", "b"), "b")
        return map_batches(lows.select("a", "b", "low_a", "low_b"), _estimating(margin),
                           "a long, b long").distinct()

    def confirm(pairs: DataFrame, at_most: int | None = None) -> DataFrame:
        sized = pairs.join(side(sets, "items", "a"), "a").join(side(sets, "items", "b"), "b")
        small = F.least(F.length("items_a"), F.length("items_b"))
        large = F.greatest(F.length("items_a"), F.length("items_b"))
        sized = sized.filter(100 * small >= percent * large)
        return written_table(map_batches(sized.select("a", "b", "items_a", "items_b"),
                                         _confirming(percent), "a long, b long"), "confirmed",
                             at_most, PAIRS_A_TASK)

    def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
        count = links.count()  # each link brings two new ids at most
        return labels if not count else written_table(
            join_components(labels, links), "labels", labels.count() + 2 * count)

    members = buckets.count()
    first = written_table(near(buckets.filter("node <> hub").select(
        F.col("hub").alias("a"), F.col("node").alias("b")).distinct()), "near", members)
    links = confirm(first, first.count())
    labels = written_table(components(links, links.count()), "labels", 2 * links.count())
    large = buckets.filter("n > 2").select("node", "band", "hub")
    # Another hub, a different one in each bucket, for the members that differ from it.
    open_ = _open(large.select("node", "band"), labels, members)
    hubs = open_.groupBy("band").agg(
        F.max_by(F.struct("node", "label"), F.xxhash64("node", "band")).alias("hub"))
    second = (open_.join(hubs, "band").filter("label <> hub.label")
              .select(F.least("node", "hub.node").alias("a"),
                      F.greatest("node", "hub.node").alias("b")).distinct()
              .join(first, ["a", "b"], "left_anti"))
    second = written_table(near(second), "near", members)
    labels = joined(labels, confirm(second, second.count()))
    # The rest, block against block.
    rest = _blocks(_open(large.select("node", "band"), labels, members), nodes, sets, block, margin, percent)
    rest = rest.join(first.union(second), ["a", "b"], "left_anti")
    labels = joined(labels, confirm(rest))

    named = nodes.select("text_key", "node").join(labels.withColumnRenamed("id", "node"), "node",
                                                  "left")
    named = named.select("text_key", F.coalesce("component", "node").alias("component_id"))
    result = known.select("doc_id", "text_key", "n_shingles").join(named, "text_key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    nameless = signed.filter("doc_id is null").select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return result.union(nameless).withColumn("kept", F.expr("doc_id <=> component_id"))
