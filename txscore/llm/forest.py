"""Approximate nearest neighbours with a hash-prefix forest.

Each tree gives every vector a long string of bits, the sides of random hyperplanes it lies on,
and is kept as sorted arrays of these strings. A query descends every tree to its longest
matching prefix, and all trees then ascend together: the prefix is shortened level by level in
all of them until they hold enough candidates. Their cosines are computed on the original
vectors.

Sorted arrays are cut by the first bits of the string into groups of about `GROUP` vectors, and
a group that is larger into parts by hash, which its queries visit all; a group's queries are cut
into blocks by hash in the same way, and each block meets each part in a task of its own. So
neither an array nor the queries beside it grow with the data, and what the parts hold adds up;
vectors of groups without queries stay where they are. Equal vectors are one node of the forest, named by
their smallest id. A query that finds fewer neighbours than asked for within its groups goes
through whole trees instead, up to all vectors.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components,
and rows with a null id take no part; vectors are neighbours only of those with as many
components; an empty table gives no rows; repeated rows count once; an id with several vectors
is as near as the nearest of them; equal scores go to the smaller id. Other columns are not read.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txscore.llm.tasks import clean_table, map_batches, ship, written_table

NEAREST = 5
TREES, BITS, SEED = 16, 48, 11
#: How many queries, chosen by hash, are compared with all vectors to set how many candidates
#: the trees must hold before a query stops ascending, and the share of their true neighbours
#: that these candidates must contain.
TUNING, RECALL = 128, 0.95
#: Vectors in a group of a sorted array, on average at least, and in a part of it, or queries in
#: a block, on average at most.
GROUP, GROUP_MOST = 1024, 2048
#: Queries are those rows whose id is divisible by this.
QUERY_STEP = 50


class Forest(NamedTuple):
    trees: int = TREES
    bits: int = BITS
    seed: int = SEED
    tuning: int = TUNING
    recall: float = RECALL
    group: int = GROUP
    group_most: int = GROUP_MOST


def planes(dim: int, forest: Forest) -> np.ndarray:
    """Normals of the hyperplanes, a column each, all trees' first bits first: sets of as many
    as there are dimensions are at right angles, so the trees' leading bits tell different things."""
    rng = np.random.default_rng([forest.seed, dim])
    wanted = forest.trees * forest.bits
    blocks = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-wanted // dim))]
    return np.concatenate(blocks, axis=1)[:, :wanted]


def strings(vectors: np.ndarray, forest: Forest) -> np.ndarray:
    """A row of bit strings, as numbers, for each vector: one per tree."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    side = (unit @ planes(vectors.shape[1], forest) > 0).reshape(len(vectors), forest.bits, forest.trees)
    return side.transpose(0, 2, 1) @ (1 << np.arange(forest.bits - 1, -1, -1, dtype=np.int64))


def cosines(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosine of one vector and many, in double precision."""
    return (others * query).sum(axis=1) / (
        math.sqrt((query * query).sum()) * np.sqrt((others * others).sum(axis=1)))


def _hashing(forest: Forest):
    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                flat = rows.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                codes = strings(flat.reshape(-1, dim), forest)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.FixedSizeListArray.from_arrays(
                        pa.array(codes.reshape(-1)), forest.trees).cast(pa.list_(pa.int64()))],
                    names=[*rows.schema.names, "codes"])

    return work


def matching_bits(codes: np.ndarray, code: np.ndarray, bits: int) -> np.ndarray:
    """How many leading bits of each string are those of `code`."""
    return bits - np.frexp((codes ^ code).astype(np.float64))[1]


def _comparing(sample: list[tuple[int, np.ndarray, np.ndarray]], forest: Forest, nearest: int):
    """Per task and sampled query: strings by matching bits, and its nearest vectors here."""

    def work(batches):
        counts = {query: np.zeros(forest.bits + 1, np.int64) for query, _, _ in sample}
        best: dict[int, list[tuple[float, int, int]]] = {query: [] for query, _, _ in sample}
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes, dims = batch.column("node").to_numpy(), batch.column("dim").to_numpy()
            codes = batch.column("codes").flatten().to_numpy().reshape(len(nodes), -1)
            vectors = np.asarray(batch.column("vector").to_pylist(), object)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                block = np.array([vectors[k] for k in rows], np.float64)
                for query, vector, code in sample:
                    if len(vector) == dim:
                        others = rows[nodes[rows] != query]
                        bits = matching_bits(codes[others], code, forest.bits)
                        counts[query] += np.bincount(bits.reshape(-1), minlength=forest.bits + 1)
                        score = cosines(vector, block)[nodes[rows] != query]
                        top = np.argsort(-score, kind="stable")[:nearest]
                        best[query] = sorted(best[query] + [
                            (-float(score[k]), int(nodes[others[k]]), int(bits[k].max()))
                            for k in top])[:nearest]
        yield pa.RecordBatch.from_pydict({
            "query": pa.array([q for q, _, _ in sample], pa.int64()),
            "counts": pa.array([counts[q].tolist() for q, _, _ in sample], pa.list_(pa.int64())),
            "best": pa.array([[{"score": -s, "node": n, "bits": b} for s, n, b in best[q]]
                              for q, _, _ in sample],
                             pa.list_(pa.struct([("score", pa.float64()), ("node", pa.int64()),
                                                 ("bits", pa.int32())])))})

    return work


def tune(nodes: DataFrame, queries: DataFrame, forest: Forest, nearest: int) -> tuple[int, int]:
    """(candidates, prefix): how many candidates reach the recall wanted on a sample of queries,
    and how many leading bits all of these queries share with enough of the vectors."""
    rows = queries.orderBy(F.xxhash64("node"), "node").limit(forest.tuning).collect()
    sample = [(r.node, np.array(r.vector, np.float64), np.array(r.codes, np.int64)) for r in rows]
    if not sample:
        return 0, 0
    found = written_table(map_batches(
        nodes.select("node", "dim", "codes", "vector"), _comparing(sample, forest, nearest),
        "query long, counts array<long>, best array<struct<score:double,node:long,bits:int>>"), "tuning")
    counts = found.groupBy("query").agg(*(F.sum(F.get("counts", F.lit(k))).alias(f"at_{k}")
                                          for k in range(forest.bits + 1))).collect()
    order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    best = found.select("query", F.explode("best").alias("b")).select("query", "b.*") \
        .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= nearest).collect()
    bits: dict[int, list[int]] = {}
    for row in best:
        bits.setdefault(row.query, []).append(row.bits)
    totals = {row.query: np.cumsum([row[f"at_{k}"] for k in range(forest.bits, -1, -1)])[::-1]
              for row in counts}
    return _least_candidates(totals, bits, forest.recall)


def _least_candidates(totals: dict[int, np.ndarray], bits: dict[int, list[int]],
                      recall: float) -> tuple[int, int]:
    """The smallest number of candidates with enough recall, by halving the range of totals."""
    values = np.unique(np.concatenate(list(totals.values())))
    low, high = 0, len(values) - 1

    def levels(least: int) -> dict[int, int]:
        return {q: int(np.flatnonzero(t >= least)[-1]) if t[0] >= least else 0
                for q, t in totals.items()}

    def reached(least: int) -> float:
        at = levels(least)
        known = [b >= at[q] for q, own in bits.items() for b in own]
        return float(np.mean(known)) if known else 1.0

    while low < high:
        middle = (low + high) // 2
        if reached(int(values[middle])) >= recall:
            high = middle
        else:
            low = middle + 1
    least = int(values[low])
    return least, max(0, min(levels(least).values()) - 1)


def _counting(forest: Forest, prefix: int):
    """For each query of a group, how many of its vectors match each length of prefix."""
    levels = np.arange(forest.bits + 1)
    shift = forest.bits - levels

    def work(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        codes = np.sort(index["code"].to_numpy(np.int64))
        own = queries["code"].to_numpy(np.int64)
        low = (own[:, None] >> shift) << shift
        counts = np.searchsorted(codes, low + (np.int64(1) << shift)) - np.searchsorted(codes, low)
        counts[:, :prefix] = 0  # a group holds no shorter matches
        return pd.DataFrame({"query": queries["node"],
                             "counts": pd.Series(list(counts.astype(np.int32)), queries.index, object)})

    return work


def _scoring(forest: Forest, nearest: int):
    """For each query of a group, the nearest of the vectors that match its prefix."""

    def work(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = {"query": [], "node": [], "score": []}
        if len(index) and len(queries):
            order = np.argsort(index["code"].to_numpy(np.int64), kind="stable")
            codes = index["code"].to_numpy(np.int64)[order]
            nodes = index["node"].to_numpy(np.int64)[order]
            vectors = np.stack(index["vector"].to_numpy())[order].astype(np.float64)
            for query, code, level, vector in zip(queries["node"], queries["code"],
                                                  queries["level"], queries["vector"]):
                shift = forest.bits - int(level)
                low = (int(code) >> shift) << shift
                a, b = np.searchsorted(codes, [low, low + (1 << shift)])
                if a == b:
                    continue
                score = cosines(np.asarray(vector, np.float64), vectors[a:b])
                best = np.lexsort((nodes[a:b], -score))[:nearest + 1]
                found["query"] += [query] * len(best)
                found["node"] += nodes[a:b][best].tolist()
                found["score"] += score[best].tolist()
        return pd.DataFrame(found).astype({"query": np.int64, "node": np.int64, "score": np.float64})

    return work


def _in_groups(nodes: DataFrame, forest: Forest, prefix: int) -> DataFrame:
    """A row per node and tree: its string, and the group it is in."""
    return nodes.select("*", F.posexplode("codes").alias("tree", "code")).drop("codes").withColumn(
        "group", F.shiftright("code", forest.bits - prefix))


def _fresh(df: DataFrame, *names: str) -> DataFrame:
    """The columns as new ones, so that two tables from one source can be told apart."""
    return df.select(*(F.col(name).alias(name) for name in names))


#: What a cogroup is named by: one part of a group's vectors and one block of its queries.
_MEETING = ("tree", "dim", "group", "part", "block")


def _dealt(nodes: DataFrame, queries: DataFrame, forest: Forest, prefix: int) -> tuple[DataFrame, DataFrame]:
    """Vectors and queries, a row per tree and meeting of a part with a block."""
    group = ["tree", "dim", "group"]
    index, own = _in_groups(nodes, forest, prefix), _in_groups(queries, forest, prefix)

    def pieces(rows: DataFrame, name: str) -> DataFrame:
        return _fresh(rows, *group).groupBy(group).agg(
            F.ceil(F.count("*") / F.lit(forest.group_most)).cast("int").alias(name))

    def every(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

    sizes = written_table(pieces(index, "parts").join(pieces(own, "blocks"), group), "sizes")
    index = index.join(sizes, group).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("block", every("blocks"))
    own = own.join(sizes, group).withColumn(
        "block", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("blocks")).cast("int")).withColumn("part", every("parts"))
    return index.drop("parts", "blocks"), own.drop("parts", "blocks")


def _search(nodes: DataFrame, queries: DataFrame, forest: Forest, candidates: float, prefix: int,
            nearest: int) -> DataFrame:
    """(query, node, score): the nearest candidates of each tree and part."""
    keys = list(_MEETING)
    index, own = _dealt(nodes, queries, forest, prefix)
    counts = _fresh(index, *keys, "node", "code").groupBy(keys).cogroup(
        _fresh(own, *keys, "node", "code").groupBy(keys)).applyInPandas(
        _counting(forest, prefix), "query long, counts array<int>")
    counts = counts.groupBy("query").agg(*(F.sum(F.get("counts", F.lit(k))).alias(f"at_{k}")
                                           for k in range(prefix, forest.bits + 1)))
    levels = counts.select("query", F.coalesce(*(
        F.when(F.col(f"at_{k}") >= F.lit(float(candidates)), F.lit(k))
        for k in range(forest.bits, prefix - 1, -1)), F.lit(prefix)).alias("level"))
    levels = written_table(levels, "levels")
    own = own.join(levels.withColumnRenamed("query", "node"), "node")
    return _fresh(index, *keys, "node", "code", "vector").groupBy(keys).cogroup(
        _fresh(own, *keys, "node", "code", "vector", "level").groupBy(keys)).applyInPandas(
        _scoring(forest, nearest), "query long, node long, score double")


def nearest_neighbours(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding",
                       step: int = QUERY_STEP, nearest: int = NEAREST,
                       forest: Forest = Forest()) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query row's nearest rows."""
    ship(vectors.sparkSession)
    rows = clean_table(vectors, id=id_column, vector=column)
    if rows.schema["vector"].dataType.elementType.typeName() != "float":
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    rows = rows.filter("""id is not null and vector is not null
        and size(vector) > 0 and not exists(vector, x -> x is null or isnan(x) or abs(x) = double('inf'))
        and exists(vector, x -> x <> 0)""")
    kind = rows.schema["vector"].dataType.simpleString()
    # Adding 0.0 turns -0.0 into 0.0, so equal vectors have equal keys.
    plain = F.transform("vector", lambda x: x + F.lit(0.0))
    keyed = rows.withColumn("key_a", F.xxhash64(plain)).withColumn("key_b", F.xxhash64(F.lit(1), plain))
    ids = keyed.select("key_a", "key_b", "id").dropDuplicates()
    smallest = Window.partitionBy("key_a", "key_b").orderBy("id")
    # The smallest ids of equal vectors are all that a result can hold.
    copies = written_table(ids.withColumn("place", F.row_number().over(smallest))
                           .filter(F.col("place") <= nearest + 1), "copies")
    names = copies.filter("place = 1").select("key_a", "key_b", F.col("id").alias("node"))
    named = keyed.join(names, ["key_a", "key_b"])
    nodes = written_table(map_batches(
        named.filter("id = node").select("key_a", "key_b", "node", "vector", F.size("vector").alias("dim"))
        .dropDuplicates(["node", "key_a", "key_b"]),
        _hashing(forest), f"key_a long, key_b long, node long, vector {kind}, dim int, "
                          "codes array<long>"), "nodes")
    asking = written_table(ids.filter(F.pmod("id", F.lit(step)) == 0).join(names, ["key_a", "key_b"])
                           .select(F.col("id").alias("query_id"), "node"), "asking")
    queries = nodes.join(asking.select("node").distinct(), "node", "left_semi")
    candidates, prefix = tune(nodes, queries, forest, nearest)
    prefix = max(0, min(prefix, math.floor(math.log2(max(1, nodes.count()) / forest.group))))
    members = copies.join(names, ["key_a", "key_b"]).select("node", F.col("id").alias("vec_id"))

    def answers(queries: DataFrame, candidates: float, prefix: int) -> DataFrame:
        near = _search(nodes.select("node", "dim", "codes", "vector"),
                       queries.select("node", "dim", "codes", "vector"), forest, candidates, prefix,
                       nearest)
        near = near.groupBy("query", "node").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
        near = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= nearest + 1)
        found = near.join(members, "node").join(
            asking.withColumnRenamed("node", "query"), "query").filter("vec_id <> query_id")
        found = found.groupBy("query_id", "query", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return written_table(found.withColumn("rank", F.row_number().over(order))
                             .filter(F.col("rank") <= nearest), "answers")

    result = answers(queries, candidates, prefix)
    full = result.filter(F.col("rank") == nearest).select("query_id")
    short = asking.join(full, "query_id", "left_anti").select("node").distinct()
    if not short.isEmpty():  # through whole trees, to all vectors
        again = answers(queries.join(short, "node", "left_semi"), math.inf, 0)
        result = result.join(again.select("query_id").distinct(), "query_id", "left_anti").unionByName(again)
    return result.select("query_id", "rank", "vec_id", "score")
