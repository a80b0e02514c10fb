"""Near-duplicate vectors by randomised-rotation binary codes with correction factors.

A vector of length one is turned by a random rotation, and its code is the signs of what comes
out. The code is a vector too, of equal components; with its inner product with the vector it
stands for as a correction factor, the inner product of a code and any other vector estimates that
of the two vectors without bias, and the error's spread is known from the factor. A pair whose
estimate lies further below the least cosine than the error can account for, by `sigmas` times its
spread, is not linked; all other pairs are computed anew from the original vectors.

Pairs come from buckets: in each of many tables a vector's key is made of the largest
coordinates in some random directions, so near vectors share a bucket with a known probability. As
many tables are taken as make the chance to miss a pair right at the least cosine `miss`, which is
far smaller above it; keys are long enough for vectors without structure to be mostly alone.

A bucket is not expanded into pairs. Each member is compared with the bucket's hub, its first
vector. Vectors within half the angle of a hub are a ball: all of them are linked with one
another, so they are counted, not compared. What remains is compared block against block where
the bucket lies; each pair counts in the first bucket that it shares, and blocks give sums and
spanning links only. So a group of close vectors costs in proportion to its members, whatever
their number; a group of vectors between half the angle and the angle is compared in full, as
their links have to be counted, in tasks of bounded size.

Equal vectors are one node with a weight. Defined results: vectors that are null, empty or zero,
or hold null or non-finite components, and rows with a null id link with nothing; vectors link
with those of as many components only; rows that repeat an id and its vector are one vector, and
returned each; an id's different vectors are vectors of their own; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import functools
import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.llm.components import components
from txscore.llm.tasks import clean_table, map_batches, written_table
from txscore.llm.words import U64, mix

LEAST = 0.9


class Plan(NamedTuple):
    """Parameters of the search; `miss` is the chance to miss a pair at the least cosine."""

    least: float = LEAST
    miss: float = 1e-3
    sigmas: float = 5.0
    block: int = 512
    seed: int = 11


#: Directions in a part of a key at most, and bits of a key beyond those that number the vectors.
WIDTH, SPARE_BITS = 32, 4
#: Members of a bucket up to which it is compared whole, beside others, and rows that are then
#: compared side by side.
SMALL, PACK = 32, 4000
#: Numbers in an array of coordinates.
AT_ONCE = 1 << 22


def code_bits(dim: int) -> int:
    """Bits of a code: all dimensions, filled up with zeros to a multiple of 64."""
    return max(128, -(-dim // 64) * 64)


@functools.cache
def rotation(dim: int, seed: int) -> np.ndarray:
    """A random rotation of vectors filled up with zeros, a row for each dimension."""
    bits = code_bits(dim)
    rng = np.random.default_rng([seed, dim])
    return np.ascontiguousarray(np.linalg.qr(rng.standard_normal((bits, bits)))[0][:dim])


def encode(unit: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign codes of vectors of length one, and their correction factors."""
    turned = unit @ rotation(unit.shape[1], seed)
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])


def directions(codes: np.ndarray) -> np.ndarray:
    """Codes as vectors of length one."""
    signs = np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1
    return signs / np.float32(math.sqrt(signs.shape[1]))


def least_estimate(factor: np.ndarray, bits: int, least: float, sigmas: float) -> np.ndarray:
    """The least estimate with which a pair may reach the least cosine.

    The error is the code's part at right angles to its vector, seen along the other vector's
    part at right angles to it, which is no longer than the sine when the cosine is reached."""
    spread = np.sqrt(np.maximum(0, 1 - factor * factor) / (bits - 1)) / factor
    return least - sigmas * math.sqrt(max(0.0, 1 - least * least)) * spread - 1e-5


class Keys(NamedTuple):
    """How the keys of vectors with so many dimensions are made."""

    tables: int
    parts: int
    width: int
    signs: int


@functools.cache
def key_plan(count: int, dim: int, least: float, miss: float) -> Keys:
    """Keys long enough for `count` vectors, and enough tables of them."""
    width = 1 << int(math.log2(min(WIDTH, dim)))
    bits = math.ceil(math.log2(max(2, count))) + SPARE_BITS
    parts, signs = divmod(bits, 1 + int(math.log2(width)))
    rng = np.random.default_rng([dim, 5])
    x, z = rng.standard_normal((2, 8000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-300)
    y = least * x + math.sqrt(1 - least * least) * z if dim > 1 else x
    # In as many dimensions all rotations are alike, so the first directions stand for all.
    same = (_largest(x[:, None, :width]) == _largest(y[:, None, :width])).mean()
    chance = float(same) ** parts * (1 - math.acos(least) / math.pi) ** signs
    tables = math.ceil(math.log(miss) / math.log1p(-min(chance, 1 - miss)))
    return Keys(max(1, tables), parts, width, signs)


def _largest(coordinates: np.ndarray) -> np.ndarray:
    """The largest coordinate's place and sign, along the last axis."""
    place = np.abs(coordinates).argmax(axis=-1)
    value = np.take_along_axis(coordinates, place[..., None], axis=-1)[..., 0]
    return place * 2 + (value > 0)


@functools.cache
def _table_directions(dim: int, keys: Keys, seed: int) -> np.ndarray:
    """Random directions, those of a part at right angles to one another, for all tables."""
    rng = np.random.default_rng([seed, dim, 3])
    found = []
    for _ in range(keys.tables):
        for _ in range(keys.parts):
            found.append(np.linalg.qr(rng.standard_normal((dim, keys.width)))[0])
        found.append(rng.standard_normal((dim, keys.signs)))
    return np.concatenate(found, axis=1).astype(np.float32)


def bucket_keys(unit: np.ndarray, keys: Keys, seed: int) -> np.ndarray:
    """A row of keys for each vector, one for each table."""
    dim = unit.shape[1]
    step = keys.parts * keys.width + keys.signs
    all_directions = _table_directions(dim, keys, seed)
    found = np.empty((len(unit), keys.tables), U64)
    at_once = max(1, AT_ONCE // (keys.tables * step))
    unit = unit.astype(np.float32)
    for k in range(0, len(unit), at_once):
        seen = (unit[k:k + at_once] @ all_directions).reshape(-1, keys.tables, step)
        split = keys.parts * keys.width
        parts = _largest(seen[:, :, :split].reshape(len(seen), keys.tables, keys.parts, keys.width))
        total = np.broadcast_to(mix(np.arange(keys.tables, dtype=U64) + U64(dim << 20)),
                                (len(seen), keys.tables))
        for part in range(keys.parts):
            total = mix(total + parts[:, :, part].astype(U64) + U64(0x9E3779B97F4A7C15))
        for sign in range(keys.signs):
            total = mix(total + (seen[:, :, split + sign] > 0).astype(U64) + U64(0x9E3779B97F4A7C15))
        found[k:k + at_once] = total
    return found.view(np.int64)


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled to length one, in double precision."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each row with the other's, in double precision."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _by_dim(column: pa.Array):
    """(dimensions, places, vectors) of a column of vectors."""
    dims = column.value_lengths().to_numpy()
    for dim in np.unique(dims):
        places = np.flatnonzero(dims == dim)
        flat = column.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False)
        yield int(dim), places, flat.astype(np.float64).reshape(-1, dim)


def _coding(plan: Plan, count: int):
    def work(batches):
        for batch in batches:
            for dim, places, vectors in _by_dim(batch.column("vector")):
                unit = units(vectors)
                codes, factor = encode(unit, plan.seed)
                keys = bucket_keys(unit, key_plan(count, dim, plan.least, plan.miss), plan.seed)
                rows = batch.take(pa.array(places))
                ends = (np.arange(len(keys) + 1) * keys.shape[1]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array([c.tobytes() for c in codes], pa.binary()),
                     pa.array(factor), pa.ListArray.from_arrays(ends, keys.reshape(-1))],
                    names=[*rows.schema.names, "code", "factor", "keys"])

    return work


def _codes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _estimating(plan: Plan):
    """Pairs of which one side's code and the other one's vector allow the least cosine."""

    def work(batches):
        for batch in batches:
            sizes = np.array([len(x.as_py()) for x in batch.column("code_b")])
            for dim, places, vectors in _by_dim(batch.column("vector_a")):
                places, vectors = (x[sizes[places] * 8 == code_bits(dim)] for x in (places, vectors))
                if not len(places):
                    continue
                codes = _codes(batch.column("code_b").take(pa.array(places)))
                factor = batch.column("factor_b").to_numpy()[places]
                turned = units(vectors) @ rotation(dim, plan.seed)
                estimate = (turned * directions(codes)).sum(axis=1) / factor
                near = estimate >= least_estimate(factor, turned.shape[1], plan.least, plan.sigmas)
                yield batch.select(["a", "b"]).take(pa.array(places[near]))

    return work


def _half_angle(least: float) -> float:
    """The cosine of half the least cosine's angle, a little more for rounding."""
    return math.cos(math.acos(least) / 2) + 1e-9


def _confirming(plan: Plan):
    """Pairs that reach the least cosine, whether within half its angle, and the first key shared."""

    def work(batches):
        for batch in batches:
            sizes = batch.column("vector_b").value_lengths().to_numpy()
            for dim, places, vectors in _by_dim(batch.column("vector_a")):
                places, vectors = (x[sizes[places] == dim] for x in (places, vectors))
                other = batch.column("vector_b").take(pa.array(places)).flatten()
                other = other.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                if not len(places):
                    continue
                cosine = cosines(vectors, other)
                near = cosine >= plan.least
                places, cosine = places[near], cosine[near]
                rows = pa.array(places)
                keys_a, keys_b = (batch.column(name).take(rows).flatten().to_numpy().reshape(len(places), -1)
                                  for name in ("keys_a", "keys_b"))
                first = (keys_a == keys_b).argmax(axis=1) if len(places) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_pydict({
                    "a": batch.column("a").take(rows), "b": batch.column("b").take(rows),
                    "close": pa.array(cosine >= _half_angle(plan.least)),
                    "first": pa.array(keys_a[np.arange(len(places)), first], pa.int64())})

    return work


def spanning(adjacent: np.ndarray) -> np.ndarray:
    """As few of the links in a symmetric matrix as connect what they all connect."""
    seen, found = np.zeros(len(adjacent), bool), [np.zeros((0, 2), np.int64)]
    for root in np.flatnonzero(adjacent.any(axis=1)).tolist():
        if seen[root]:
            continue
        seen[root] = True
        edge = np.array([root])
        while len(edge):
            new = np.flatnonzero(adjacent[edge].any(axis=0) & ~seen)
            found.append(np.stack([edge[adjacent[np.ix_(edge, new)].argmax(axis=0)], new], axis=1)
                         if len(new) else found[0])
            seen[new] = True
            edge = new
    return np.concatenate(found)


def _comparing(plan: Plan):
    """Sums of links and spanning links between the blocks of buckets in a frame."""

    def confirmed(own: pd.DataFrame, i: np.ndarray, j: np.ndarray, bucket: np.ndarray,
                  out: list[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray]:
        """Of these pairs of rows those that are linked; sums go out for pairs whose first shared
        bucket is the one given."""
        vectors = np.stack(own["vector"].to_numpy()).astype(np.float64)
        keys, weight = np.stack(own["keys"].to_numpy()), own["weight"].to_numpy()
        sums, kept = np.zeros(len(own), np.int64), []
        for k in range(0, len(i), 1 << 15):
            x, y, at = i[k:k + (1 << 15)], j[k:k + (1 << 15)], bucket[k:k + (1 << 15)]
            near = cosines(vectors[x], vectors[y]) >= plan.least
            x, y, at = x[near], y[near], at[near]
            here = keys[x, (keys[x] == keys[y]).argmax(axis=1)] == at
            np.add.at(sums, x[here], weight[y[here]])
            np.add.at(sums, y[here], weight[x[here]])
            kept.append(np.stack([x, y]))
        some = np.flatnonzero(sums)
        out.append(pd.DataFrame({"a": own["node"].to_numpy()[some], "b": -1, "n": sums[some]}))
        x, y = np.concatenate(kept, axis=1) if kept else np.zeros((2, 0), np.int64)
        return x, y

    def linked(own: pd.DataFrame, i: np.ndarray, j: np.ndarray, out: list[pd.DataFrame]) -> None:
        node = own["node"].to_numpy()
        out.append(pd.DataFrame({"a": node[i], "b": node[j], "n": 0}))

    def parts(own: pd.DataFrame):
        codes = np.frombuffer(b"".join(own["code"]), np.uint8).reshape(len(own), -1)
        unit = units(np.stack(own["vector"].to_numpy()).astype(np.float64))
        turned = (unit @ rotation(unit.shape[1], plan.seed)).astype(np.float32)
        factor = own["factor"].to_numpy()
        return turned, directions(codes), factor, least_estimate(factor, turned.shape[1], plan.least, plan.sigmas)

    def compare(own: pd.DataFrame, key: int, out: list[pd.DataFrame]) -> None:
        """Block against block."""
        side, label = own["side"].to_numpy(), own["label"].to_numpy()
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        turned, signs, factor, bound = parts(own)
        estimate = turned[left] @ signs[right].T / factor[right]
        i, j = np.nonzero((estimate >= bound[right]) & (label[left][:, None] != label[right]))
        i, j = left[i], right[j]
        # Both in one block: each pair once.
        once = (side[i] != 2) | (side[j] != 2) | (i < j)
        i, j = confirmed(own, i[once], j[once], np.full(int(once.sum()), key), out)
        adjacent = np.zeros((len(own), len(own)), bool)
        adjacent[i, j] = adjacent[j, i] = True
        edges = spanning(adjacent)
        linked(own, edges[:, 0], edges[:, 1], out)

    def side_by_side(own: pd.DataFrame, out: list[pd.DataFrame]) -> None:
        """Many small buckets, whole: each row with those after it in its bucket."""
        own = own.sort_values("key", kind="stable", ignore_index=True)
        key, label = own["key"].to_numpy(), own["label"].to_numpy()
        turned, signs, factor, bound = parts(own)
        pairs = [np.zeros((2, 0), np.int64)]
        for step in range(1, min(SMALL, len(own))):
            i = np.flatnonzero((key[step:] == key[:-step]) & (label[step:] != label[:-step]))
            j = i + step
            estimate = (turned[i] * signs[j]).sum(axis=1) / factor[j]
            near = estimate >= bound[j]
            pairs.append(np.stack([i[near], j[near]]))
        i, j = np.concatenate(pairs, axis=1)
        # A bucket has few links at most.
        linked(own, *confirmed(own, i, j, key[i], out), out)

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"a": [], "b": [], "n": []})]
        dims = frame["vector"].map(len)
        for _, same in frame.groupby(dims):
            whole = same["kind"] == 2
            if whole.any():
                side_by_side(same[whole], out)
            for (key, _, _, _), own in same[~whole].groupby(["key", "kind", "i", "j"], sort=False):
                compare(own, key, out)
        return pd.concat(out).astype(np.int64)

    return work


def _blocks(open_: DataFrame, nodes: DataFrame, rows: int, plan: Plan) -> DataFrame:
    """(a, b, n): for -1 as b, how many vectors a is linked with between different labels within
    the buckets; else a link.

    Small buckets are compared whole. In others members with the bucket's most common label are
    compared with the others, and the others with each other, a block against a block."""
    sizes = open_.groupBy("key", "label").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("key").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"))
    parts = lambda n: F.ceil(n / F.lit(plan.block)).cast("int")
    members = open_.join(sizes, "key").select(
        "key", "node", "label", "n", (F.col("label") == F.col("main.label")).alias("is_main"),
        parts(F.col("main.n")).alias("n_main"), parts(F.col("n") - F.col("main.n")).alias("n_rest"))
    small = members.filter(F.col("n") <= SMALL).select(
        "key", "node", "label", *(F.lit(k).alias(c) for c, k in (("kind", 2), ("i", 0), ("j", 0), ("side", 2))))
    members = members.filter(F.col("n") > SMALL).withColumn("own", F.expr(
        "cast(pmod(xxhash64(node), if(is_main, n_main, n_rest)) as int)"))
    meets = F.expr("""
        if(is_main,
           transform(sequence(0, n_rest - 1), i -> struct(0 as kind, i as i, own as j, 1 as side)),
           concat(transform(sequence(0, n_main - 1), j -> struct(0 as kind, own as i, j as j, 0 as side)),
                  transform(sequence(0, n_rest - 1), j -> struct(1 as kind, least(own, j) as i,
                      greatest(own, j) as j, if(own = j, 2, if(own < j, 0, 1)) as side))))""")
    placed = members.select("key", "node", "label", F.explode(meets).alias("at")).select(
        "key", "node", "label", "at.*").unionByName(small)
    placed = placed.withColumn("pack", F.when(
        F.col("kind") == 2, F.pmod(F.xxhash64("key"), F.lit(max(1, rows // PACK)))).otherwise(
        F.xxhash64("key", "kind", "i", "j")))
    placed = placed.join(nodes.select("node", "weight", "vector", "code", "factor", "keys"), "node")
    return placed.groupBy("pack").applyInPandas(_comparing(plan), "a long, b long, n long")


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding",
                 plan: Plan = Plan()) -> DataFrame:
    """(id, n_links, component_id, kept) of each row, the id under its own name."""
    rows = clean_table(vectors, id=id_column, vector=column)
    if rows.schema["vector"].dataType.elementType.typeName() != "float":
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    takes_part = F.expr("""id is not null and vector is not null and size(vector) > 0
        and not exists(vector, x -> x is null or isnan(x) or abs(x) = double('inf'))
        and exists(vector, x -> x <> 0)""")
    # Adding 0.0 turns -0.0 into 0.0, so equal vectors have equal keys.
    same = F.transform("vector", lambda x: x + F.lit(0.0))
    rows = rows.select("id", F.when(takes_part, F.xxhash64(same)).alias("key_a"),
                       F.when(takes_part, F.xxhash64(F.lit(1), same)).alias("key_b"), "vector")
    valid = rows.filter("key_a is not null")
    groups = valid.select("key_a", "key_b", "id").distinct().groupBy("key_a", "key_b").agg(
        F.min("id").alias("id"), F.count("*").alias("weight"))
    groups = written_table(groups.select(F.monotonically_increasing_id().alias("node"), "*"), "groups")
    count = groups.count()
    kind = rows.schema["vector"].dataType.simpleString()
    first_rows = valid.join(groups, ["key_a", "key_b", "id"]).select("node", "weight", "vector")
    nodes = written_table(map_batches(
        first_rows.dropDuplicates(["node"]), _coding(plan, count),
        f"node long, weight long, vector {kind}, code binary, factor double, keys array<long>"), "nodes")

    members = nodes.select("node", F.explode("keys").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("hub")).filter("n > 1")
    buckets = written_table(members.join(shared, "key"), "buckets")

    def side(name: str, *columns: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns))

    pairs = buckets.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    maybe = written_table(map_batches(
        pairs.join(side("b", "code", "factor"), "b").join(side("a", "vector"), "a"),
        _estimating(plan), "a long, b long"), "maybe")
    with_hubs = written_table(map_batches(
        maybe.join(side("a", "vector", "keys"), "a").join(side("b", "vector", "keys"), "b"),
        _confirming(plan), "a long, b long, close boolean, first long"), "with-hubs")

    # A ball's centre is a hub without a smaller hub of its own, as hubs are the smaller ones.
    close = with_hubs.filter("close").select("a", "b")
    balls = written_table(
        close.join(close.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        .groupBy(F.col("b").alias("node")).agg(F.min("a").alias("ball")), "balls")
    weights = nodes.select("node", "weight")
    inside = balls.union(balls.select(F.col("ball").alias("node"), "ball").distinct()).join(weights, "node")
    within = inside.join(inside.groupBy("ball").agg(F.sum("weight").alias("all")), "ball").select(
        "node", (F.col("all") - F.col("weight")).alias("n"))

    def labelled(table: DataFrame, node: str, label: str) -> DataFrame:
        own = balls.select(F.col("node").alias(node), F.col("ball").alias(label))
        return table.join(own, node, "left").withColumn(label, F.coalesce(label, node))

    # Pairs whose first bucket is theirs alone were compared there.
    alone = buckets.filter("n = 2 and node = hub").select(F.col("key").alias("first"))
    apart = with_hubs.join(alone, "first", "left_semi").select("a", "b")
    apart = labelled(labelled(apart, "a", "x"), "b", "y").filter("x <> y").select("a", "b")
    apart = apart.select("a", "b").union(apart.select("b", "a"))
    from_hubs = apart.join(weights.withColumnRenamed("node", "b"), "b").select(
        F.col("a").alias("node"), F.col("weight").alias("n"))

    larger = labelled(buckets.filter("n > 2").select("key", "node"), "node", "label")
    several = larger.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")) \
        .filter("x <> y").select("key")
    open_ = written_table(larger.join(several, "key"), "open")
    blocks = written_table(_blocks(open_, nodes, open_.count(), plan), "blocks")

    links = with_hubs.select("a", "b").union(blocks.filter("b >= 0").select("a", "b"))
    linked = within.union(from_hubs).union(blocks.filter("b < 0").select(F.col("a").alias("node"), "n")) \
        .groupBy("node").agg(F.sum("n").alias("n"))
    reach = written_table(components(links), "reach")
    named = groups.join(reach.withColumnRenamed("id", "node"), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    info = named.join(smallest, "component").join(linked, "node", "left").select(
        "key_a", "key_b", "component_id", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    result = rows.select("id", "key_a", "key_b").join(info, ["key_a", "key_b"], "left")
    return result.select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.expr("id <=> coalesce(component_id, id) and id is not null").alias("kept"))
