"""Connected components of a link table, with every step a join on plain ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.llm.tasks import written_table

#: Rounds after which the loop gives up; every round at least halves the longest chain of labels.
MOST_ROUNDS = 60


def components(links: DataFrame, at_most: int | None = None) -> DataFrame:
    """(id, component) of every id in `links` (a, b): the smallest id it is connected to.

    Large-star and small-star steps: each id's larger, then its smaller neighbours are linked to
    the smallest one, until the links are stars. Aggregates are partial, and adaptive execution
    splits a hub's links in the joins. Each round is one job and is written to the shared
    folder, so a lost executor costs one round at most. `at_most` says how many links there
    can be, if that is known.
    """
    edges = written_table(_directed(links.select("a", "b")).distinct(), "links", at_most)
    mark = _mark(edges)
    for _ in range(MOST_ROUNDS):
        if not mark[0]:
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("m"))
        large = (both.filter("b > a").join(least, F.col("a") == F.col("x"))
                 .select(F.col("b").alias("a"), F.least("m", "x").alias("b")))
        large = _directed(large).distinct()
        least = large.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("x")).select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("x").alias("a"), F.col("m").alias("b")))).alias("e"))
        # A round makes two links of one at most.
        edges = written_table(_directed(small.select("e.*")).distinct(), "links", 2 * mark[0])
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def join_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels with more links: what they join is found among components, not among ids."""
    def named(column: str) -> DataFrame:
        return labels.select(F.col("id").alias(column), F.col("component").alias(f"of_{column}"))

    between = links.join(named("a"), "a", "left").join(named("b"), "b", "left").select(
        F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    more = components(between, links.count())
    more = more.select(F.col("id").alias("component"), F.col("component").alias("root"))
    known = labels.join(more, "component", "left").select(
        "id", F.coalesce("root", "component").alias("component"))
    new = more.join(labels.select(F.col("id").alias("component")), "component", "left_anti").select(
        F.col("component").alias("id"), F.col("root").alias("component"))
    return known.union(new)


def _directed(edges: DataFrame) -> DataFrame:
    """Links from the larger to the smaller id."""
    return (edges.filter("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))


def _mark(edges: DataFrame) -> tuple[int, int | None]:
    """How many links there are, and a sum over them that tells one set from another."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]
