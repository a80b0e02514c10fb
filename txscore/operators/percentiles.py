"""Exact percentiles without gathering a column in one place.

Spark's exact `percentile` builds a map of all distinct values of a group in one task, and
`percentile_approx` sends one summary per task to one task. Here mergeable sketches meet in a tree:
per task, then by a salt, then per group, so no step takes a sketch from every task. The quantiles
of a sketch bracket each order statistic that is wanted. A pass over the values counts what lies
below, on and between the ends of the bracket, and sketches what lies between, so the next bracket
is narrower; where the bracket missed, the counts say on which side to go on. When few values are
left they are counted one by one. The result is exact, linear between neighbours.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Accuracy of a sketch, and the share of ranks by which brackets reach out on both sides: about
#: twice the sketch's error.
SKETCH_K, MARGIN = 4096, 0.003
#: Values of a bracket up to which they are counted one by one, in one task per order statistic.
FEW = 100_000
#: Sketches of tasks meet in so many groups first, and these in so many.
SALTS = (4096, 64)


def long_values(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Rows (name, value) for the named expressions, missing values left out."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("name"), expr.cast("double").alias("value"))
        for name, expr in columns.items()
    ])
    return df.select(F.inline(pairs)).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def in_a_tree(rows: DataFrame, first: Sequence[Column], merge: Sequence[Column]) -> DataFrame:
    """Aggregates per name: `first` within groups of tasks, then `merge` twice.

    The last step takes as many rows per name as there are salts, whatever the number of tasks.
    """
    many, few = SALTS
    level = rows.groupBy("name", F.pmod(F.spark_partition_id(), F.lit(many)).alias("_salt")).agg(*first)
    level = level.groupBy("name", F.pmod("_salt", F.lit(few)).alias("_salt")).agg(*merge)
    return level.groupBy("name").agg(*merge)


@dataclass
class _Wanted:
    """An order statistic of a group: the open interval that holds it, how many values lie up to
    its lower end, how many inside, the bracket to try next, and the value once it is known."""

    name: str
    position: int
    low: float | None = None
    high: float | None = None
    before: int = 0
    inside: int = 0
    bracket: tuple[float, float] | None = None
    value: float | None = None

    def aim(self, quantiles: Sequence[float]) -> None:
        """Take the quantiles at both sides of the position as bracket."""
        self.bracket = (quantiles[0], quantiles[1])

    def shares(self) -> list[float]:
        """The ranks, as shares of what is inside, at both sides of the position."""
        share = (self.position - self.before + 0.5) / self.inside
        return [max(0.0, share - MARGIN), min(1.0, share + MARGIN)]

    def narrow(self, below: int, on_low: int, between: int, on_high: int) -> bool:
        """Go on with the part of the interval that holds the position, given how many values
        lie below, on and between the ends of the bracket. Whether that part was sketched."""
        a, b = self.bracket
        at = self.position - below
        self.bracket = None
        if at < 0:
            self.high, self.inside = a, below - self.before
        elif at < on_low:
            self.value = a
        elif at < on_low + between:
            self.low, self.high, self.before, self.inside = a, b, below + on_low, between
            return True
        elif at < on_low + between + on_high and b != a:
            self.value = b
        else:
            passed = below + on_low + between + (on_high if b != a else 0)
            self.low, self.inside, self.before = b, self.before + self.inside - passed, passed
        return False


def _inside(value: Column, wanted: _Wanted) -> Column:
    above = value > F.lit(wanted.low) if wanted.low is not None else F.lit(True)
    return above & (value < F.lit(wanted.high)) if wanted.high is not None else above


def _within(wanted: Sequence[_Wanted], value: Column, condition) -> Column:
    """A condition that each group's own statistic sets, as one column."""
    chosen = F.lit(None).cast("boolean")
    for w in wanted:
        chosen = F.when(F.col("name") == F.lit(w.name), condition(w, value)).otherwise(chosen)
    return chosen


def _sketch(value: Column) -> Column:
    return F.kll_sketch_agg_double(value, F.lit(SKETCH_K))


def _rounds(values: DataFrame, wanted: list[_Wanted]) -> None:
    """Narrow the intervals until few values are left in each."""
    value = F.col("value")
    while True:
        open_ = [w for w in wanted if w.value is None and w.inside > FEW]
        if not open_:
            return
        # One column of aggregates serves one statistic of every group.
        slots: list[list[_Wanted]] = []
        used: dict[str, int] = {}
        for w in open_:
            k = used[w.name] = used.get(w.name, -1) + 1
            if k == len(slots):
                slots.append([])
            slots[k].append(w)
        first, merge = [], []

        def both(name: str, start: Column, then) -> None:
            first.append(start.alias(name))
            merge.append(then(name).alias(name))

        for k, slot in enumerate(slots):
            aimed = [w for w in slot if w.bracket]
            parts = {
                "below": lambda w, v: v < F.lit(w.bracket[0]),
                "on_low": lambda w, v: v == F.lit(w.bracket[0]),
                "between": lambda w, v: (v > F.lit(w.bracket[0])) & (v < F.lit(w.bracket[1])),
                "on_high": lambda w, v: v == F.lit(w.bracket[1]),
            }
            for part, condition in parts.items():
                both(f"{part}_{k}", F.count_if(_within(aimed, value, condition)), F.sum)
            sketched = _within(slot, value, lambda w, v: (
                parts["between"](w, v) if w.bracket else _inside(v, w)))
            both(f"sketch_{k}", _sketch(F.when(sketched, value)), F.kll_merge_agg_double)
        found = in_a_tree(values.filter(F.col("name").isin(list(used))), first, merge)
        # The ranks depend on the counts, so a second look at the sketches follows on the driver's
        # word: one row per group, with a sketch for each open statistic.
        found = found.persist()
        try:
            rows = {r["name"]: r for r in found.drop(*[f"sketch_{k}" for k in range(len(slots))]).collect()}
            asked = []
            for k, slot in enumerate(slots):
                for w in slot:
                    row = rows[w.name]
                    if w.bracket and not w.narrow(*(row[f"{part}_{k}"] for part in (
                            "below", "on_low", "between", "on_high"))):
                        continue
                    if w.value is None and w.inside > FEW:
                        asked.append((k, w))
            if asked:
                looks = [F.when(F.col("name") == F.lit(w.name), F.kll_sketch_get_quantile_double(
                    F.col(f"sketch_{k}"), F.array(*map(F.lit, w.shares())))).alias(str(i))
                    for i, (k, w) in enumerate(asked)]
                answers = {r["name"]: r for r in found.select("name", *looks).collect()}
                for i, (_, w) in enumerate(asked):
                    w.aim(answers[w.name][str(i)])
        finally:
            found.unpersist()


def _last_few(values: DataFrame, wanted: list[_Wanted]) -> None:
    """Count what is left in each interval value by value, and take what stands at the position."""
    open_ = [w for w in wanted if w.value is None]
    if not open_:
        return
    value = F.col("value")
    intervals = F.lit(None).cast("array<int>")
    for name in dict.fromkeys(w.name for w in open_):
        intervals = F.when(F.col("name") == F.lit(name), F.filter(F.array(*[
            F.when(_inside(value, w), F.lit(i)) for i, w in enumerate(open_) if w.name == name
        ]), lambda i: i.isNotNull())).otherwise(intervals)
    counted = values.select("value", F.explode(intervals).alias("i")).groupBy("i", "value").agg(
        F.count("*").alias("n"))
    # At most `FEW` rows of a statistic meet.
    ordered = counted.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("value", "n"))).alias("runs"))
    position = F.lit(None).cast("bigint")
    for i, w in enumerate(open_):
        position = F.when(F.col("i") == i, F.lit(w.position - w.before).cast("bigint")).otherwise(position)
    reached = F.aggregate(
        "runs", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("double").alias("value")),
        lambda done, run: F.struct(
            (done["n"] + run["n"]).alias("n"),
            F.when((done["n"] <= position) & (position < done["n"] + run["n"]), run["value"])
            .otherwise(done["value"]).alias("value")),
        lambda done: done["value"])
    for row in ordered.select("i", reached.alias("value")).collect():
        open_[row["i"]].value = row["value"]


def percentiles(
    df: DataFrame, columns: Mapping[str, Column], probabilities: Sequence[float],
) -> DataFrame:
    """Rows (name, probability, percentile), one per named expression and probability."""
    return grouped_percentiles(long_values(df, columns), probabilities)


def sizes_of(values: DataFrame) -> dict[str, int]:
    """How many values each name has."""
    return {r["name"]: r["n"] for r in in_a_tree(
        values, [F.count("*").alias("n")], [F.sum("n").alias("n")]).collect()}


def grouped_percentiles(
    values: DataFrame, probabilities: Sequence[float], sizes: Mapping[str, int] | None = None,
) -> DataFrame:
    """The same for rows (name, value) without missing values, one per input row.

    Runs the passes at once: the driver holds one small record per name and probability, so names
    are the caller's columns or a few groups. `sizes` saves the first pass where they are known.
    """
    sizes = dict(sizes if sizes is not None else sizes_of(values))
    wanted = {(name, k): _Wanted(name, k, inside=n) for name, n in sizes.items() if n
              for p in probabilities for k in (math.floor((n - 1) * p), math.ceil((n - 1) * p))}
    _rounds(values, list(wanted.values()))
    _last_few(values, list(wanted.values()))
    rows = []
    for name, n in sizes.items():
        for p in probabilities if n else ():
            rank = (n - 1) * p
            left, right = wanted[name, math.floor(rank)].value, wanted[name, math.ceil(rank)].value
            rows.append((name, float(p), left if left == right else left + (right - left) * (rank - math.floor(rank))))
    return values.sparkSession.createDataFrame(rows, "name STRING, probability DOUBLE, percentile DOUBLE")


def percentile(df: DataFrame, column: str, probability: float) -> DataFrame:
    """One row, one value; use `.scalar()` to put it into another plan."""
    return percentiles(df, {column: F.col(column)}, [probability]).select("percentile")


def percentile_trim(df: DataFrame, column: str, probability: float = 0.99) -> DataFrame:
    """Keep the rows up to the percentile."""
    return df.filter(F.col(column) <= percentile(df, column, probability).scalar())
