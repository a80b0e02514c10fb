"""Stream dedup whose state forgets: a key is known for a time to live after its last copy."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructType,
)

from txscore.constants import KEY
from txscore.functions import parse_ts

#: Groups that keys are dealt to by hash; the state of a group is one value.
GROUPS = 4096
#: Types that JSON gives back as they were, nulls and NaN included.
AS_JSON = (BooleanType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType)


def _processor(live: timedelta, key_type: DataType) -> StatefulProcessor:
    """Marks repeats. A class of its own per call, so that it goes to the executors as it is."""
    reach = live // timedelta(milliseconds=1)
    schema = StructType().add("keys", ArrayType(key_type)).add("at", ArrayType(LongType()))

    class LastSeen(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", schema)

        def known(self) -> dict:
            """When each known key of the group was last seen."""
            found = self.last.get()
            return dict(zip(*found)) if found else {}

        def keep(self, last: dict, due: int | None) -> None:
            """Store what is known, and the one timer of the group: for the key that goes first."""
            if last:
                self.last.update((list(last), list(last.values())))
            else:
                self.last.clear()
            first = min(last.values()) + reach if last else None
            if first != due:
                if due is not None:
                    self.handle.deleteTimer(due)
                if first is not None:
                    self.handle.registerTimer(first)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            last = self.known()
            due = min(last.values()) + reach if last else None
            changed = False
            # A group's rows of one batch; one without a time counts as a copy of what is known.
            for row in sorted(rows, key=lambda r: (r["_seen_ms"] is None, r["_seen_ms"])):
                at, before = row["_seen_ms"], last.get(row["_key"])
                repeat = before is not None and (at is None or abs(at - before) <= reach)
                if not repeat and at is not None:
                    last[row["_key"]], changed = at, True
                yield Row(_text=row["_text"], _rest=row["_rest"], _repeat=repeat)
            if changed:
                self.keep(last, due)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            # The timer that has come is gone already.
            now = timerValues.getCurrentWatermarkInMs()
            self.keep({k: at for k, at in self.known().items() if at + reach > now}, None)
            return iter(())

        def close(self) -> None:
            pass

    return LastSeen()


def dedup_for(df: DataFrame, live: timedelta, key: str = KEY, groups: int = GROUPS) -> DataFrame:
    """One row per key among copies at most `live` apart in event time; a later copy comes through
    again. Dropped repeats are counted in the query progress as `repeats`.

    A key's state goes once the stream's event time, less `live` for what comes late, has passed its
    time to live; so the state is bounded by the keys of twice that time. A row that comes later
    than that may be dropped, as by any watermark. Needs state in RocksDB.

    Keys are dealt by hash to `groups`, as a call to the state costs far more than a row: a batch
    reads and stores a group's state once, and a group has one timer. A group's rows of one batch
    and its known keys meet in one task. The number of groups is part of the checkpoint, as that of
    state partitions is: choose it for the final size.
    """
    seen = parse_ts(F.col("trans_date_trans_time"))
    # Python handles a row cell by cell, so a row goes there and back as one text, and only columns
    # that a text would change as they are.
    text = StructType([field for field in df.schema if isinstance(field.dataType, AS_JSON)])
    rest = [name for name in df.columns if name not in text.names]
    dealt = df.select(
        F.pmod(F.xxhash64(key), F.lit(groups)).cast("int").alias("_group"), F.col(key).alias("_key"),
        seen.alias("_seen_at"), F.unix_millis(seen).alias("_seen_ms"),
        F.to_json(F.struct(*text.names)).alias("_text"), (F.struct(*rest) if rest else F.lit(None).cast("int")).alias("_rest"),
    ).withWatermark("_seen_at", f"{int(live.total_seconds())} seconds")
    schema = StructType([dealt.schema["_text"], dealt.schema["_rest"]]).add("_repeat", "boolean")
    marked = dealt.groupBy("_group").transformWithState(
        statefulProcessor=_processor(live, df.schema[key].dataType), outputStructType=schema,
        outputMode="Append", timeMode="EventTime")
    counted = marked.observe("repeats", F.count_if("_repeat").alias("rows"))
    read = F.from_json("_text", text, {"mode": "FAILFAST"}).alias("_text")
    return counted.filter(~F.col("_repeat")).select(read, "_rest").select(
        *(F.col("_rest" if name in rest else "_text")[name].alias(name) for name in df.columns))
