"""Sessions by an inactivity gap.

A new session opens for a user's first event and after every gap of more than
``gap_seconds`` whole seconds. Session ids are ``<user>_<running number>``. An event without
a time is a session of its own; those come first, ordered by their columns, nulls first.

A distributed prefix scan. Events are shuffled once, into ranges of (user, time), whose ends
may cut any user, second or group of equal rows. Each range is reduced, in any order of its
rows, to one row about its last user, the only one that can go on in the next range. Running
totals over these rows, one per range, say how many sessions a range starts from; then each
range is sorted and numbered in one pass. Both passes read the same shuffle. The columns that
they need, and no others, go through Arrow to numpy.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickline.functions.columns import whole_seconds

# Both passes run in Python workers, which need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_GAP_SECONDS = 1800

#: Distinct seconds of a range's last user that are held before they are folded into sessions.
_HELD_SECONDS = 1_000_000


def sessionize(
    events: DataFrame,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    user: str = "user_id",
    time: str = "timestamp",
) -> DataFrame:
    """``events`` plus ``session_id``.

    All columns of ``events`` travel through the shuffle, so pick those that are needed first.
    Columns of a type without an order (maps) do not help to order events without a time.
    """
    partitions = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    others = [F.col(c) for c in _orderable(events) if c not in (user, time)]
    # Any order of the users will do; that of their hashes is the quickest to sort by.
    order = [F.col("_key"), F.col(user).asc_nulls_first(), F.col(time).asc_nulls_first()]
    if others:
        order.append(F.when(F.col(time).isNull(), F.struct(*others)).asc_nulls_first())
    # Equal places are told apart by the task that read them, which stays the same when a task is run again.
    ranges = (
        events.withColumns({"_key": F.xxhash64(user), "_reader": F.spark_partition_id()})
        .repartitionByRange(partitions, *order, "_reader")
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_seconds", whole_seconds(time))
        .withColumn("_check", _check(events))
    )
    starts = _starts(ranges.select("_range", "_key", F.col(user).alias("_user"), "_seconds", "_check"), gap_seconds)
    goes_on = F.col(user).eqNullSafe(F.col("_last_user"))
    number = _numbering(gap_seconds)(
        user,
        "_seconds",
        F.when(goes_on, F.col("_opened")),
        F.when(goes_on, F.col("_last_second")),
        "_check",
        "_range_check",
    )
    return (
        # One row per range.
        ranges.join(F.broadcast(starts), "_range")
        .sortWithinPartitions(*order)
        .withColumn("_number", number)
        .select(*events.columns, F.concat_ws("_", F.col(user), F.col("_number")).alias("session_id"))
    )


def _orderable(events: DataFrame) -> list[str]:
    def has_order(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(has_order(f.dataType) for f in kind.fields)
        return has_order(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))

    return [f.name for f in events.schema.fields if has_order(f.dataType)]


def _check(events: DataFrame) -> Column:
    """A hash of a row, by which the second pass makes sure that it reads the ranges of the first. Since it takes all
    columns, none is pruned on one side only, and both passes share one shuffle."""
    ordered = set(_orderable(events))
    return F.xxhash64(*[F.col(c) if c in ordered else F.to_json(F.struct(c)) for c in events.columns])


def _starts(ranges: DataFrame, gap_seconds: int) -> DataFrame:
    """One row per range that holds rows: its check, and the last user of the range before with the number of
    sessions that this user has opened so far and its last second."""
    kind = ranges.schema["_user"].dataType
    schema = T.StructType(
        [T.StructField("_range", T.IntegerType()), T.StructField("_user", kind)]
        + [T.StructField(name, T.LongType()) for name in ("_range_check", "_sessions", "_first", "_last")]
    )
    ends = ranges.mapInArrow(_last_users(gap_seconds, [f.name for f in schema.fields]), schema)
    of_user = Window.partitionBy("_user").orderBy("_range")
    joined = F.coalesce(F.col("_first") - F.lag("_last").over(of_user) <= gap_seconds, F.lit(False))
    upto = F.sum(F.col("_sessions") - F.col("_joined").cast("long")).over(
        of_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = Window.orderBy("_range")
    return (
        ends.withColumn("_joined", joined)
        .withColumn("_upto", upto)
        .select(
            "_range",
            "_range_check",
            F.lag("_user").over(before).alias("_last_user"),
            F.lag("_upto").over(before).alias("_opened"),
            F.lag("_last").over(before).alias("_last_second"),
        )
    )


def _plain(numbers: pa.Array) -> np.ndarray:
    return numbers.to_numpy(zero_copy_only=False)


def _sessions(first: np.ndarray, last: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Intervals, joined where they lie at most ``gap`` apart."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    opens = np.flatnonzero(np.concatenate(([True], first[1:] - last[:-1] > gap)))
    return first[opens], last[np.append(opens[1:] - 1, len(last) - 1)]


def _last_users(gap: int, columns: list[str]):
    """Reduces a range, in any order of its rows, to the sessions of its last user."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, check, last, kind = None, 0, None, None
        untimed, held = 0, 0
        firsts: list[np.ndarray] = []
        lasts: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            number, kind = batch.column("_range")[0].as_py(), batch.schema.field("_user").type
            check ^= int(np.bitwise_xor.reduce(_plain(batch.column("_check"))))
            keys = _plain(batch.column("_key"))
            key = int(keys.max())
            if last is not None and key < last[0]:
                continue
            mine = pa.array(np.flatnonzero(keys == key))
            users, seconds = batch.column("_user").take(mine), batch.column("_seconds").take(mine)
            # Users that share a hash stand in their own order, null first.
            user = pc.max(users)
            place = (key, user.is_valid, user.as_py() if user.is_valid else 0)
            if last is None or place > last:
                last, untimed, held, firsts, lasts = place, 0, 0, [], []
            own = pc.equal(users, pa.scalar(last[2], kind)) if last[1] else users.is_null()
            seconds = seconds.filter(pc.fill_null(own, False))
            untimed += seconds.null_count
            timed = np.unique(_plain(seconds.drop_null()))
            firsts.append(timed)
            lasts.append(timed)
            held += len(timed)
            if held > _HELD_SECONDS:
                merged = _sessions(np.concatenate(firsts), np.concatenate(lasts), gap)
                firsts, lasts, held = [merged[0]], [merged[1]], 0
        if last is None:
            return
        first, end = np.concatenate(firsts), np.concatenate(lasts)
        opened, bounds = untimed, (None, None)
        if len(first):
            first, end = _sessions(first, end, gap)
            opened, bounds = untimed + len(first), (int(first[0]), int(end[-1]))
        user = pa.array([last[2] if last[1] else None], kind)
        longs = [pa.array([value], pa.int64()) for value in (check, opened, *bounds)]
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), user, *longs], columns)

    return reduce


def _numbering(gap: int):
    """Numbers the sessions of a sorted range, beginning with what the ranges before have opened."""

    @F.arrow_udf("long")
    def number(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        check, expected = 0, None
        last_user, last_second, opened = None, None, 0  # of the row before
        for users, seconds, opened_before, second_before, checks, range_check in columns:
            size = len(users)
            if not size:
                yield pa.array([], pa.int64())
                continue
            check ^= int(np.bitwise_xor.reduce(_plain(checks)))
            timed, at = _plain(seconds.is_valid()), _plain(pc.fill_null(seconds, 0))
            changes = np.empty(size, bool)
            if size > 1:
                same = pc.fill_null(pc.equal(users[1:], users[:-1]), False)
                if users.null_count:
                    same = pc.or_(same, pc.and_(users[1:].is_null(), users[:-1].is_null()))
                changes[1:] = ~_plain(same)
            if expected is None:
                # The first row goes on from the ranges before, or nothing does.
                opened, last_second = opened_before[0].as_py() or 0, second_before[0].as_py()
                changes[0], expected = False, range_check[0].as_py()
            elif users[0].as_py() != last_user:
                changes[0], opened = True, 0
            else:
                changes[0] = False
            before = np.concatenate(([last_second or 0], at[:-1]))
            timed_before = np.concatenate(([last_second is not None], timed[:-1]))
            so_far = np.cumsum(changes | ~timed | ~timed_before | (at - before > gap))
            # What was opened before a user's first row in this batch does not count for that user.
            start = np.maximum.accumulate(np.where(changes, np.arange(size), 0))
            numbers = np.where(start > 0, so_far - so_far[start] + 1, so_far + opened)
            yield pa.array(numbers, pa.int64())
            last_user, last_second, opened = users[-1].as_py(), seconds[-1].as_py(), int(numbers[-1])
        if expected is not None and check != expected:
            raise RuntimeError("the two passes over a range read different rows: leave spark.sql.exchange.reuse on")

    return number.asNondeterministic()
