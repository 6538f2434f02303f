"""Keyed results and alerts on live streams, with state and timers in Spark's state store.

Rows count in the order they arrive: micro-batch by micro-batch, and inside a micro-batch by the
order column. The rows of a key in a micro-batch are sorted in one task, so the size of a micro-batch
bounds what a hot key asks of one (``ordered.BATCH_ROWS`` in the registered queries). A stream may go on
where a batch query over history ended: ``initial`` holds a row per key, as the functions
``counts_so_far`` and ``last_values`` give them, and is read once, with the first micro-batch. The
session needs the RocksDB state store (``session.rocksdb``).
"""

from __future__ import annotations

from bisect import insort
from collections import deque
from collections.abc import Iterator, Sequence
from datetime import timedelta
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from tidemark.functions.messages import jump_message, rise_message
from tidemark.functions.timing import epoch_millis, millis
from tidemark.operators.keyed import count_changes
from tidemark.operators.lateness import WATERMARK, with_windows
from tidemark.operators.windows import END, START
from tidemark.schemas import struct
from tidemark.sources.readers import event_table
from tidemark.streaming.stamped import CLOCK

#: Entries of the state store that the keys of a rise share.
SLOTS = 256


class _Keyed(StatefulProcessor):
    """Base: one remembered row per key, of the columns ``memory``."""

    memory = "n long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.memory)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """Take what an earlier job knew of a key, in the columns of ``memory``."""
        self.last.update(tuple(initialState[part.split()[0]] for part in self.memory.split(",")))

    def remembered(self, default: tuple) -> tuple:
        held = self.last.get()
        return default if held is None else tuple(held)

    def close(self) -> None:
        pass


class RunningCount(_Keyed):
    """The order values of a key's new rows, sorted and in chunks, and the count before each chunk.

    Spark holds what a key gives in a micro-batch as one dictionary per row. So a chunk is one row, of
    which ``live_running_count`` makes the rows again outside Python, and of the input only the order
    values are held.
    """

    chunk = 10_000

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (n,) = self.remembered((0,))
        seqs = sorted(row.seq for row in rows)
        for at in range(0, len(seqs), self.chunk):
            yield Row(k=key[0], before=n + at, seqs=seqs[at : at + self.chunk])
        self.last.update((n + len(seqs),))


class Jumps(_Keyed):
    """Rows that differ from the key's row before by more than a threshold."""

    memory = "v double"

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (before,) = self.remembered((None,))
        for row in sorted(rows, key=lambda r: r.seq):
            if before is not None and row.v is not None and abs(row.v - before) > self.threshold:
                yield Row(k=key[0], seq=row.seq, ts_ms=row.ts_ms, previous=before, v=row.v)
            before = row.v
        self.last.update((before,))


class CountWindow(_Keyed):
    """Sum of the last ``size`` rows, at every ``slide``-th row of the key."""

    def __init__(self, size: int, slide: int) -> None:
        self.size, self.slide = size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.tail = handle.getListState("tail", "v double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (n,) = self.remembered((0,))
        held = deque((v for (v,) in self.tail.get()), maxlen=self.size)
        for row in sorted(rows, key=lambda r: r.seq):
            n += 1
            held.append(row.v)
            if n % self.slide == 0:
                yield Row(k=key[0], fired_at=n, total=sum(held))
        self.last.update((n,))
        self.tail.put([(v,) for v in held])


class SustainedRise(StatefulProcessor):
    """Alert a span after a row if its run of rises still lasts and is long enough.

    The keys of a slot share an entry of the state store, and their rows come in few frames (``_framed``): a call
    to the store, or a row's way to Python, takes longer than the few rows that a key has in a micro-batch.

    Spark fires timers after the rows of a micro-batch, so the deadlines that are due between
    two rows of the batch are settled here first; a timer serves those that are left, also of keys
    that fell silent. Only a run that is long enough needs one, as others give no alert before the key's next
    row. Every row counts in the order of arrival; one whose time lies behind the clock has a
    deadline like others, which may be due at once.
    """

    def __init__(self, wait_ms: int, min_rises: int) -> None:
        self.wait_ms, self.min_rises = wait_ms, min_rises

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("runs", "runs binary")

    def _held(self) -> pa.RecordBatch | None:
        held = self.held.get()
        return None if held is None else _from_bytes(held[0])

    def _save(self, others: pa.RecordBatch | None, runs: dict, kind: pa.DataType) -> None:
        """Runs as the rows of a table, after those of other keys; a timer for the first deadline of long ones."""
        values, starts, rises, waiting = zip(*runs.values())
        due, seqs = zip(*[d for w in waiting for d in w]) if any(waiting) else ((), ())
        deadlines = pa.StructArray.from_arrays([pa.array(due, pa.int64()), pa.array(seqs, pa.int64())], ["due_ms", "seq"])
        ends = pa.array([0, *accumulate(map(len, waiting))], pa.int32())
        mine = pa.record_batch({
            "k": pa.array(list(runs), kind), "v": pa.array(values, pa.float64()), "start_ms": pa.array(starts, pa.int64()),
            "rises": pa.array(rises, pa.int64()), "waiting": pa.ListArray.from_arrays(ends, deadlines)})
        self.held.update((_to_bytes(mine if others is None else pa.concat_batches([others, mine])),))
        needed = [w[0][0] for n, w in zip(rises, waiting) if w and n >= self.min_rises]
        if needed:
            self.handle.registerTimer(min(needed))

    def _due(self, key, run: list, before: int) -> list[Row]:
        """Take the deadlines earlier than a time; alerts if the run is long enough."""
        taken, (_, start, rises, waiting) = [], run
        while waiting and waiting[0][0] < before:
            taken.append(waiting.popleft())
        if rises < self.min_rises:
            return []
        return [Row(k=key, seq=seq, timer_ms=due, run_start_ms=start, rises=rises) for due, seq in taken]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived = pa.Table.from_batches(_from_bytes(row.frame) for row in rows)
        arrived = arrived.filter(pc.is_valid(arrived.column("seq")))  # one without only moves the clock
        if not arrived.num_rows:
            return
        held, keys, alerts = self._held(), arrived.column("k").unique(), []
        others, runs = (None, {}) if held is None else _parted(held, pc.is_in(held.column("k"), keys))
        for clock, seq, k, ts, v in _in_order(arrived):
            run = runs.get(k)
            if run is None:
                run = runs[k] = [v, ts, 0, deque()]
            else:
                if run[3] and run[3][0][0] < clock:
                    alerts += self._due(k, run, clock)
                if v > run[0]:
                    run[0], run[2] = v, run[2] + 1
                elif v < run[0]:
                    run[:] = v, ts, 0, deque()
            insort(run[3], (ts + self.wait_ms, seq))
        self._save(others, runs, keys.type)
        yield from alerts

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, until = self._held(), timerValues.getCurrentWatermarkInMs()
        others, long = _parted(held, pc.greater_equal(held.column("rises"), self.min_rises))
        alerts = [alert for k, run in long.items() for alert in self._due(k, run, until + 1)]
        if long:
            self._save(others, long, held.column("k").type)
        yield from alerts

    def close(self) -> None:
        pass


def _to_bytes(table: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_batch(table)
    return out.getvalue().to_pybytes()


def _from_bytes(held: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(held).read_next_batch()


def _values(column: pa.Array) -> list:
    plain = column.null_count == 0 and (pa.types.is_integer(column.type) or pa.types.is_floating(column.type))
    return column.to_numpy().tolist() if plain else column.to_pylist()


def _in_order(rows: pa.Table) -> Iterator[tuple]:
    """The rows as (clock, order, key, time, value), sorted."""
    clock, seqs, *others = (c.combine_chunks() for c in rows.columns)
    clock, seqs = clock.cast(pa.int64()).to_numpy() // 1000, seqs.to_numpy()
    order = np.lexsort((seqs, clock))
    return zip(clock[order].tolist(), seqs[order].tolist(), *(_values(c.take(pa.array(order))) for c in others))


def _parted(held: pa.RecordBatch, mine: pa.Array) -> tuple[pa.RecordBatch, dict]:
    """The runs of other keys as they are, and of each key that is ``mine`` the last value, the start of its run, the
    rises in it, and its deadlines in order."""
    table = held.filter(mine)
    values, starts, rises = (_values(table.column(c)) for c in ("v", "start_ms", "rises"))
    waiting = table.column("waiting")
    ends, deadlines = _values(waiting.offsets), list(zip(*map(_values, waiting.flatten().flatten())))
    runs = zip(values, starts, rises, (deque(deadlines[i:j]) for i, j in zip(ends, ends[1:])))
    return held.filter(pc.invert(mine)), dict(zip(_values(table.column("k")), map(list, runs)))


def _framed(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows of a slot as frames, of as many rows as Arrow takes at a time, with the last clock in a frame.

    The clock's field keeps the mark of an event time, by which Spark drops a frame that is late.
    """
    schema = StructType([StructField("slot", IntegerType()), rows.schema["clock"], StructField("frame", BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot, clock, *_ = batch.columns
            frame = pa.array([_to_bytes(batch.select(batch.schema.names[1:]))], pa.binary())
            yield pa.record_batch([slot[:1], pa.array([pc.max(clock)], clock.type), frame], schema.names)

    return rows.groupBy(*by).applyInArrow(pack, schema)


class WindowFirings(StatefulProcessor):
    """Every result of a window: one over its on-time rows, then one for each row that fires it again.

    The first is given at the window's end, by a timer or before the first later row; the window is
    forgotten when the allowed lateness is over. The state is the best row so far.
    """

    def __init__(self, lateness_ms: int, sign: int, kept: Sequence[str], columns: str) -> None:
        self.lateness_ms, self.sign, self.kept, self.columns = lateness_ms, sign, list(kept), columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", f"firings long, best boolean, v double, o1 long, o2 long, {self.columns}")

    def _remembered(self) -> tuple[int, tuple | None]:
        if not self.state.exists():
            return 0, None
        firings, best, *rest = self.state.get()
        return firings, tuple(rest) if best else None

    def _save(self, firings: int, best: tuple | None) -> None:
        self.state.update((firings, best is not None, *(best or [None] * (3 + len(self.kept)))))

    def _rank(self, best: tuple) -> tuple:
        v = best[0]
        return (v is not None, (v or 0) * self.sign, best[1], best[2])

    def _result(self, key, firings: int, best: tuple) -> Row:
        return Row(k=key[0], end_ms=key[1], firing_no=firings, **dict(zip(self.kept, best[3:])))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[1] is None:
            return
        (firings, best), last = self._remembered(), key[1] - 1
        for row in sorted(rows, key=lambda r: (r.o1, r.o2)):
            if last + self.lateness_ms <= row.watermark_ms:
                continue
            again = last <= row.watermark_ms
            if again and firings == 0 and best:
                firings = 1
                yield self._result(key, firings, best)
            mine = (row.v, row.o1, row.o2, *(row[c] for c in self.kept))
            best = mine if best is None else min(best, mine, key=self._rank)
            if again:
                firings += 1
                yield self._result(key, firings, best)
        if best is None:
            return
        self._save(firings, best)
        if firings == 0:
            self.handle.registerTimer(last)
        self.handle.registerTimer(last + self.lateness_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        (firings, best), at = self._remembered(), expiredTimerInfo.getExpiryTimeInMs()
        if best and firings == 0:
            firings = 1
            self._save(firings, best)
            yield self._result(key, firings, best)
        if at >= key[1] - 1 + self.lateness_ms:
            self.state.clear()

    def close(self) -> None:
        pass


def _apply(
    stream: DataFrame, processor: StatefulProcessor, out: str, time_mode: str = "None", keys: Sequence[str] = ("k",),
    initial: DataFrame | None = None,
) -> DataFrame:
    return stream.groupBy(*keys).transformWithState(
        statefulProcessor=processor,
        outputStructType=struct(out),
        outputMode="Append",
        timeMode=time_mode,
        initialState=None if initial is None else initial.groupBy(*keys),
    )


def counts_so_far(history: DataFrame, key: str) -> DataFrame:
    """State of a count: what ``live_running_count`` and ``live_changelog`` go on from."""
    return history.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))


def last_values(history: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """State of a jump alert: the value of the last row of each key."""
    return history.groupBy(F.col(key).alias("k")).agg(F.max_by(F.col(value).cast("double"), order).alias("v"))


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def live_running_count(stream: DataFrame, key: str, order: str, initial: DataFrame | None = None) -> DataFrame:
    rows = stream.select(F.col(key).alias("k"), F.col(order).alias("seq"))
    out = _apply(rows, RunningCount(), f"k {_kind(rows, 'k')}, before long, seqs array<long>", initial=initial)
    out = out.select("k", "before", F.posexplode("seqs").alias("at", "seq"))
    return out.select(F.col("seq").alias(order), F.col("k").alias(key), (F.col("before") + F.col("at") + 1).alias("cnt"))


def live_changelog(stream: DataFrame, key: str, order: str, initial: DataFrame | None = None) -> DataFrame:
    """The withdrawn and the new count, for each row."""
    return count_changes(live_running_count(stream, key, order, initial), key, [order])


def live_count_window(
    stream: DataFrame, key: str, value: str, order: str, size: int, slide: int
) -> DataFrame:
    rows = stream.select(
        F.col(key).alias("k"), F.col(order).alias("seq"), F.col(value).cast("double").alias("v")
    )
    out = _apply(rows, CountWindow(size, slide), f"k {_kind(rows, 'k')}, fired_at long, total double")
    return out.withColumnRenamed("k", key)


def live_jump_alert(
    stream: DataFrame, key: str, value: str, ts: str, order: str, threshold: float, initial: DataFrame | None = None
) -> DataFrame:
    rows = stream.select(
        F.col(key).alias("k"), F.col(order).alias("seq"),
        epoch_millis(F.col(ts)).alias("ts_ms"), F.col(value).cast("double").alias("v"),
    )
    kind = _kind(rows, "k")
    out = _apply(
        rows, Jumps(threshold), f"k {kind}, seq long, ts_ms long, previous double, v double", initial=initial)
    message = jump_message(F.timestamp_millis("ts_ms"), F.col("k"), threshold)
    return out.select(
        F.col("seq").alias(order), message.alias("message"), "previous", F.col("v").alias("current")
    )


def live_sustained_rise(
    stream: DataFrame,
    key: str,
    value: str,
    ts: str,
    order: str,
    span: timedelta,
    min_rises: int = 5,
    clock: str | None = None,
    slots: int = SLOTS,
) -> DataFrame:
    """Alerts that are due by the clock, which is a marked event-time column that never runs back.

    ``stamped.clocked`` gives one, so that rows whose time lies behind others count too. Without it the time of
    the rows is the clock, and Spark drops rows behind it. A key goes to one of ``slots`` by its hash. All keys of
    a slot are read and written if one of them has rows, so there should be some thousands in a slot at most.
    """
    marked = stream if clock else event_table(stream, ts, timedelta(0))
    rows = marked.select(
        F.pmod(F.xxhash64(key), F.lit(slots)).cast("int").alias("slot"), F.col(clock or ts).alias("clock"),
        F.col(order).cast("long").alias("seq"), F.col(key).alias("k"), epoch_millis(F.col(ts)).alias("ts_ms"),
        F.col(value).cast("double").alias("v"),
    )
    out = _apply(
        _framed(rows, ["slot"] if clock else ["slot", "clock"]),  # rows that may be late are dropped each by its time
        SustainedRise(millis(span), min_rises),
        f"k {_kind(rows, 'k')}, seq long, timer_ms long, run_start_ms long, rises long",
        "EventTime",
        ("slot",),
    )
    message = rise_message(F.col("timer_ms"), F.col("run_start_ms"), F.col("k"), F.col("rises"))
    return out.withColumn("message", message).withColumnRenamed("k", key)


def live_window_firings(
    clocked: DataFrame,
    ts: str,
    key: str,
    value: str,
    arrival: Sequence[str],
    size: timedelta,
    lateness: timedelta,
    columns: Sequence[str],
    pick: str = "min",
    slide: timedelta | None = None,
) -> DataFrame:
    """Every result a window emits, live: at its end, and for each later row that it still takes.

    ``clocked`` are stamped rows with their clock (see ``stamped``); ``arrival`` are two whole numbers that
    order them. State is one row per key and open window.
    """
    if pick not in ("min", "max"):
        raise ValueError("pick must be 'min' or 'max'")
    names = [f"r{i}" for i in range(len(columns))]
    kinds = ", ".join(f"{n} {clocked.schema[c].dataType.simpleString()}" for n, c in zip(names, columns))
    o1, o2 = arrival
    rows = with_windows(clocked, ts, size, slide).select(
        F.col(key).alias("k"), epoch_millis(F.col(END)).alias("end_ms"), CLOCK, WATERMARK,
        F.col(value).cast("double").alias("v"), F.col(o1).cast("long").alias("o1"), F.col(o2).cast("long").alias("o2"),
        *[F.col(c).alias(n) for n, c in zip(names, columns)])
    out = _apply(
        rows, WindowFirings(millis(lateness), 1 if pick == "min" else -1, names, kinds),
        f"k {_kind(rows, 'k')}, end_ms long, firing_no long, {kinds}", "EventTime", ("k", "end_ms"))
    return out.select(
        F.col("k").alias(key), F.timestamp_millis(F.col("end_ms") - millis(size)).alias(START),
        F.timestamp_millis("end_ms").alias(END), "firing_no", *[F.col(n).alias(c) for n, c in zip(names, columns)])
