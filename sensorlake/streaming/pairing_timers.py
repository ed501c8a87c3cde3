"""First-close pairing with keyed timers (J-3 on a stream): ``transformWithState``.

``streaming.pairing`` keeps an object's events in one state value and writes
all of it back in every batch. Here objects are dealt into ``buckets`` by a hash
of their code, and a bucket's state is in parts that are written on their own
(RocksDB, required):

* ``events``: a map of parts, each with events of neighbouring time slices in
  order of time. A batch adds parts for what it brings and reads none; a settled part
  is removed, and of a part that the watermark stands in, the rest is written again;
* ``pending``: per object, openings that no closing has answered, in parts that are
  full or the object's last. The first closing answers all of them and removes the parts;
* a timer at the bucket's earliest event. It fires as soon as the watermark
  passes that event, so a bucket without new events costs nothing.

So what is written follows the new events, not the size of the state, and calls
of the state store follow the parts: a few a bucket and one for every ``_FULL`` events or
so, where a call or more an event would take most of the time (each is a message to the JVM).

When a timer fires, every event of the bucket before the watermark is final: openings are
answered by the first final closing of their object strictly after them, in one pass by
object and time. Results, late rows and names are those of ``streaming.pairing``. Openings
that are never answered stay, as the batch operator has no time limit either (a TTL goes by
processing time in Spark, and would make results depend on it). A query keeps
the number of buckets that it began with.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT_SCHEMA = "object_code int, object_name string, opened_at_us long, closed_at_us long"
BUCKETS = 512           # tasks that can share the work at most
_OPEN, _CLOSE = 0, 1
_FULL = 64              # events that end a part, at the end of their slice


def _processor(slice_ms: int) -> StatefulProcessor:
    """The state function, built in a closure so it is shipped to Python workers by value."""
    OPEN, FULL = _OPEN, _FULL

    def after(us: int) -> int:
        """The first millisecond at which the watermark is beyond ``us``."""
        return us // 1000 + 1

    def stored(us, code, kind, name) -> tuple:
        return us.astype("int64").tobytes(), code.astype("int32").tobytes(), kind.astype("int8").tobytes(), name.tolist()

    def loaded(value) -> tuple:
        us, code, kind, name = value
        return (np.frombuffer(us, "int64"), np.frombuffer(code, "int32"), np.frombuffer(kind, "int8"), texts(name))

    def texts(names) -> np.ndarray:
        out = np.empty(len(names), object)
        out[:] = names
        return out

    class FirstClose(StatefulProcessor):
        """Pairs the events of one bucket of objects; ``slice_ms`` is the width of a time slice."""

        def __init__(self, slice_ms: int):
            self.slice_us = slice_ms * 1000

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.events = handle.getMapState("events", "first long, number long",
                                             "us binary, code binary, kind binary, name array<string>")
            self.mark = handle.getValueState("mark", "number long, earliest long")     # parts so far; what the timer is for
            self.pending = handle.getMapState("pending", "code int, number int", "us binary, name array<string>")
            self.pending_parts = handle.getMapState("pending_parts", "code int", "number int")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            settled = timerValues.getCurrentWatermarkInMs() * 1000
            before, added = self.mark.get() or (0, None), 0
            number, earliest = before
            for pdf in rows:
                us = pdf["event_us"].to_numpy("int64")
                order = np.argsort(us, kind="stable")
                order = order[us[order] >= settled]     # before the watermark: late, as for Spark's own operators
                if not len(order):
                    continue
                us, code, kind = us[order], pdf["object_code"].to_numpy()[order], pdf["kind"].to_numpy()[order]
                name = texts(pdf["object_name"].tolist())[order]
                lo = 0
                for hi in [*(np.flatnonzero(np.diff(us // self.slice_us)) + 1).tolist(), len(us)]:
                    if hi - lo >= FULL or hi == len(us):
                        self.events.updateValue((int(us[lo]), number + added),
                                                stored(us[lo:hi], code[lo:hi], kind[lo:hi], name[lo:hi]))
                        lo, added = hi, added + 1
                earliest = int(us[0]) if earliest is None else min(earliest, int(us[0]))
            if added:
                if earliest != before[1]:
                    if before[1] is not None:
                        self.handle.deleteTimer(after(before[1]))
                    self.handle.registerTimer(after(earliest))
                self.mark.update((number + added, earliest))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            watermark = timerValues.getCurrentWatermarkInMs() * 1000
            final, left = [], []
            for first, number in sorted(tuple(k) for k in self.events.keys()):
                if first >= watermark:
                    left.append(first)
                    continue
                part = loaded(self.events.getValue((first, number)))
                n = int(np.searchsorted(part[0], watermark))
                final.append([column[:n] for column in part])
                self.events.removeKey((first, number))
                if n < len(part[0]):
                    left.append(int(part[0][n]))
                    self.events.updateValue((left[-1], number), stored(*[column[n:] for column in part]))
            if left:
                self.handle.registerTimer(after(min(left)))
            self.mark.update((self.mark.get()[0], min(left) if left else None))
            if not final:
                return
            us, code, kind, name = (np.concatenate(column) for column in zip(*final))
            # by object and time; at one instant closings first: a closing answers only what was opened before it
            order = np.lexsort((kind == OPEN, us, code))
            us, code, kind, name = us[order], code[order], kind[order], name[order]
            closing = np.flatnonzero(kind != OPEN)
            opening = np.flatnonzero(kind == OPEN)
            answer = np.append(closing, 0)[np.searchsorted(closing, opening)]       # the next closing; 0 is before all openings
            answered = (answer > opening) & (code[answer] == code[opening])
            codes, opened = [code[opening[answered]]], [us[opening[answered]]]
            names, closed = [name[opening[answered]]], [us[answer[answered]]]

            waits = self.pending_parts.exists()
            if waits:                                   # an object's first closing answers what is left from before
                who, at = np.unique(code[closing], return_index=True)
                for object_code, until in zip(who.tolist(), us[closing[at]].tolist()):
                    (parts,) = self.pending_parts.getValue((object_code,)) or (0,)
                    for i in range(parts):
                        held, held_names = self.pending.getValue((object_code, i))
                        self.pending.removeKey((object_code, i))
                        opened.append(np.frombuffer(held, "int64"))
                        names.append(texts(held_names))
                        codes.append(np.full(len(held_names), object_code))
                        closed.append(np.full(len(held_names), until))
                    if parts:
                        self.pending_parts.removeKey((object_code,))
            waiting = opening[~answered]
            who, at = np.unique(code[waiting], return_index=True)
            for object_code, rows in zip(who.tolist(), np.split(waiting, at[1:])):
                (parts,) = (waits and self.pending_parts.getValue((object_code,))) or (0,)
                held, held_names = (self.pending.getValue((object_code, parts - 1)) if parts else None) or (b"", [])
                if len(held_names) >= FULL:
                    held, held_names = b"", []
                elif parts:
                    parts -= 1
                self.pending.updateValue((object_code, parts), (bytes(held) + us[rows].tobytes(), list(held_names) + name[rows].tolist()))
                self.pending_parts.updateValue((object_code,), (parts + 1,))
            if any(map(len, opened)):
                yield pd.DataFrame({"object_code": np.concatenate(codes).astype("int32"), "object_name": np.concatenate(names).tolist(),
                                    "opened_at_us": np.concatenate(opened), "closed_at_us": np.concatenate(closed)})

        def close(self) -> None:
            pass

    return FirstClose(slice_ms)


def timed_first_close_pairs(events: DataFrame, delay: str = "10 minutes", slice_seconds: float = 60, buckets: int = BUCKETS) -> DataFrame:
    """Streaming pairs of each opening with its first later closing (append mode); needs the RocksDB state store."""
    src = (events.withWatermark("event_timestamp", delay)
           .filter(F.col("event_timestamp").isNotNull() & F.col("object_code").isNotNull())
           .select(F.pmod(F.xxhash64("object_code"), F.lit(buckets)).cast("int").alias("bucket"),
                   F.col("object_code").cast("int").alias("object_code"), "object_name", "event_timestamp",
                   F.unix_micros("event_timestamp").alias("event_us"),     # no leading underscore: rows are named tuples
                   F.when(F.col("event_type") == "opened", _OPEN).when(F.col("event_type") == "closed", _CLOSE)
                   .alias("kind"))
           .filter(F.col("kind").isNotNull()))
    pairs = src.groupBy("bucket").transformWithStateInPandas(
        _processor(int(slice_seconds * 1000)), OUTPUT_SCHEMA, "append", "EventTime")
    return pairs.select("object_code", "object_name",
                        F.timestamp_micros("opened_at_us").alias("opened_at"),
                        F.timestamp_micros("closed_at_us").alias("closed_at"))
