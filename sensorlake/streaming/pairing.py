"""Streaming first-close pairing (J-3 on a stream) with bounded, watermark-driven state.

Keyed by ``object_code`` with ``applyInPandasWithState``. Per object the state
holds only

* the events not yet final (event time at or after the watermark), and
* the openings seen so far that no closing has answered yet.

Once the watermark passes an event, no earlier event can still arrive, so the
final events are settled: each pending opening is answered by the first final
closing strictly after it (a vectorised ``searchsorted``); unanswered openings
stay pending. Arrival order (bus partitions, retries) does not
matter. Events older than what was already finalised are late and ignored,
as Spark's own stateful operators do. The output is append-only: a pair is
emitted once, when its closing becomes final -- equal to the batch pairing
restricted to closings before the final watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT_SCHEMA = "object_code int, object_name string, opened_at_us long, closed_at_us long"
STATE_SCHEMA = ("buf_us array<long>, buf_kind array<int>, buf_name array<string>, pending array<long>, "
                "pending_name array<string>, final_upto long")

_OPEN, _CLOSE = 0, 1


def _pairer():
    """The state function, built in a closure so it is shipped to Python workers by value."""
    OPEN, CLOSE = _OPEN, _CLOSE

    def pair_events(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import numpy as np

        (code,) = key
        if state.exists:
            buf_us, buf_kind, buf_name, pending, pending_name, final_upto = state.get
            buf_us = np.asarray(buf_us or [], dtype="int64")
            buf_kind = np.asarray(buf_kind or [], dtype="int64")
            pending = np.asarray(pending or [], dtype="int64")
            buf_name, pending_name = (np.array(x or [], dtype=object) for x in (buf_name, pending_name))
        else:
            buf_us, buf_kind, pending = (np.empty(0, "int64") for _ in range(3))
            buf_name, pending_name, final_upto = np.empty(0, object), np.empty(0, object), None

        for pdf in batches:
            if final_upto is not None:
                pdf = pdf[pdf["_us"] >= final_upto]           # late: older than what is final
            if pdf.empty:
                continue
            buf_us = np.concatenate([buf_us, pdf["_us"].to_numpy("int64")])
            buf_kind = np.concatenate([buf_kind, pdf["_kind"].to_numpy("int64")])
            buf_name = np.concatenate([buf_name, pdf["object_name"].to_numpy(object)])

        watermark_us = state.getCurrentWatermarkMs() * 1000
        final = buf_us < watermark_us if watermark_us > 0 else np.zeros(len(buf_us), bool)
        settled = final & (buf_kind == OPEN)
        opens = np.concatenate([pending, buf_us[settled]])
        by_time = np.argsort(opens, kind="stable")
        opens, names = opens[by_time], np.concatenate([pending_name, buf_name[settled]])[by_time]   # an opening's own name
        closes = np.sort(buf_us[final & (buf_kind == CLOSE)])
        # first closing strictly later than each opening
        nxt = np.searchsorted(closes, opens, side="right")
        answered = nxt < len(closes)
        out_open, out_close = opens[answered], closes[nxt[answered]]
        pending, pending_name = opens[~answered], names[~answered]

        if watermark_us > 0:
            final_upto = max(final_upto or 0, watermark_us)
        keep_us, keep_kind = buf_us[~final], buf_kind[~final]
        state.update((keep_us.tolist(), keep_kind.tolist(), buf_name[~final].tolist(), pending.tolist(),
                      pending_name.tolist(), final_upto))
        if len(keep_us):
            # wake up as soon as the watermark passes the oldest event still buffered
            state.setTimeoutTimestamp(max(int(keep_us.min()) // 1000, state.getCurrentWatermarkMs(), 1))
        if len(out_open):
            yield pd.DataFrame({"object_code": np.full(len(out_open), code, dtype="int32"),
                                "object_name": names[answered].tolist(),
                                "opened_at_us": out_open, "closed_at_us": out_close})

    return pair_events


def stream_first_close_pairs(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Streaming pairs of each opening with its first later closing (append mode)."""
    src = (events.withWatermark("event_timestamp", delay)
           .filter(F.col("event_timestamp").isNotNull() & F.col("object_code").isNotNull())
           .select("object_code", "object_name", "event_timestamp",
                   F.unix_micros("event_timestamp").alias("_us"),
                   F.when(F.col("event_type") == "opened", _OPEN).when(F.col("event_type") == "closed", _CLOSE)
                   .alias("_kind"))
           .filter(F.col("_kind").isNotNull()))
    pairs = src.groupBy("object_code").applyInPandasWithState(
        _pairer(), OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
    return pairs.select("object_code", "object_name",
                        F.timestamp_micros("opened_at_us").alias("opened_at"),
                        F.timestamp_micros("closed_at_us").alias("closed_at"))
