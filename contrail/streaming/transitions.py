"""ST-6: incremental take-off / landing detection on a stream.

Keyed state per aircraft: its last processed positioned snapshot (time,
on_ground) and the rows that arrived but are not final yet. A row becomes
final once the watermark (max event time seen minus ``lateness``) passes
it; final rows are processed in event-time order against the previous row,
exactly as the batch ``lag`` does, and then leave the pending set. So rows
that arrive out of order, but within ``lateness``, give the batch result.
A row older than the last processed one is too late and is skipped.
Event-time timeouts flush pending rows when the watermark passes them
without new input, and drop the state of an aircraft unseen for ``ttl``
(the 7-day retention of state vectors).

The per-key work of one micro-batch is bounded by the rows of that aircraft
inside the lateness window; the state is one row plus those pending rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from contrail.constants import LANDING, STATE_VECTOR_TTL_DAYS, TAKEOFF
from contrail.session import ship_code

EVENT_SCHEMA = ("icao24 STRING, event_time TIMESTAMP, event_type STRING, latitude DOUBLE, "
                "longitude DOUBLE, gap_seconds INT, batch_id STRING")
STATE_SCHEMA = "last_us LONG, last_ground BOOLEAN, pending STRING"  # times as epoch microseconds
_EVENT_COLS = ["icao24", "event_time", "event_type", "latitude", "longitude", "gap_seconds", "batch_id"]


_ROW_COLS = ["t", "g", "la", "lo", "s"]  # time (epoch us), on_ground, lat, lon, ingest order


def _make_step(batch_id: str, ttl_ms: int):
    def step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last_t, last_g, parts = None, None, []
        if state.exists:
            lt, lg, pend = state.get
            last_t = int(lt) if lt is not None else None
            last_g = bool(lg) if lg is not None else None
            if pend:
                parts.append(pd.DataFrame(json.loads(pend), columns=_ROW_COLS))
        if not state.hasTimedOut:
            for pdf in pdfs:
                if pdf.empty:
                    continue
                parts.append(pd.DataFrame({
                    "t": pdf["snapshot_time"].astype("datetime64[us]").astype("int64"),
                    "g": pdf["on_ground"].astype(bool),
                    "la": pdf["latitude"].astype(float),
                    "lo": pdf["longitude"].astype(float),
                    "s": pdf["ingest_seq"].astype("int64") if "ingest_seq" in pdf.columns else 0,
                }))
        rows = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=_ROW_COLS)
        if last_t is not None:
            rows = rows[rows["t"] > last_t]  # older than the last processed row: too late
        # one row per time (the highest ingest order), in event-time order
        rows = rows.sort_values(["t", "s"], kind="mergesort").drop_duplicates("t", keep="last")
        wm_ms = state.getCurrentWatermarkMs()
        final = rows["t"] <= wm_ms * 1000
        ready, waiting = rows[final], rows[~final]

        if not ready.empty:
            prev_g = ready["g"].shift(1)
            prev_t = ready["t"].shift(1)
            if last_t is not None:
                prev_g.iloc[0], prev_t.iloc[0] = last_g, last_t
            changed = prev_g.notna() & (prev_g.astype("boolean") != ready["g"].astype("boolean"))
            if changed.any():
                cur = ready[changed]
                was_ground = prev_g[changed].astype(bool)
                out = pd.DataFrame({
                    "icao24": key[0],
                    "event_time": pd.to_datetime(cur["t"], unit="us"),
                    "event_type": was_ground.map({True: TAKEOFF, False: LANDING}),
                    "latitude": cur["la"],
                    "longitude": cur["lo"],
                    # whole seconds of each side, then the difference
                    "gap_seconds": (cur["t"] // 1_000_000 - prev_t[changed].astype("int64") // 1_000_000)
                    .astype("int32"),
                    "batch_id": batch_id,
                })
                yield out[_EVENT_COLS]
            last_t, last_g = int(ready["t"].iloc[-1]), bool(ready["g"].iloc[-1])

        expired = waiting.empty and last_t is not None and last_t // 1000 + ttl_ms < wm_ms
        if (last_t is None and waiting.empty) or expired:
            state.remove()
            return
        state.update((last_t, last_g, json.dumps(waiting[_ROW_COLS].values.tolist())))
        # wake up when the watermark reaches the oldest waiting row (a timeout
        # fires once the watermark is strictly past it), or at expiry
        wake = [int(waiting["t"].iloc[0]) // 1000 - 1] if not waiting.empty else []
        if last_t is not None:
            wake.append(last_t // 1000 + ttl_ms)
        state.setTimeoutTimestamp(max(min(wake), wm_ms + 1))

    return step


def detect_transitions_stream(positions: DataFrame, batch_id: str = "stream",
                              lateness: str = f"{STATE_VECTOR_TTL_DAYS} days",
                              ttl_days: int = STATE_VECTOR_TTL_DAYS) -> DataFrame:
    """``positions``: a streaming DataFrame with icao24, snapshot_time
    (TIMESTAMP), on_ground, latitude, longitude (+ optional ingest_seq).
    ``lateness``: how far behind the newest event time, over all aircraft, a
    row may arrive and still be put in order; by default the time state
    vectors are kept. Events wait that long; a caller whose rows are known to
    arrive in order may pass "0 seconds". Returns the streaming events (append mode)."""
    ship_code()
    cols = ["icao24", "snapshot_time", "on_ground", "latitude", "longitude"]
    if "ingest_seq" in positions.columns:
        cols.append("ingest_seq")
    pos = (positions.filter(F.col("icao24").isNotNull() & F.col("snapshot_time").isNotNull()
                            & F.col("on_ground").isNotNull() & F.col("latitude").isNotNull()
                            & F.col("longitude").isNotNull())
                    .select(*cols)
                    .withWatermark("snapshot_time", lateness))
    return pos.groupBy("icao24").applyInPandasWithState(
        _make_step(batch_id, int(ttl_days) * 86_400_000),
        outputStructType=EVENT_SCHEMA,
        stateStructType=STATE_SCHEMA,
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )
