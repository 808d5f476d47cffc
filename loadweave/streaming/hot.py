"""Newest read per slot with state for hot slots only, and nothing lost beyond it.

A stream passes each read on to the merge, except those that state shows to be no newer than what was passed on before:
retransmissions never reach the table, and cost no rewrite of its days. State holds, per meter, the slots of the last
``hold``; a timer forgets the rest. A read of a forgotten slot is not too late: it goes to the merge, which knows
all slots, so the table is the same with any ``hold``, and only the number of rewrites differs.

Time here is the time of the batch, not of the reads: a watermark on the reads' own time would drop what is late. So timers
fire with the batches, and a stream that is drained ends.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Milliseconds after which a slot is forgotten.
HOLD_MS = 2 * 24 * 3_600 * 1_000
SEEN = "_seen_at"


def _hot_slots(hold_ms: int):
    """One meter's reads: passes on what is newer than the newest known of its slot; state is slot -> (order, until)."""

    def work(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        slots = dict(json.loads(state.get[0])) if state.exists else {}
        now = state.getCurrentWatermarkMs()
        passed = []
        for frame in () if state.hasTimedOut else frames:
            now = max(now, int(frame[SEEN].max().timestamp() * 1_000))
            newest = frame.sort_values(["ingested_at", "event_id"], kind="stable").drop_duplicates("read_ts", keep="last")
            good = []
            for slot, arrived, event in zip(newest["read_ts"], newest["ingested_at"], newest["event_id"]):
                order, name = [arrived.value, int(event)], str(slot.value)
                good.append(name not in slots or order > slots[name][:2])
                if good[-1]:
                    # A timer fires once the batch's time is past it.
                    slots[name] = [*order, now + hold_ms - 1]
            passed.append(newest[good].drop(columns=SEEN))
        hot = {name: slot for name, slot in slots.items() if slot[2] > state.getCurrentWatermarkMs()}
        if hot:
            state.update((json.dumps(list(hot.items())),))
            state.setTimeoutTimestamp(max(min(slot[2] for slot in hot.values()), state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield from passed

    return work


def newest_only(reads: DataFrame, hold_ms: int = HOLD_MS) -> DataFrame:
    """The stream of reads without those that hot state knows to be superseded."""
    seen = reads.withColumn(SEEN, F.current_timestamp()).withWatermark(SEEN, "0 seconds")
    return seen.groupBy("meter_id").applyInPandasWithState(
        _hot_slots(hold_ms), reads.schema, "slots string", "append", GroupStateTimeout.EventTimeTimeout
    )
