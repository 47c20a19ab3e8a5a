"""Forward fill over a stream of readings."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "last double, settled bigint, times array<bigint>, cells array<double>"


def forward_fill_stream(
    cells: DataFrame,
    delay: str = "2 hours",
    entity: str = "entity_id",
    ts: str = "ts",
    variable: str = "variable",
    value: str = "value",
) -> DataFrame:
    """The last reading up to each cell, per entity and variable, from long cells (``entity``, ``ts``, ``variable``, ``value``).

    Cells may arrive in any order within ``delay``.  A cell is emitted, filled, once the watermark has passed its time, so
    nothing earlier can still come; cells that arrive after that are left out, as in every watermarked aggregate.  Of several
    cells at one time the readings fill the gaps among them and the largest reading is carried on.  State is one row per entity
    and variable: the reading carried on and the cells that wait.
    """
    fields = dict(cells.dtypes)
    out = f"{entity} {fields[entity]}, {variable} {fields[variable]}, {ts} timestamp, {value} double"
    timed = cells.select(entity, variable, F.col(ts).cast("timestamp").alias(ts), F.col(value).cast("double").alias(value))
    timed = timed.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
    timed = timed.withColumn("__at", F.unix_micros(ts))

    def fill(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, settled, times, values = state.get if state.exists else (None, None, [], [])
        waiting = list(zip(times or [], values or []))
        for batch in batches:
            known = batch[value].notna()
            more = zip(batch["__at"].tolist(), batch[value].where(known, None).tolist(), known.tolist())
            waiting += [(at, v if has else None) for at, v, has in more if settled is None or at > settled]
        upto = state.getCurrentWatermarkMs() * 1000
        waiting.sort(key=lambda cell: (cell[0], cell[1] is None, cell[1] or 0.0))  # readings before gaps of the same time
        done = [cell for cell in waiting if cell[0] <= upto]
        waiting = waiting[len(done) :]
        filled = []
        for at, v in done:
            last = v if v is not None else last
            filled.append((at, last if v is None else v))
        settled = done[-1][0] if done else settled
        if waiting or last is not None or settled is not None:
            state.update((last, settled, [at for at, _ in waiting], [v for _, v in waiting]))
        if waiting:
            state.setTimeoutTimestamp(max(waiting[0][0] // 1000 + 1, upto // 1000 + 1))
        if filled:
            at, v = zip(*filled)
            yield pd.DataFrame(
                {entity: [key[0]] * len(at), variable: [key[1]] * len(at), ts: pd.to_datetime(list(at), unit="us"), value: pd.Series(v, dtype=float)}
            )

    filled = timed.groupBy(entity, variable).applyInPandasWithState(fill, out, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return filled.select(entity, variable, F.col(ts).cast("timestamp_ntz").alias(ts), value)
