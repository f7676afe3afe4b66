"""Sequence events of each venue and symbol as a stateful stream; the batch twin is ``quality.sequence_events``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "exchange string, symbol string, seq long, event string, gap long"


def _track(large: int):
    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """A key's rows come in order (its group is sorted by time and sequence before); the state goes from one batch of them to the next."""
        last, high = state.get if state.exists else (None, None)
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["ts", "seq"], kind="stable")
        seq = rows["seq"].to_numpy(np.int64)
        if not len(seq):
            return
        before = np.r_[seq[0] if last is None else last, seq[:-1]]
        reset = seq < before * 0.5
        event, gap = np.empty(len(seq), object), np.zeros(len(seq), np.int64)
        edges = np.r_[0, np.flatnonzero(reset)] if not reset[0] else np.flatnonzero(reset)
        for a, b in zip(edges, np.r_[edges[1:], len(seq)], strict=True):  # sections between resets, each with a running maximum
            own = seq[a:b]
            start = None if reset[a] else high
            top = np.maximum.accumulate(own if start is None else np.maximum(own, start))
            known = np.r_[0 if start is None else start, top[:-1]]
            step_gap = own - known - 1
            found = np.where(own <= known, "OUT_OF_ORDER", np.where(step_gap == 0, "OK", np.where(step_gap <= large, "SMALL_GAP", "LARGE_GAP"))).astype(object)
            step_gap = np.where((own > known) & (step_gap > 0), step_gap, 0)
            if start is None:
                found[0], step_gap[0] = "RESET" if reset[a] else "FIRST", 0
            event[a:b], gap[a:b], high = found, step_gap, int(top[-1])
        state.update((int(seq[-1]), high))
        yield pd.DataFrame({"exchange": key[0], "symbol": key[1], "seq": seq, "event": event, "gap": gap})

    return step


def sequence_stream(stream: DataFrame, large: int = 10) -> DataFrame:
    """FIRST, OK, SMALL_GAP, LARGE_GAP, RESET or OUT_OF_ORDER for each message; the state is two numbers a key."""
    return stream.select("exchange", "symbol", "seq", "ts").groupBy("exchange", "symbol").applyInPandasWithState(_track(large), OUT, "last long, high long", "append", GroupStateTimeout.NoTimeout)
