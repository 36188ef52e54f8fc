"""State processors; workers import this module, so it needs no session."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MINUTE = 60
BLOCK = 1440 * MINUTE  # windows of a provider that share a state list


class WindowCounts(StatefulProcessor):
    """Counts so far of a provider's windows within a block, while the watermark has not reached their ends; afterwards rows are late ones.

    A call reads and writes one state list, whatever the number of windows; the list holds the open windows that had rows.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getListState("count", "minute long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        block, provider = key
        mark = timerValues.getCurrentWatermarkInMs()
        touched, n = np.unique(np.concatenate([batch["minute"].to_numpy() for batch in rows]), return_counts=True)
        late = (touched + MINUTE) * 1000 <= mark
        if not late.all():
            if self.counts.exists():
                known = {m: c for m, c in self.counts.get() if (m + MINUTE) * 1000 > mark}
            else:
                known = {}
                self.handle.registerTimer((block + BLOCK) * 1000)
            for at in np.flatnonzero(~late):
                minute = int(touched[at])
                known[minute] = known.get(minute, 0) + int(n[at])
                n[at] = known[minute]
            self.counts.put(list(known.items()))
        yield pd.DataFrame({"minute": touched, "provider": provider, "kind": np.where(late, "late", "count"), "requests": n})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.counts.clear()
        return iter(())

    def close(self) -> None:
        pass
