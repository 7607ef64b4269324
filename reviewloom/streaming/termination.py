"""Early termination of runs while their reports arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_RUN = "n int, best double, stopped int, checked array<double>"
STOPS = "experiment {kind}, run_id {run}, stopped_at int, own_best double, best double"


class BanditStops(StatefulProcessor):
    """The bandit policy per experiment, on state that lasts over batches and restarts.

    Per run the state holds its number of reports, its best value at every due report, and where it was
    stopped; per due report the best value of any run. A stop is emitted when the reports that cause it have
    arrived, and only once: what other runs report later can only confirm it, as best values never fall. A run
    that is stopped may go on reporting, and its values go on counting. With ``idle_ms`` an event-time timer drops the state of an
    experiment whose last report is that much older than the watermark. An experiment's state is one task's: it has a handful of runs.
    """

    def __init__(self, interval: int, slack: float, goal: str, idle_ms: int | None, kind: str):
        self.interval, self.slack, self.idle_ms, self.kind = interval, slack, idle_ms, kind
        self.sign = 1.0 if goal == "max" else -1.0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getMapState("runs", f"run_id {self.kind}", _RUN)
        self.peaks = handle.getMapState("peaks", "due int", "value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        runs = {k[0]: [v[0], v[1], v[2], list(v[3])] for k, v in self.runs.iterator()}
        peaks = {k[0]: v[0] for k, v in self.peaks.iterator()}
        arrived = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "seq"], kind="stable")
        changed, higher = set(), set()
        for run_id, value in zip(arrived["run_id"].tolist(), arrived["value"].tolist()):
            run = runs.setdefault(run_id, [0, None, None, []])
            changed.add(run_id)
            run[0] += 1
            due = -(-run[0] // self.interval)
            if value is not None and value == value:
                signed = self.sign * value
                run[1] = signed if run[1] is None else max(run[1], signed)
                if due not in peaks or signed > peaks[due]:
                    peaks[due] = signed
                    higher.add(due)
            if run[0] % self.interval == 0:
                run[3].append(float("-inf") if run[1] is None else run[1])
        found = []
        best, by_due = None, []
        for due in range(1, max(peaks, default=0) + 1):
            best = max((x for x in (best, peaks.get(due)) if x is not None), default=None)
            by_due.append(best)
        for run_id, run in sorted(runs.items()):
            if run[2] is not None:
                continue
            for place, own in enumerate(run[3]):
                best = by_due[min(place, len(by_due) - 1)] if by_due else None
                if best is not None and own != float("-inf") and self._behind(own, best):
                    run[2] = (place + 1) * self.interval
                    changed.add(run_id)
                    found.append((key[0], run_id, run[2], self.sign * own, self.sign * best))
                    break
        for run_id in changed:
            self.runs.updateValue((run_id,), tuple(runs[run_id]))
        for due in higher:
            self.peaks.updateValue((due,), (peaks[due],))
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            last = max(int(arrived["ts"].max().timestamp() * 1000), timerValues.getCurrentWatermarkInMs())
            self.handle.registerTimer(last + self.idle_ms)
        yield pd.DataFrame(found, columns=["experiment", "run_id", "stopped_at", "own_best", "best"])

    def _behind(self, own: float, best: float) -> bool:
        allowed = 1 + self.slack
        return own < (best / allowed if self.sign > 0 else best * allowed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.runs.clear()
        self.peaks.clear()
        yield pd.DataFrame([], columns=["experiment", "run_id", "stopped_at", "own_best", "best"])

    def close(self) -> None:
        pass


def stops(
    reports: DataFrame, interval: int = 5, slack: float = 0.1, goal: str = "max", idle_ms: int | None = None
) -> DataFrame:
    """A stream of (experiment, run_id, stopped_at, own_best, best) from one of (experiment, run_id, ts, seq, value).

    Needs the RocksDB state store. Missing values count as reports without a value. Without ``idle_ms`` every report
    counts, however late, and state stays; with it the watermark is that much behind the newest report, and
    reports that are older still are left out.
    """
    kinds = {f.name: f.dataType.simpleString() for f in reports.schema}
    processor = BanditStops(interval, slack, goal, idle_ms, kinds["run_id"])
    schema = STOPS.format(kind=kinds["experiment"], run=kinds["run_id"])
    mode = "None" if idle_ms is None else "EventTime"
    shown = reports.select("experiment", "run_id", F.col("ts").cast("timestamp").alias("ts"), "seq", "value")
    if idle_ms is not None:
        shown = shown.withWatermark("ts", f"{idle_ms} milliseconds")
    return shown.groupBy("experiment").transformWithStateInPandas(processor, schema, "Append", mode)
