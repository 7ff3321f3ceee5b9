"""Data-quality expectations: named boolean predicates with drop / warn / fail.

Counts are gathered with ``DataFrame.observe``: they ride along with whatever
action writes the data, so checking quality costs no extra pass.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def _pred(p) -> Column:
    return F.expr(p) if isinstance(p, str) else p


def _metrics(checks: Mapping[str, Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.sum(F.when(c, 0).otherwise(1)).alias(f"failed_{k}") for k, c in checks.items()]]


class StreamCounts(StreamingQueryListener):
    """Sums, over the micro-batches of a stream, of the counts observed under ``name``.

    Add it with ``spark.streams.addListener`` before the stream starts; ``wait``
    returns the sums once the stream has ended and all its progress is in. A batch
    that a restart repeats counts once: the last progress of a batch stands.
    """

    def __init__(self, name: str):
        self.name, self.ended, self.batches = name, threading.Event(), {}

    def onQueryStarted(self, event) -> None:
        self.ended.clear()

    def onQueryProgress(self, event) -> None:
        seen = (event.progress.observedMetrics or {}).get(self.name)
        if seen is not None:
            self.batches[event.progress.batchId] = {k: v or 0 for k, v in seen.asDict().items()}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def wait(self, seconds: float = 60) -> dict[str, int]:
        if not self.ended.wait(seconds):
            raise TimeoutError(f"{self.name}: the stream has not ended")
        total: Counter = Counter()
        for counts in self.batches.values():
            total.update(counts)
        return dict(total)


def expect_on_stream(stream: DataFrame, rules: Mapping[str, str | Column], name: str = "expectations") -> DataFrame:
    """A streaming frame without the rows that fail a rule; ``StreamCounts(name)`` gathers the counts."""
    checks = {k: F.coalesce(_pred(v), F.lit(False)) for k, v in rules.items()}
    return expect_or_drop(stream.observe(name, *_metrics(checks)), rules)


def expect(df: DataFrame, rules: Mapping[str, str | Column], action: str = "drop",
           name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Apply expectations; return the frame and an Observation of pass/fail counts.

    A NULL predicate counts as a failure. ``drop`` removes failing rows,
    ``warn`` keeps them, ``fail`` raises on the first failing row when the
    frame is computed.
    """
    checks = {k: F.coalesce(_pred(v), F.lit(False)) for k, v in rules.items()}
    obs = Observation(name)
    observed = df.observe(obs, *_metrics(checks))
    all_ok = F.lit(True)
    for c in checks.values():
        all_ok = all_ok & c
    if action == "drop":
        return observed.filter(all_ok), obs
    if action == "warn":
        return observed, obs
    if action == "fail":
        failed = ", ".join(checks)
        # a filter condition is always evaluated (a dropped column would be pruned away)
        check = F.when(all_ok, F.lit(True)).otherwise(F.raise_error(F.lit(f"expectation failed: {failed}")))
        return observed.filter(check), obs
    raise ValueError(f"unknown action {action!r}")


def expect_or_drop(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """Keep only rows passing every rule (NULL counts as failing)."""
    keep = F.lit(True)
    for v in rules.values():
        keep = keep & F.coalesce(_pred(v), F.lit(False))
    return df.filter(keep)


def expectation_counts(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """One row: total rows and, per rule, passing and failing rows (a single global aggregate)."""
    aggs = [F.count(F.lit(1)).cast("long").alias("rows")]
    for k, v in rules.items():
        ok = F.coalesce(_pred(v), F.lit(False))
        aggs.append(F.coalesce(F.sum(F.when(ok, 1).otherwise(0)), F.lit(0)).cast("long").alias(f"passed_{k}"))
        aggs.append(F.coalesce(F.sum(F.when(ok, 0).otherwise(1)), F.lit(0)).cast("long").alias(f"failed_{k}"))
    return df.agg(*aggs)
