"""Point-in-time lookup between two streams: facts meet the feature row they could have known."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tabwright.spec import FeatureLookup

#: Rows travel through the state as JSON, with whole microseconds.
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MATCHED = "fact string, feature string, feature_ts long"
_WHOLE = ("tinyint", "smallint", "int", "bigint")
#: Rows that are written to a list of the state at once.
ROWS_PER_MESSAGE = 10_000
_TIED = "feature rows share key and time; name a tie_break column"


class AsOf(StatefulProcessor):
    """The state of one key: features that a fact to come may still need, and facts that wait.

    A fact waits until the watermark has passed its time, as features up to then may still arrive.
    After that only the last feature before the watermark, and later ones, are kept. Both are lists that
    are added to as rows arrive and read and written as a whole when the watermark passes some: every
    call of the state is a message to the executor, so there is none per row.
    """

    def __init__(self, tie: str | None):
        self.tie = tie

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.history = handle.getListState("history", f"at long, tie {self.tie or 'long'}, feature string")
        self.waiting = handle.getListState("waiting", "at long, fact string")

    @staticmethod
    def _wins(tie: Any, old: Any) -> bool:
        return tie is not None and (old is None or tie > old)

    def _settle(self, rows: Iterator[tuple]) -> dict[int, tuple]:
        """The feature row of every time, out of rows in the order of their arrival."""
        known: dict[int, tuple] = {}
        for row in rows:
            old = known.get(row[0])
            if old is not None and self.tie is None:
                raise ValueError(_TIED)
            if old is None or self._wins(row[1], old[1]):
                known[row[0]] = tuple(row)
        return known

    @staticmethod
    def _write(state: Any, rows: list[tuple]) -> None:
        state.clear()
        for k in range(0, len(rows), ROWS_PER_MESSAGE):
            state.appendList(rows[k : k + ROWS_PER_MESSAGE])

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        earliest = None
        for batch in rows:
            facts, features = [], []
            for at, fact, tie, row in zip(
                batch["at"].tolist(), batch["fact"].tolist(), batch["tie"].tolist(), batch["row"].tolist()
            ):
                earliest = at if earliest is None else min(earliest, at)
                if fact:
                    facts.append((at, row))
                    continue
                # pandas widens whole numbers beside missing ones
                tie = None if tie is None or tie != tie else int(tie) if self.tie in _WHOLE else tie
                features.append((at, tie, row))
            if facts:
                self.waiting.appendList(facts)
            if features:
                self.history.appendList(features)
        if earliest is not None:
            # rows of a time are late once the watermark, in whole milliseconds, has reached it
            self.handle.registerTimer(earliest // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = [tuple(row) for row in self.waiting.get()] if self.waiting.exists() else []
        history = list(self.history.get()) if self.history.exists() else []
        due = sorted((row for row in waiting if row[0] < passed), key=lambda row: row[0])
        later = [row for row in waiting if row[0] >= passed]
        found = self._settle(history)
        known = sorted(found)
        out, i = [], 0
        for at, fact in due:
            while i < len(known) and known[i] <= at:
                i += 1
            match = known[i - 1] if i else None
            out.append((fact, found[match][2] if i else None, match))
        old = [at for at in known if at < passed]
        kept = [found[at] for at in known[max(0, len(old) - 1) :]]
        if due:
            self._write(self.waiting, later)
        if len(kept) < len(history):
            self._write(self.history, kept)
        ahead = [row[0] for row in later] + known[len(old) :]
        if ahead:
            self.handle.registerTimer(min(ahead) // 1000 + 1)
        if out:
            table = pd.DataFrame(out, columns=["fact", "feature", "feature_ts"])
            yield table.astype({"feature_ts": "Int64"})

    def close(self) -> None:
        pass


def _instant(column: str) -> Column:
    return F.col(column).cast("timestamp")


def point_in_time_stream(
    facts: DataFrame, lookup: FeatureLookup, lateness: str = "1 hour", matched_ts: str | None = None
) -> DataFrame:
    """Every fact row of a stream once, with the latest feature row of its key not after its time.

    ``facts`` and ``lookup.features`` are streams; rows of either may come out of order by up to
    ``lateness``, later ones are dropped. A fact comes out when the watermark has passed it, and equals
    what the batch lookup gives for all rows inside the watermark. A null key or time gives null
    features at once. State per key is bounded by what arrives within ``lateness``, and one feature row.
    The session needs the RocksDB state store (``PROVIDER``).
    """
    keys, ts, tie = lookup.keys, lookup.timestamp_lookup_key, lookup.tie_break
    features = lookup.features
    kind = features.schema[tie].dataType.simpleString() if tie else None
    names = list(lookup.feature_names)
    added = [lookup.rename.get(c, c) for c in names]
    complete = F.lit(True)
    for c in [*keys, ts]:
        complete = complete & F.col(c).isNotNull()

    def side(df: DataFrame, is_fact: bool, columns: list[str]) -> DataFrame:
        own_tie = F.col(tie) if tie and not is_fact else F.lit(None).cast(kind or "long")
        return df.where(complete).select(
            *[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)],
            _instant(ts).alias("time"),
            F.unix_micros(_instant(ts)).alias("at"),
            F.lit(is_fact).alias("fact"),
            own_tie.alias("tie"),
            F.to_json(F.struct(*[F.col(c) for c in columns]), _JSON).alias("row"),
        )

    both = side(facts, True, facts.columns).unionByName(side(features, False, names))
    matched = (
        both.withWatermark("time", lateness)
        .groupBy(*[f"key{i}" for i in range(len(keys))])
        .transformWithStateInPandas(AsOf(kind), MATCHED, "append", "eventTime")
    )
    wide = matched.select(
        F.from_json("fact", facts.schema, _JSON).alias("f"),
        F.from_json("feature", features.select(*names).schema, _JSON).alias("v"),
        "feature_ts",
    )
    own = [F.col(f"f.`{c}`").alias(c) for c in facts.columns]
    values = [F.col(f"v.`{c}`").alias(a) for c, a in zip(names, added)]
    at = F.timestamp_micros("feature_ts").cast(features.schema[ts].dataType)
    found = wide.select(*own, *values, *([at.alias(matched_ts)] if matched_ts else []))
    nothing = [
        F.lit(None).cast(features.schema[c].dataType).alias(a) for c, a in zip(names, added)
    ]
    if matched_ts:
        nothing.append(F.lit(None).cast(features.schema[ts].dataType).alias(matched_ts))
    return found.unionByName(facts.where(~complete).select(*facts.columns, *nothing))
