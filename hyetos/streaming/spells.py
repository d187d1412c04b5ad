"""Heat spells per location as explicit state: a spell opens, lasts and closes.

Readings are first reduced to one peak per location and hour, which a watermark closes, so
the state function sees each hour once, in order, and a location that holds most rows sends
it no more than others. A spell opens with a peak above ``open_above``, lasts while peaks
stay above ``close_at`` and closes with the first that does not (``calm``), or when the next
hour lies more than ``quiet`` hours after its last one (``quiet``); an event-time timer
closes spells of locations that fell silent. State is one small row per location with an open spell.

The state function runs in Python workers, as Spark offers this operator to Python no other way.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from hyetos.session import rocksdb_state
from hyetos.streaming.queries import SPELLS, start_history

HOUR_MS = 3_600_000
_SPELL = "name string, opened_ms long, last_ms long, n_hours long, peak double, closed_by string"


class SpellProcessor(StatefulProcessor):
    def __init__(self, open_above: float, close_at: float, quiet: int):
        self.open_above, self.close_at, self.quiet_ms = open_above, close_at, quiet * HOUR_MS

    def _silent_at(self, spell: tuple) -> int:
        """The watermark that has closed every hour which could still carry the spell on."""
        return spell[1] + self.quiet_ms + HOUR_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spell = handle.getValueState("spell", "opened long, last long, n_hours long, peak double")

    def _row(self, key, spell: tuple, closed_by: str) -> pd.DataFrame:
        names = ["name", "opened_ms", "last_ms", "n_hours", "peak", "closed_by"]
        return pd.DataFrame([(key[0], *spell, closed_by)], columns=names)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        hours = pd.concat(list(rows))[["hour_ms", "peak"]]  # one row for each closed hour
        spell = before = tuple(self.spell.get() or ())
        for hour, peak in sorted(hours.itertuples(index=False, name=None), key=lambda r: r[0]):
            known = peak is not None and peak == peak
            if spell and hour - spell[1] > self.quiet_ms:
                yield self._row(key, spell, "quiet")
                spell = ()
            if spell and known and peak <= self.close_at:
                yield self._row(key, spell, "calm")
                spell = ()
            elif spell:
                spell = (spell[0], int(hour), spell[2] + 1, max(spell[3], peak) if known else spell[3])
            elif known and peak > self.open_above:
                spell = (int(hour), int(hour), 1, float(peak))
        if spell and self._silent_at(spell) <= timerValues.getCurrentWatermarkInMs():
            yield self._row(key, spell, "quiet")
            spell = ()
        if before:
            self.handle.deleteTimer(self._silent_at(before))
        if spell:
            self.spell.update(spell)
            self.handle.registerTimer(self._silent_at(spell))
        elif before:
            self.spell.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        spell = self.spell.get()
        if spell and self._silent_at(spell) <= expiredTimerInfo.getExpiryTimeInMs():
            yield self._row(key, tuple(spell), "quiet")
            self.spell.clear()

    def close(self) -> None:
        pass


def start_spells(
    forecast: DataFrame,
    root: str,
    open_above: float = 30.0,
    close_at: float = 25.0,
    quiet: int = 2,
    delay: str = "10 minutes",
    **options,
) -> StreamingQuery:
    """Closed spells of fetched temperatures: name, opened, last_hour, n_hours, peak, closed_by.

    Hours are those of ``fetch_time``; readings later than the watermark, ``delay`` behind the
    newest, are dropped. The state function needs the RocksDB state store and gets it here.
    """
    timed = forecast.select("name", F.col("fetch_time").cast("timestamp").alias("fetch_time"), "temp")
    peaks = (
        timed.withWatermark("fetch_time", delay)
        .groupBy(F.window("fetch_time", "1 hour"), "name")
        .agg(F.max(F.col("temp").cast("double")).alias("peak"))
        .select("name", F.col("window"), F.unix_millis("window.start").alias("hour_ms"), "peak")
    )
    spells = peaks.groupBy("name").transformWithStateInPandas(
        SpellProcessor(open_above, close_at, quiet), _SPELL, "Append", "EventTime"
    )
    shown = spells.select(
        "name",
        F.timestamp_millis("opened_ms").alias("opened"),
        F.timestamp_millis("last_ms").alias("last_hour"),
        "n_hours",
        "peak",
        "closed_by",
    )
    with rocksdb_state(forecast.sparkSession):
        return start_history(shown, root, SPELLS, "append", **options)
