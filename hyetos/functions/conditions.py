"""Condition text to condition class and display glyph."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"  # no condition text
OTHER = "other"  # text that no rule matches

# Condition rules, first match in this order wins.
RULES: tuple[tuple[str, str], ...] = (
    ("Sunny", "clear"),
    ("Clear", "clear"),
    ("Partly cloudy", "partly_cloudy"),
    ("Partly Cloudy", "partly_cloudy"),
    ("Cloudy", "cloudy"),
    ("Overcast", "cloudy"),
    ("Mist", "fog"),
    ("Fog", "fog"),
    ("Freezing fog", "freezing_fog"),
    ("Patchy rain possible", "showers"),
    ("Light rain", "rain"),
    ("Light rain shower", "rain"),
    ("Moderate rain", "rain"),
    ("Heavy rain", "rain"),
    ("Heavy rain at times", "rain"),
    ("Moderate or heavy rain shower", "rain"),
    ("Torrential rain shower", "rain"),
    ("Rain", "rain"),
    ("Drizzle", "rain"),
    ("Thundery outbreaks possible", "thunder"),
    ("Patchy light rain with thunder", "thunder"),
    ("Moderate or heavy rain with thunder", "thunder"),
    ("Thunderstorm", "thunder"),
    ("Patchy snow possible", "snow"),
    ("Patchy light snow", "snow"),
    ("Light snow", "snow"),
    ("Patchy moderate snow", "snow"),
    ("Moderate snow", "snow"),
    ("Patchy heavy snow", "heavy_snow"),
    ("Heavy snow", "heavy_snow"),
    ("Blizzard", "heavy_snow"),
    ("Blowing snow", "blowing_snow"),
    ("Patchy light rain with snow", "rain_and_snow"),
    ("Moderate or heavy rain with snow", "rain_and_snow"),
    ("Light sleet", "sleet"),
    ("Moderate or heavy sleet", "sleet"),
    ("Ice pellets", "ice"),
    ("Light sleet showers", "sleet"),
    ("Moderate or heavy sleet showers", "sleet"),
)

# Glyph shown for each class.
GLYPHS: dict[str, str] = {
    "clear": "☀️",
    "partly_cloudy": "⛅",
    "cloudy": "☁️",
    "fog": "🌫️",
    "freezing_fog": "🌫️❄️",
    "showers": "🌦️",
    "rain": "🌧️",
    "thunder": "⛈️",
    "snow": "🌨️",
    "heavy_snow": "❄️",
    "blowing_snow": "🌬️❄️",
    "rain_and_snow": "🌨️🌧️",
    "sleet": "🌧️❄️",
    "ice": "🧊",
    UNKNOWN: "❓",
    OTHER: "🌡️",
}


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _case(branches: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """One CASE expression, handed over as SQL text: long chains build slowly call by call."""
    whens = " ".join(f"WHEN {test} THEN {_literal(value)}" for test, value in branches)
    return F.expr(f"CASE {whens} ELSE {otherwise} END")


def condition_class(
    text: str, lowered: str, rules: Sequence[tuple[str, str]] = RULES
) -> Column:
    """Class of the condition in column ``text``; column ``lowered`` is its lower case.

    Missing or empty text is ``unknown``. A text equal to a rule's pattern takes that
    rule's class; else the first rule whose pattern occurs in the text, ignoring
    case; else ``other``.
    """
    exact, contained = [], []
    for name, run in groupby(rules, key=itemgetter(1)):
        patterns = [pattern for pattern, _ in run]
        exact.append((f"`{text}` IN ({', '.join(map(_literal, patterns))})", name))
        hits = [f"contains(`{lowered}`, {_literal(p.lower())})" for p in patterns]
        contained.append((" OR ".join(hits), name))
    missing = (f"`{text}` IS NULL OR `{text}` = ''", UNKNOWN)
    return _case([missing, *exact, *contained], _literal(OTHER))


def with_condition_class(
    df: DataFrame, text: str, rules: Sequence[tuple[str, str]] = RULES
) -> DataFrame:
    """Add ``condition_class`` and ``condition_glyph`` for the text column."""
    lowered = f"{text}__lower"
    glyphs = [(f"condition_class = {_literal(name)}", glyph) for name, glyph in GLYPHS.items()]
    return (
        df.withColumn(lowered, F.lower(text))
        .withColumn("condition_class", condition_class(text, lowered, rules))
        .withColumn("condition_glyph", _case(glyphs, "NULL"))
        .drop(lowered)
    )


def condition_text(df: DataFrame) -> Column:
    """The modal condition, else the last one, as far as ``df`` has these columns."""
    present = [F.col(c) for c in ("common_condition", "last_condition") if c in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")
