"""Confidence of a classification: five signals and their weighted mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia.functions import duration_seconds, title_lc, views, who
from catalogia.operators.profiles import DICTIONARY, with_dictionary
from catalogia.operators.rules import has, matches, settle


def _one_of(column: str, values: list[str]) -> str:
    return f"{column} in (" + ", ".join(f"'{v}'" for v in values) + ")"


def _steps(*steps: tuple[str, float], other: float) -> str:
    branches = " ".join(f"when {condition} then {value}D" for condition, value in steps)
    return f"case {branches} else {other}D end"


# Each signal is SQL over an item row with its dictionaries in ``_p``, its channel or
# author in ``_who``, its views in ``_views`` and its duration in ``_seconds``.
RULE_STRENGTH = _steps(
    (_one_of("classification_reason", V.STRONG_REASONS), 1.0),
    (_one_of("classification_reason", V.MEDIUM_REASONS), 0.7),
    ("startswith(classification_reason, 'llm_')", 0.5),
    ("classification_reason = 'no_rule_match'", 0.0),
    other=0.6,
)
SOURCE_RELIABILITY = _steps(
    (f"array_contains({DICTIONARY}.official, _who)", 1.0),
    (" or ".join(f"contains(_who, '{mark}')" for mark in V.TOPIC_CHANNEL_MARKS), 0.85),
    ("source = 'youtube' and verified", 0.7),
    ("source = 'bilibili' and verified", 0.6),
    (f"array_contains({DICTIONARY}.labels, _who)", 0.9),
    ("not verified", 0.3),
    other=0.5,
)
VIEW_COUNT = _steps(
    ("_views >= 1000000", 1.0), ("_views >= 100000", 0.85), ("_views >= 10000", 0.7),
    ("_views >= 1000", 0.55),
    other=0.4,
)


def _band(low: int, ideal_low: int, ideal_high: int, high: int) -> str:
    """SQL: 1 inside the ideal band, a ramp from 0.6 around it, 0.2 outside.

    The ramp is rounded to two digits on its exact binary value, ties to even, which
    is what ``format_number`` does.
    """
    rising = f"0.4D * (_seconds - {low}) / {ideal_low - low} + 0.6D"
    falling = f"0.4D * ({high} - _seconds) / {high - ideal_high} + 0.6D"
    return (
        f"case when _seconds between {ideal_low} and {ideal_high} then 1D "
        f"when _seconds between {low} and {high} then "
        f"double(format_number(if(_seconds < {ideal_low}, {rising}, {falling}), 2)) else 0.2D end"
    )


DURATION_FIT = "case when _seconds is null then 0.5D " + " ".join(
    f"when category = '{category}' then {_band(*band)}"
    for category, band in V.DURATION_BANDS.items()
) + " else 0.5D end"

_IN_GROUP = has("group_lc", "_t_lc")
_MV_WORD = matches(V.SCORE_MV_WORD)
# Per category: conditions on the title from strong to weak, else 0.3.
_TITLE_LADDERS = {
    "personal_mv": [
        (1.0, matches(V.OFFICIAL_MV)), (0.8, _MV_WORD), (0.6, has("tracks_lc", "_t_lc")),
    ],
    "group_mv": [(1.0, f"{_IN_GROUP} and {_MV_WORD}"), (0.6, f"{_IN_GROUP} or {_MV_WORD}")],
    "concerts": [(1.0, matches(V.CONCERT_KEYWORD)), (0.7, matches(V.SCORE_CONCERT_LIVE))],
    "variety": [(1.0, has("shows_lc", "_t_lc")), (0.8, matches(V.SCORE_GALA))],
    "interviews": [(1.0, matches(V.INTERVIEW_KEYWORD)), (0.8, matches(V.SCORE_BEHIND))],
    "ost_singles": [(0.9, has("ost_names_lc", "_t_lc")), (0.8, matches(V.SCORE_OST))],
    "collabs": [
        (1.0, matches(V.SCORE_COLLAB)),
        (0.8, f"exists({DICTIONARY}.collabs, c -> contains(_t_lc, c.name_lc))"),
    ],
}


def _title_match() -> str:
    ladders = ""
    for category, steps in _TITLE_LADDERS.items():
        ladder = " ".join(f"when {condition} then {value}D" for value, condition in steps)
        ladders += f" when '{category}' then case {ladder} else 0.3D end"
    return f"case category{ladders} else 0.5D end"


SIGNALS = {
    "rule_strength": RULE_STRENGTH,
    "source_reliability": SOURCE_RELIABILITY,
    "duration_fit": DURATION_FIT,
    "view_count": VIEW_COUNT,
    "title_match": _title_match(),
}


def score(items: DataFrame, profiles: DataFrame, keep_dictionary=False) -> DataFrame:
    """Items plus ``confidence`` and ``confidence_signals``; needs category and reason."""
    results = ("confidence", "confidence_signals")
    kept = [c for c in items.columns if c not in (*results, DICTIONARY)]
    base = with_dictionary(items, profiles).select(
        *kept, DICTIONARY, title_lc().alias("_t_lc"), who().alias("_who"), views().alias("_views"),
        duration_seconds(F.col("duration")).alias("_seconds"),
    )
    # Discards are judged by the rule alone; their other signals are never computed.
    discard = f"category = '{V.DISCARD}'"
    signals = base.selectExpr("*", *[
        f"{sql} as _s_{name}" if name == "rule_strength"
        else f"if({discard}, null, {sql}) as _s_{name}"
        for name, sql in SIGNALS.items()
    ])
    total = 0.0
    for weight in V.SIGNAL_WEIGHTS.values():
        total += weight
    weighted = " + ".join(f"_s_{name} * {weight}D" for name, weight in V.SIGNAL_WEIGHTS.items())
    mean = f"round(least(greatest(({weighted}) / {total}D, 0D), 1D), 3)"
    pairs = ", ".join(f"'{name}', _s_{name}" for name in SIGNALS)
    return settle(
        signals, [*kept, DICTIONARY] if keep_dictionary else kept,
        confidence=F.expr(f"if({discard}, _s_rule_strength, {mean})"),
        confidence_signals=F.expr(
            f"if({discard}, map('rule_strength', _s_rule_strength), map({pairs}))"
        ),
    )
