"""Durations, rounding and bands."""

from __future__ import annotations

from chatledger import rules as R
from chatledger.functions.text import quoted


def round3(x: str) -> str:
    """Round a non-negative double to 3 decimals the way a correctly rounding
    language does: to the nearest thousandth of the *binary* value, an exact tie
    to the even one. Spark's ``round``/``bround`` look at the shortest decimal
    text instead and differ on ties.

    ``x`` is split into a 26-bit head and the rest, so both products with 1000
    are exact and the sign of ``excess`` is the true side of the tie.
    """
    scaled = f"({x} * 134217729D)"
    head = f"({scaled} - ({scaled} - {x}))"
    low = f"floor({x} * 1000D)"
    excess = f"(({head} * 1000D - ({low} + 0.5D)) + ({x} - {head}) * 1000D)"
    return (
        f"((CASE WHEN {excess} > 0 OR ({excess} = 0 AND {low} % 2 = 1) THEN {low} + 1"
        f" ELSE {low} END) / 1000D)"
    )


def micros_between(start: str, end: str) -> str:
    """Exact difference of two zone-less times. Subtracting them never goes through
    the session time zone, unlike ``timestampdiff``."""
    return f"CAST(CAST({end} - {start} AS DECIMAL(18, 6)) * 1000000 AS BIGINT)"


def minutes_unrounded(start: str, end: str, parts: str | None = None) -> str:
    """Minutes from ``start`` to ``end``, divided into ``parts`` if given."""
    divided = f" / CAST({parts} AS DOUBLE)" if parts else ""
    return f"(CAST({micros_between(start, end)} AS DOUBLE) / 1000000D{divided} / 60D)"


def minutes_between(start: str, end: str) -> str:
    """minutes with 3 decimals; null when either time is missing."""
    return round3(minutes_unrounded(start, end))


def mean_gap_unrounded(first: str, last: str, count: str) -> str:
    """A5: mean gap of ``count`` ordered times. The gaps telescope to last - first."""
    return f"CASE WHEN {count} >= 2 THEN {minutes_unrounded(first, last, f'({count} - 1)')} END"


def _band(value: str, bands, result) -> str:
    branches = " ".join(
        f"WHEN {value} IS NOT NULL THEN {result(place, label)}"
        if top is None
        else f"WHEN {value} <= {top} THEN {result(place, label)}"
        for place, (top, label) in enumerate(bands, start=1)
    )
    return f"CASE {branches} END"


def engagement_score(mean_gap: str) -> str:
    """100 / 80 / 50 / 20 by mean gap."""
    return _band(mean_gap, R.SCORE_BANDS, lambda _, score: score)


def response_band(value: str) -> str:
    """F8: label of the first-response time."""
    return _band(value, R.RESPONSE_BANDS, lambda _, label: quoted(label))


def response_band_order(value: str) -> str:
    return _band(value, R.RESPONSE_BANDS, lambda place, _: place)


def pace_band(value: str) -> str:
    """label of the conversation pace."""
    return _band(value, R.PACE_BANDS, lambda _, label: quoted(label))


def pace_band_order(value: str) -> str:
    return _band(value, R.PACE_BANDS, lambda place, _: place)
