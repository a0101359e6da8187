"""Measures of a result row as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(x: Column, digits: int = 0) -> Column:
    """Half-even rounding; noise of sums beyond the ninth digit is removed first so that order can't flip a tie."""
    return F.bround(F.round(x, 9), digits)


def percent(part: Column, whole: Column) -> Column:
    """part of whole in percent, 0 where whole is 0 or null."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")) * 100, F.lit(0.0))


def margin(dem: Column, rep: Column) -> Column:
    """Votes by which REP leads; negative where DEM does."""
    return rep - dem


def margin_pct(dem: Column, rep: Column, total: Column) -> Column:
    return percent(rep - dem, total)


def winner(dem: Column, rep: Column, total: Column | None = None) -> Column:
    """REP, DEM or TIE; N/A where total is given and 0."""
    who = F.when(rep > dem, "REP").when(dem > rep, "DEM").otherwise("TIE")
    return who if total is None else F.when(total == 0, "N/A").otherwise(who)


#: Lower cuts of the absolute margin in percent, and the map's colours for REP and DEM above each.
COLOR_STEPS = (
    (40.0, "#67000d", "#08306b"),
    (30.0, "#a50f15", "#08519c"),
    (20.0, "#cb181d", "#3182bd"),
    (10.0, "#ef3b2c", "#6baed6"),
    (5.5, "#fb6a4a", "#9ecae1"),
    (1.0, "#fcae91", "#c6dbef"),
    (0.5, "#fee8c8", "#e1f5fe"),
)
EVEN_COLOR = "#f7f7f7"


def competitiveness_color(pct: Column, tilt: bool = True) -> Column:
    """The map colour of a signed margin; tilt=False has no step between 0.5 and 1."""
    steps = COLOR_STEPS if tilt else COLOR_STEPS[:-1]
    color = F.when(F.abs(pct) < steps[-1][0], EVEN_COLOR)
    for cut, rep, dem in steps:
        color = color.when(F.abs(pct) >= cut, F.when(pct > 0, rep).otherwise(dem))
    return color


#: Names of margins by their lower cut in percent.
TIERS = ((40.0, "Annihilation"), (30.0, "Dominant"), (20.0, "Stronghold"), (10.0, "Safe"), (5.5, "Likely"), (1.0, "Lean"), (0.5, "Tilt"))
TIERS_SHOWN = TIERS[2:]


def margin_tier(pct: Column, tiers: tuple[tuple[float, str], ...] = TIERS) -> Column:
    name = F.when(F.abs(pct) >= tiers[0][0], tiers[0][1])
    for cut, label in tiers[1:]:
        name = name.when(F.abs(pct) >= cut, label)
    return name.otherwise("Tossup")


def share(part: Column, total: Column, digits: int = 6) -> Column:
    return F.round(F.coalesce(F.try_divide(part.cast("double"), total.cast("double")), F.lit(0.0)), digits)


def coverage_pct(matched: Column, total: Column) -> Column:
    return F.round(percent(matched, total), 2)


def accuracy_pct(actual: list[Column], expected: list[Column]) -> Column:
    """Mean over the pairs of 100 less the difference in percent, not under 0."""
    each = [F.greatest(F.lit(0.0), 100 - percent(F.abs(a - e), e)) for a, e in zip(actual, expected, strict=True)]
    return F.round(sum(each[1:], each[0]) / len(each), 4)


def within(actual: list[Column], expected: list[Column], votes: int = 2) -> Column:
    checks = [F.abs(a - e) <= votes for a, e in zip(actual, expected, strict=True)]
    out = checks[0]
    for c in checks[1:]:
        out = out & c
    return out


def largest_remainder(total: Column, shares: list[Column]) -> list[Column]:
    """Whole parts of total by shares: floors, then one more for the largest fractions, earlier first on ties.

    The fractions' ranks are counted pair by pair, so no window or shuffle is needed.
    """
    exact = [F.round(total * s, 9) for s in shares]
    floors = [F.floor(e).cast("long") for e in exact]
    fractions = [F.round(e - f, 9) for e, f in zip(exact, floors, strict=True)]
    left = total.cast("long") - sum(floors[1:], floors[0])
    out = []
    for i, mine in enumerate(fractions):
        ahead = sum(((other > mine) if j > i else (other >= mine)).cast("int") for j, other in enumerate(fractions) if j != i)
        out.append(floors[i] + (ahead < left).cast("long"))
    return out


def split_pair(value: Column, second_share: Column) -> tuple[Column, Column]:
    """Two whole parts whose sum is value."""
    second = half_even(value * second_share).cast("long")
    return value.cast("long") - second, second


def with_measures(df, dem: str = "dem_votes", rep: str = "rep_votes", other: str = "other_votes"):
    """Adds total_votes, margin, margin_pct (2 digits), winner and color to a row of three vote columns."""
    total = F.col(dem) + F.col(rep) + F.col(other)
    raw = margin_pct(F.col(dem), F.col(rep), total)
    return df.withColumns({"total_votes": total, "margin": margin(F.col(dem), F.col(rep)), "margin_pct": F.round(raw, 2), "winner": winner(F.col(dem), F.col(rep)), "color": competitiveness_color(raw)})
