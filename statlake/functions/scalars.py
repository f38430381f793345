"""Column expressions: typed parsing, scoring, JSON fields, labels, metrics."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

# Points per unit of each statistic.
SCORING_WEIGHTS = {
    "pass_yards": "0.04",
    "pass_touchdowns": "4",
    "interceptions": "-2",
    "rush_yards": "0.1",
    "rush_touchdowns": "6",
    "receptions": "1",
    "receiving_yards": "0.1",
    "receiving_touchdowns": "6",
    "fumbles_lost": "-2",
    "field_goals_made": "3",
    "extra_points_made": "1",
}
# Fixed value: statistics that count only in the per-reception variant.
RECEPTION_ONLY = ("receptions",)


def stat_decimal(text: Column) -> Column:
    """A stat string as DECIMAL(10,2); NULL, blank and ``--`` become 0."""
    return F.coalesce(text.try_cast("decimal(10,2)"), F.lit(0).cast("decimal(10,2)"))


def points(weights: dict[str, str], column=lambda stat: F.col(stat), exact: bool = True) -> Column:
    """Weighted sum of stat columns. ``exact`` keeps decimal arithmetic.

    One NULL term makes the sum NULL, so a caller's ``coalesce`` wraps the whole.
    """
    def weight(text: str) -> Column:
        return F.lit(Decimal(text)) if exact else F.lit(float(text))

    return reduce(add, [column(stat) * weight(w) for stat, w in weights.items()])


def standard_weights(weights: dict[str, str] = SCORING_WEIGHTS) -> dict[str, str]:
    return {k: v for k, v in weights.items() if k not in RECEPTION_ONLY}


def to_utc_ntz(text: Column) -> Column:
    """ISO text -> UTC wall-clock timestamp without zone; unreadable text -> NULL.

    Text with a zone is shifted to UTC; text without one is taken as UTC. The
    result does not depend on the session zone. Seconds may be missing.
    """
    text = F.regexp_replace(
        F.trim(text), r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(Z|[+-]\d{2}:?\d{2})?$", "$1:00$2")
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    shifted = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"),
        text.try_cast("timestamp").cast("timestamp_ntz"),
    )
    return F.when(zoned, shifted).otherwise(text.try_cast("timestamp_ntz"))


def json_number(json_text: Column, path: str, kind: str = "decimal(10,4)") -> Column:
    """A numeric JSON field; missing, null or unreadable -> NULL."""
    return F.get_json_object(json_text, path).try_cast(kind)


def data_version(season: Column, week: Column) -> Column:
    """``2025_w08`` style version label."""
    return F.concat(season.cast("string"), F.lit("_w"), F.lpad(week.cast("string"), 2, "0"))


def chunk_id(article: Column, n: Column) -> Column:
    return F.concat_ws("_", article.cast("string"), n.cast("string"))


def display_label(name: Column, ident: Column) -> Column:
    return F.concat(name, F.lit(" ("), ident.cast("string"), F.lit(")"))


def game_label(week: Column, game_date: Column) -> Column:
    """``Week n`` and ``MM/dd`` on two lines; a missing date leaves the second empty."""
    return F.concat(
        F.lit("Week "), week.cast("string"), F.lit("\n"),
        F.coalesce(F.date_format(game_date, "MM/dd"), F.lit("")),
    )


def first_non_empty(*texts: Column) -> Column:
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def normalise_label(col: Column, canonical: dict[str, str], default: str) -> Column:
    """Known labels map to their canonical form, everything else to ``default``."""
    lookup = F.create_map(*[F.lit(x) for pair in canonical.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, col), F.lit(default))
