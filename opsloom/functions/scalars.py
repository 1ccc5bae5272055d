"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts in order of priority, day first.
DATE_LAYOUTS = ("d/M/yyyy", "yyyy-M-d", "d.M.yyyy", "d-M-yyyy", "M/d/yyyy", "d/M/yy")

# Texts that stand for a missing entry.
NULL_TOKENS = ("", "None", "nan")

# Spelling variants of status, complexity, contract and absence type.
STATUS_LABELS = {
    "CLOTURE": "Clôturé", "cloture": "Clôturé", "Clôturé": "Clôturé", "Fermé": "Clôturé",
    "EN_COURS": "En cours", "En cours": "En cours", "Suspendu": "Suspendu",
}
COMPLEXITY_LABELS = {
    "Simple": "Simple", "simple": "Simple", "Moyen": "Moyen", "moyen": "Moyen",
    "Complexe": "Complexe", "COMPLEXE": "Complexe",
}
CONTRACT_LABELS = {
    "CDI": "CDI", "cdi": "CDI", "CDD": "CDD", "cdd": "CDD",
    "Intérimaire": "Intérimaire", "Interimaire": "Intérimaire", "INTERIMAIRE": "Intérimaire",
    "Alternant": "Alternant", "alternant": "Alternant",
    "Prestataire": "Prestataire", "PRESTATAIRE": "Prestataire", "Temps partiel": "Temps partiel",
}
ABSENCE_LABELS = {
    "CP": "Congé Payé", "Congé Payé": "Congé Payé", "CONGE_PAYE": "Congé Payé",
    "Maladie": "Maladie", "MALADIE": "Maladie", "RTT": "RTT", "rtt": "RTT",
    "Formation": "Formation", "FORMATION": "Formation", "Absent": "Absence non justifiée",
    "Semaine école": "Semaine école", "SEMAINE_ECOLE": "Semaine école", "Formation CFA": "Semaine école",
}
STATUS_DEFAULT, COMPLEXITY_DEFAULT = "Inconnu", "Non renseigné"
CONTRACT_DEFAULT, ABSENCE_DEFAULT = "Non renseigné", "Autre"

# Complexity rank and productivity share per contract.
COMPLEXITY_RANKS = {"Simple": 1, "Moyen": 2, "Complexe": 3, "Non renseigné": 2}
COMPLEXITY_RANK_DEFAULT = 2
CONTRACT_PRODUCTIVITY = {
    "CDI": 1.00, "Prestataire": 0.90, "CDD": 0.85, "Intérimaire": 0.75,
    "Temps partiel": 0.80, "Alternant": 0.60, "Non renseigné": 0.85,
}
CONTRACT_PRODUCTIVITY_DEFAULT = 0.85


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove white space of every kind at both ends (SQL trim only removes blanks)."""
    return F.regexp_replace(column(c), r"^\s+|\s+$", "")


def parse_mixed_date(c: str | Column) -> Column:
    """First layout that fits wins; two-digit years are 1969 to 2068."""
    def parsed(layout: str) -> Column:
        return F.to_date(F.try_to_timestamp(column(c), F.lit(layout)))

    short = parsed(DATE_LAYOUTS[-1])
    short = F.when(F.year(short) > 2068, F.add_months(short, -1200)).otherwise(short)
    return F.coalesce(*[parsed(layout) for layout in DATE_LAYOUTS[:-1]], short)


def null_token(c: str | Column) -> Column:
    return F.when(~column(c).isin(*NULL_TOKENS), column(c))


def mapped(c: str | Column, values: Mapping, default=None) -> Column:
    """Look a value up in a small fixed map; anything else gives the default."""
    pairs = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    found = F.try_element_at(pairs, column(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def normalised(c: str | Column, values: Mapping[str, str], default: str) -> Column:
    return F.coalesce(mapped(strip(c), values), F.lit(default))


def to_number(c: str | Column) -> Column:
    return column(c).try_cast("double")


def keep_between(c: str | Column, low=None, high=None) -> Column:
    """Null outside the closed range; null and NaN never pass a bound."""
    x = column(c)
    ok = F.lit(True)
    if low is not None:
        ok = ok & (x >= F.lit(low))
    if high is not None:
        ok = ok & (x <= F.lit(high))
    return F.when(ok & ~F.isnan(x.cast("double")), x)


def flag(condition: Column) -> Column:
    """1 or 0; an unknown condition counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def worktime_coeff(c: str | Column) -> Column:
    """Share of full time from "80%", "0.8", "plein", "partiel" or nothing."""
    text = F.replace(strip(c), F.lit("%"), F.lit(""))
    number = text.try_cast("double")
    return (
        F.when(column(c).isNull(), 1.0)
        .when(number > 1, number / 100).when(number.isNotNull(), number)
        .when(F.lower(text).contains("plein"), 1.0)
        .when(F.lower(text).contains("partiel"), 0.8).otherwise(1.0)
    )


def contract_active(end: str | Column, at: str | Column) -> Column:
    return F.when(column(end).isNull(), 1).otherwise(flag(column(end) >= column(at)))


def capped_count(c: str | Column) -> Column:
    """"3+" is 3; anything that is no number is 0."""
    return F.coalesce(F.replace(column(c), F.lit("+"), F.lit("")).try_cast("int"), F.lit(0))


def productivity(volume: str | Column, minutes: str | Column, cap: float = 25.0) -> Column:
    """Items per hour when both are positive; rates above the cap are unknown."""
    v, m = column(volume).cast("double"), column(minutes).cast("double")
    rate = F.when((v > 0) & (m > 0), v / (m / 60))
    return F.when(rate <= cap, rate)


def tenure_months(entered: str | Column, at: str | Column) -> Column:
    """Days / 30 to one decimal, halves to even; negative is unknown."""
    months = F.bround(F.datediff(column(at), column(entered)) / 30, 1)
    return F.when(months >= 0, months)


def event_end(start: str | Column, days: str | Column) -> Column:
    """Last day of an event: a missing duration is one day, at least one day."""
    length = F.greatest(F.coalesce(column(days), F.lit(1)), F.lit(1)).cast("int")
    return F.date_add(column(start), length - 1)


def cyclic(c: str | Column, period: int) -> tuple[Column, Column]:
    angle = column(c) * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def bin_right_closed(c: str | Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the interval (low, high] that holds the value; null outside all of them."""
    out = None
    for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True):
        inside = (column(c) > low) & (column(c) <= high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out
