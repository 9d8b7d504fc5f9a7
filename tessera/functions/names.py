"""Model-name parsing (C18-C20) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import terms


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def model_key(path, parts: int = 2) -> Column:
    """Last path component (trailing '/' ignored), first ``parts``
    '-'-separated pieces of it; ``parts <= 0`` keeps it whole."""
    last = F.element_at(F.split(F.regexp_replace(_c(path), "/+$", ""), "/"), -1)
    if parts <= 0:
        return last
    return F.array_join(F.slice(F.split(last, "-"), 1, parts), "-")


def family(model) -> Column:
    """family = first '-' piece."""
    return F.split(_c(model), "-").getItem(0)


def size_class(model) -> Column:
    """C19: 'small' / 'large' if contained in the name, else 'base'."""
    m = _c(model)
    return (F.when(m.contains("small"), "small").when(m.contains("large"), "large")
            .otherwise("base"))


def family_display(fam) -> Column:
    """Display name of a family; unknown families upper-cased."""
    mp = F.create_map(*[F.lit(x) for kv in terms.FAMILY_DISPLAY.items() for x in kv])
    return F.coalesce(F.try_element_at(mp, _c(fam)), F.upper(_c(fam)))


def display_name(model) -> Column:
    """C19 leaderboard form: '{Family}-{rest of the name}'."""
    parts = F.split(_c(model), "-")
    rest = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), "-")
    return F.concat(family_display(parts.getItem(0)), F.lit("-"), rest)


def step_index(model) -> Column:
    """C20: baseline -> 0, else the digits of the name as int, else 99."""
    m = _c(model)
    digits = F.regexp_replace(m, r"\D", "")
    return F.when(m == terms.BASELINE_MODEL, F.lit(0)).otherwise(
        F.coalesce(F.nullif(digits, F.lit("")).try_cast("int"), F.lit(99)))
