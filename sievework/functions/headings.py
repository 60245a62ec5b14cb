"""Column functions over lists of subject headings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Headings that make a record a candidate, and headings that speak against it.
KEEP_HEADINGS = ("Consciousness", "Awareness", "Consciousness Disorders")
EXCLUDE_HEADINGS = ("Religion", "Spirituality", "Pastoral Care")


def _main_heading(term: Column, strip_star: bool) -> Column:
    head = F.substring_index(term, "/", 1)
    return F.replace(head, F.lit("*"), F.lit("")) if strip_star else head


def _any_term(terms: Column | str, test) -> Column:
    return F.coalesce(F.exists(terms, test), F.lit(False)).cast("int")


def has_heading(terms: Column | str, targets: Sequence[str] = KEEP_HEADINGS, strip_star: bool = False) -> Column:
    """1 if the part before the first "/" of any term is one of ``targets``.

    The comparison is exact, so a heading with a leading star does not count
    unless ``strip_star`` is set.
    """
    return _any_term(terms, lambda t: _main_heading(t, strip_star).isin(*targets))


def has_heading_major(terms: Column | str, targets: Sequence[str] = KEEP_HEADINGS, strip_star: bool = False) -> Column:
    """As :func:`has_heading`, for terms that carry a star anywhere."""
    return _any_term(terms, lambda t: t.contains("*") & _main_heading(t, strip_star).isin(*targets))


def n_heading(terms: Column | str) -> Column:
    return F.coalesce(F.array_size(terms), F.lit(0))
