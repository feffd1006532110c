"""Checks of a position's row, as boolean Columns and flags. Names in arguments default to the fact table's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a row must have one of to be more than a total.
DETAILS = ["principal_amount", "amortized_cost", "maturity_date", "reference_rate", "cash_rate", "pik_rate", "spread", "shares", "cost", "acquisition_date"]
# Kinds that are not debt.
EQUITY = "equity|stock|warrant|common|preferred|units|partnership"
# Lines of a table that are no company.
NOT_A_COMPANY = r"(?i)^\s*(sub)?total\b|^\s*net (assets|liabilities)|^\s*cash( and cash equivalents)?\s*$|treasur(y|ies)|money market|^\s*(portfolio )?company\s*$|^\s*(investments?|industry|type)\s*$|^[\d\s.,$%()—–-]+$"


def _text(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name), F.lit("")))


def is_company(name: str = "company_name") -> Column:
    return (_text(name) != "") & ~_text(name).rlike(NOT_A_COMPANY)


def is_poor(value: str = "fair_value", details: Sequence[str] = tuple(DETAILS), marks: str = "data_quality_flags", mark: str = "dspy") -> Column:
    """A total that an extractor took for a position: a value, none of the details, and marks that begin with the extractor's."""
    some = F.lit(False)
    for c in details:
        some = some | (_text(c) != "")
    return (_text(value) != "") & ~some & _text(marks).startswith(mark)


def is_empty(values: Sequence[str] = ("fair_value", "cost"), rates: Sequence[str] = ("cash_rate", "spread", "reference_rate"), principal: str = "principal_amount") -> Column:
    """Neither a value nor both a rate and a principal."""
    some = lambda cols: sum((F.when(_text(c) != "", 1).otherwise(0) for c in cols), F.lit(0)) > 0
    return ~(some(values) | (some(rates) & (_text(principal) != "")))


def is_debt(kind: str = "investment_type") -> Column:
    return ~F.lower(_text(kind)).rlike(EQUITY)


def is_artifact(name: str = "company_name") -> Column:
    """Commentary and markup in place of a name."""
    return _text(name).rlike(r"```|\|.*\||(?i)undrawn\s*=|^(here (is|are)|note:|based on|the table)")


def sane_percent(pct: Column) -> Column:
    return F.when(F.abs(pct) <= 50, pct)


def sane_value(value: Column) -> Column:
    return F.when(value >= -1000, value)


def flags(principal: Column, cost: Column, value: Column, name: Column, kind: Column) -> Column:
    """Names of what looks wrong: a cost or value under a twentieth of a size of at least 1000; kinds that the name tells."""
    size = F.when(principal > 0, principal).when(value > 0, value)
    held = F.when(principal > 0, principal).when(cost > 0, cost)
    low, of = F.lower(F.coalesce(name, F.lit(""))), F.lower(F.coalesce(kind, F.lit("")))
    hint = lambda word, known: low.contains(word) & ~of.contains(known)
    return F.array_compact(
        F.array(
            F.when((cost > 0) & (size >= 1000) & (cost < 0.05 * size), "cost_suspicious_vs_size"),
            F.when((value > 0) & (held >= 1000) & (value < 0.05 * held), "fair_value_suspicious_vs_size"),
            F.when(hint("revolver", "revolver"), "type_hint_revolver_from_name"),
            F.when(hint("delayed draw", "delayed draw"), "type_hint_delayed_draw_from_name"),
            F.when(hint("preferred equity", "preferred"), "type_hint_pref_equity_from_name"),
            F.when(hint("corporate", "corporate"), "type_hint_corporate_from_name"),
        )
    )


def merge_flags(has: Column, new: Column) -> Column:
    """The flags of a cell and new ones, as a sorted set in one cell."""
    old = F.filter(F.transform(F.split(F.coalesce(has, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.array_sort(F.array_union(old, new)), "|")


def unit_scale(text: Column) -> Column:
    """1 for text that says thousands, 1000 for millions; thousands where neither or both are said."""
    low = F.lower(text)
    return F.when(low.rlike(r"in thousands|\(000"), 1.0).when(low.rlike(r"in millions"), 1000.0).otherwise(1.0)


def row_kind(cells: Column) -> Column:
    """Of a schedule's row (array of cells): blank, total, section, company, values or continued."""
    filled = F.filter(cells, lambda x: F.trim(F.coalesce(x, F.lit(""))) != "")
    first = F.try_element_at(filled, F.lit(1))
    numbers = F.size(F.filter(filled, lambda x: F.trim(x).rlike(r"^[$(\d][\d,.$()\s]*%?$")))
    led = F.trim(F.coalesce(F.try_element_at(cells, F.lit(1)), F.lit(""))) != ""
    return (
        F.when(F.size(filled) == 0, "blank")
        .when(first.rlike(r"(?i)^\s*(sub)?total\b"), "total")
        .when((F.size(filled) == 1) | (first.rlike(r"[-–—]\s*[\d.]+\s*%\s*$") & (numbers == 0)), "section")
        .when(led & (numbers > 0), "company")
        .when(numbers == F.size(filled), "values")
        .otherwise("continued")
    )
