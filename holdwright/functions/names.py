"""Company names of schedule rows: what is no part of the name goes, legal forms get one spelling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rows, text, vocab

# Words of instruments, as they follow a name or come before it: (pattern, standard type).
INSTRUMENTS = [
    (r"delayed\s+draw(\s+term\s+loan)?|ddtl", "Delayed Draw"),
    (r"revolv(er|ing(\s+(credit\s+)?(loan|facility))?)", "Revolver"),
    (r"(first|1st)\s+lien(\s+(senior\s+secured\s+)?(term\s+)?(loan|debt|notes?))?", "First Lien"),
    (r"(second|2nd)\s+lien(\s+(senior\s+secured\s+)?(term\s+)?(loan|debt|notes?))?", "Second Lien"),
    (r"senior\s+secured(\s+(term\s+)?(loan|debt|notes?))?|term\s+loan(\s+[a-d])?", "First Lien"),
    (r"(senior\s+)?unsecured(\s+(term\s+)?(loan|debt|notes?))?", "Unsecured Debt"),
    (r"subordinated(\s+(debt|loan|notes?))?|mezzanine(\s+(debt|loan))?", "Subordinated Debt"),
    (r"warrants?", "Warrants"),
    (r"preferred\s+(equity|stock|units?|shares?)", "Preferred Equity"),
    (r"common\s+(equity|stock|units?|shares?)", "Common Equity"),
    (r"(lp|llc|partnership|membership|member)\s+interests?", "Partnership Interest"),
]
ANY_INSTRUMENT = "|".join(p for p, _ in INSTRUMENTS)
# Legal forms, each by the spellings that become it, in order: (pattern, form).
FORMS = [
    (r"(?i)\bL\.?\s*L\.?\s*C\b\.?", "LLC"),
    (r"(?i)\b(Incorporated\b|Inc\b)\.?", "Inc."),
    (r"(?i)\b(Corporation\b|Corp\b)\.?", "Corp."),
    (r"(?i)\b(Limited\s+Partnership|L\.?\s*P)\b\.?", "LP"),
    (r"(?i)\b(Limited\s*$|Ltd\b\.?)", "Ltd."),
]
# A legal form with more behind it: what follows is a class or a unit, not the name.
AFTER_FORM = r"(?i)^(.*\b(?:LLC|Inc\.|Corp\.|LP|Ltd\.|plc))\s+.+$"
# A figure of a rate, a floor or a date at the end of a name.
FIGURES = r"(?i)\s+(?:(?:sofr|libor|prime|s|l|p|e)\s*\+\s*[\d.]+%?|[\d.]+\s*%(?:\s*(?:libor|sofr)?\s*floor|\s*pik|\s*cash)?|\d{1,2}/(?:\d{1,2}/)?\d{2,4}|(?:due|maturity)\s+[\d/]+)\s*$"


def instrument_suffix(name: Column) -> Column:
    """struct(name, type) of ``Name - Instrument``, ``Name, Instrument`` or ``Name (Instrument)``; type is null where there is none."""
    behind = rf"(?i)\s*(?:[-–—,]\s*(?:{ANY_INSTRUMENT})|\(\s*(?:{ANY_INSTRUMENT})\s*\))\s*$"

    def read(name, found):
        tail = F.regexp_replace(found, r"^[\s,(–—-]+|[\s)]+$", "")
        kind = lambda t: F.when(t != "", text.first_match(F.lower(t), [(label, f"^({p})$") for p, label in INSTRUMENTS]))
        return F.struct(F.when(found == "", name).otherwise(F.regexp_replace(name, behind, "")).alias("name"), F.when(found != "", text.let(tail, kind)).alias("type"))

    # Most names have none of the marks before an instrument.
    marked = lambda name: text.holds(name, [[["-", "–", "—", ",", "("]]])
    return text.let(name, lambda name: text.let(F.when(marked(name), F.regexp_extract(name, behind, 0)).otherwise(""), lambda found: read(name, found)))


def clean_company(name: Column, rounds: int = 3) -> Column:
    """struct(name, industry): the name without section prefixes, figures, instruments, footnotes and
    classes of units; blank where the cell names no company. industry: what the name itself tells, or null.

    Suffixes may stand in a row; each round takes one figure and one instrument away.
    """

    def bare(t: Column) -> Column:
        warrant = F.regexp_extract(t, r"^Warrant Investments and .+? and (.+)$", 1)
        t = F.when(t.startswith("Warrant Investments and "), warrant).otherwise(t)
        return F.regexp_replace(t, rf"(?i)^Investments in (?:Non-)?(?:Controll?ed|Affiliated)[,/\w\s-]*?(?:Companies|Investments|Company)\s*(?:(?:{ANY_INSTRUMENT})\s+)?", "")

    def cleaned(t: Column) -> Column:
        t = F.regexp_replace(t, rf"(?i)^(?:{ANY_INSTRUMENT})\s*[-–—]\s*", "")
        for _ in range(rounds):
            t = instrument_suffix(F.regexp_replace(t, FIGURES, ""))["name"]
        t = F.regexp_replace(F.regexp_replace(t, r"\s*[-–—]\s*$", ""), r"(\s*\(\d+\))+\s*$", "")
        t = F.trim(F.regexp_replace(t, r"\s*\([^)]+\)\s*$", ""))
        t = reduce(lambda c, f: F.regexp_replace(c, f[0], f[1]), FORMS, t)
        return F.trim(F.regexp_replace(F.regexp_replace(t, AFTER_FORM, "$1"), r"\s+", " "))

    def told(t: Column) -> Column:
        plain = lambda x: F.struct(F.when(t.rlike(rows.NOT_A_COMPANY), "").otherwise(x).alias("name"), F.when(F.lower(x).contains("aircrew"), "Aerospace & Defense").alias("industry"))
        return text.let(cleaned(t), plain)

    # Each step is worked out once; written out, a name's rules would stand in the plan many times over.
    return text.let(text.let(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"\s+", " ")), bare), told)


def industry_of(own: Column, of_name: Column, name: Column) -> Column:
    """A row's sector: its own; else the one its name was found to tell; else by words of the name, if these are a sector's."""
    labels = list(vocab.SECTOR_WORDS)
    once = F.struct(text.standard_sector(own).alias("own"), text.sector(name).alias("by_word"), text.standard_sector(of_name).alias("of_name"))

    def choose(x: Column) -> Column:
        told = F.when(of_name.isNotNull(), x["of_name"]).when(x["by_word"].isin(labels), x["by_word"])
        return F.when(x["own"].isin("", "Other"), F.coalesce(F.when(told != "", told), x["own"])).otherwise(x["own"])

    return text.let(once, choose)


def cross_source_key(name: Column) -> Column:
    """A key under which two sources' spellings of a company meet: no legal form, instrument words or trailing index."""
    t = F.regexp_replace(F.lower(clean_company(name)["name"]), r"[^a-z0-9 ]+", " ")
    t = F.regexp_replace(text.without_legal_form(F.trim(t)), r"\s+\d{1,2}$", "")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def rate_token(c: Column) -> Column:
    """A rate's name for comparison: ``3-month SOFR`` and ``3 month sofr rate`` are ``3m sofr``."""
    t = F.regexp_replace(F.lower(F.trim(c)), r"(\d+)[\s-]month\s+", "$1m ")
    return F.trim(F.regexp_replace(t, r"\s+(rate|index|benchmark|floor)$", ""))


def is_rate_token(c: Column, names: Sequence[str] = tuple(vocab.RATE_TOKENS)) -> Column:
    """Whether a cell is a rate's name, as it stands or for comparison, or a tenor before one of the commonest."""
    t, short = F.lower(F.trim(c)), rate_token(c)
    tenor = r"^\d+m?\s*(sofr|libor|l)$"
    return F.coalesce(t.isin(*names) | short.isin(*names) | t.rlike(tenor) | short.rlike(tenor), F.lit(False))
