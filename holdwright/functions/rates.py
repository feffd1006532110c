"""Combined rate cells, such as ``SOFR + 4.25% / 2% PIK`` or ``E+ 650, 0.75% floor``, read token by token."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, reference_rate

# Words that name a rate before a sign.
NAMES = ["sofr", "sf", "s", "libor", "l", "euribor", "e", "prime", "p", "sonia", "cdor", "corra", "bbsy", "rate"]
# Words beside a number that say what it is.
LOWEST, IN_KIND = ["floor", "minimum"], "pik"
#: A figure, with its sign of per cent; a sign; or a word.
TOKEN = r"(\d+(?:\.\d+)?(?:\s*%)?|[+-]|[a-z]+)"


def _tokens(cell: Column) -> Column:
    plain = F.regexp_replace(F.lower(F.coalesce(cell, F.lit(""))), r"\(\s*[a-z]\s*\)", " ")
    return F.regexp_extract_all(F.regexp_replace(plain, r"(\d)-(?=[a-z])", "$1 "), F.lit(TOKEN), 1)


def parse(cell: Column) -> Column:
    """struct(reference, spread, floor, pik, fixed), rates in per cent, null where not told.

    Each figure has the role that its neighbours give it: after a name and a sign it is the spread (per cent if it says
    so or is under 20, else basis points); beside floor or minimum, with a name or ``of`` or ``rate`` between at most, the
    floor; before PIK the part paid in kind. A percentage at the head that has none of these roles is a fixed rate.
    """
    return let(_tokens(cell), lambda t: let(_marked(t), lambda marked: let(_by_role(marked), lambda one: _told(t, one))))


def _at(t: Column, i: Column) -> Column:
    return F.coalesce(F.get(t, i), F.lit(""))


def _value(m: Column) -> Column:
    return F.regexp_replace(m["x"], r"[\s%]", "").try_cast("double")


def _marked(t: Column) -> Column:
    """array<struct<x, i, role>> of the tokens."""
    at = lambda i: _at(t, i)

    def role(x: Column, i: Column) -> Column:
        before, after = at(i - 1), at(i + 1)
        spread = before.isin("+", "-") & at(i - 2).isin(NAMES)
        floor = after.isin(LOWEST) | (after.isin(NAMES) & at(i + 2).isin(LOWEST)) | before.isin(LOWEST) | (before.isin("of", "rate") & (at(i - 2).isin(LOWEST) | at(i - 3).isin(LOWEST)))
        return F.when(spread, "spread").when(after == IN_KIND, "pik").when(floor, "floor").when((i == 0) & x.endswith("%"), "fixed").otherwise("")

    return F.transform(t, lambda x, i: F.struct(x.alias("x"), i.alias("i"), F.when(x.rlike(r"^\d"), role(x, i)).otherwise("").alias("role")))


def _by_role(marked: Column) -> Column:
    """struct of the first figure with each role: the spread as its place, sign of per cent and size, others as numbers."""
    one = lambda name: F.get(F.filter(marked, lambda m: m["role"] == name), F.lit(0))
    spread = let(one("spread"), lambda s: F.when(s.isNotNull(), F.struct(s["i"].alias("i"), s["x"].endswith("%").alias("percent"), _value(s).alias("value"))))
    return F.struct(spread.alias("s"), *[_value(one(name)).alias(name) for name in ("floor", "pik", "fixed")])


def _told(t: Column, one: Column) -> Column:
    s = one["s"]
    size = F.when(s["percent"] | (s["value"] < 20), s["value"]).otherwise(s["value"] / 100)
    name = _at(t, s["i"] - 2)
    named = F.when(name == "rate", F.concat_ws(" ", _at(t, s["i"] - 3), name)).when(name == "e", "euribor").otherwise(name)
    return F.struct(
        F.when(s.isNotNull(), let(named, reference_rate)).alias("reference"),
        F.when(_at(t, s["i"] - 1) == "-", -size).otherwise(size).alias("spread"),
        one["floor"].alias("floor"),
        F.when(one["pik"] != 0, one["pik"]).alias("pik"),
        F.when(s.isNull(), one["fixed"]).alias("fixed"),
    )


def of_terms(cell: Column) -> Column:
    """A rate told in words, in per cent as ``7.5%``: a figure with the role fixed (behind fixed rate, interest or not between),
    else one before cash, else the first percentage between 0 and 50 where neither a benchmark nor a sum is told; else blank."""
    return let(_tokens(cell), lambda t: let(_terms(t), lambda marked: let(_rate_of(t, marked), _shown)))


def _terms(t: Column) -> Column:
    at = lambda i: _at(t, i)

    def role(x: Column, i: Column) -> Column:
        fixed = (at(i - 1) == "rate") & ((at(i - 2) == "fixed") | ((at(i - 2) == "interest") & (at(i - 3) == "fixed")))
        return F.when(fixed, "fixed").when(at(i + 1) == "cash", "cash").when(x.endswith("%"), "alone")

    return F.transform(t, lambda x, i: F.struct(x.alias("x"), F.when(x.rlike(r"^\d"), role(x, i)).alias("role")))


def _rate_of(t: Column, marked: Column) -> Column:
    one = lambda *names: _value(F.get(F.filter(marked, lambda m: m["role"].isin(*names)), F.lit(0)))
    summed = F.exists(t, lambda x: x.isin("+", "sofr", "libor"))
    alone = let(F.when(~summed, one("fixed", "cash", "alone")), lambda x: F.when((x > 0) & (x < 50), x))
    return F.coalesce(one("fixed"), one("cash"), alone)


def _shown(x: Column) -> Column:
    shown = F.regexp_replace(F.format_string("%.2f", x), r"\.?0+$", "")
    return F.when(x.isNull(), "").otherwise(F.concat(shown, F.lit("%")))
