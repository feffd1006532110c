"""Credit quality as filings tell it: shares on non-accrual, risk rating, how many borrowers.

The text is cut into sentences, and each sentence that names the thing is read as a row of tokens,
so a figure of another sentence or period is never taken.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

#: What is read of a sentence: percentages, and the measures that they are of.
TOKEN = r"(\d{1,2}(?:\.\d+)?\s*%|\bcost\b|\bfair value\b)"
#: No share on non-accrual is above this.
MOST = 40
# Numbers that are written out.
WORDS = {w: n for n, w in enumerate(["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve"], 1)}


def _shares(sentence: Column) -> Column:
    """array<struct<measure, pct>>: two percentages before two measures go with them in order; else a percentage goes with the measure after it, or before it."""
    tokens = F.transform(F.regexp_extract_all(F.lower(sentence), F.lit(TOKEN), 1), lambda x: F.regexp_replace(x, r"[\s%]+$", ""))
    return let(tokens, _paired)


def _paired(t: Column) -> Column:
    at = lambda i: F.coalesce(F.get(t, i), F.lit(""))
    figure = lambda x: x.rlike(r"^\d")
    measure = lambda x: x.isin("cost", "fair value")
    # The first of four tokens in a row that are two figures and two measures.
    first = F.get(F.filter(F.transform(t, lambda _, i: i), lambda i: figure(at(i)) & figure(at(i + 1)) & measure(at(i + 2)) & measure(at(i + 3))), F.lit(0))
    pair = lambda m, x: F.struct(m.alias("measure"), x.try_cast("double").alias("pct"))
    alone = F.transform(F.filter(F.transform(t, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda p: figure(p["x"])), lambda p: pair(F.when(measure(at(p["i"] + 1)), at(p["i"] + 1)).when(measure(at(p["i"] - 1)), at(p["i"] - 1)), p["x"]))
    return let(first, lambda row: F.when(row.isNotNull(), F.array(pair(at(row + 2), at(row)), pair(at(row + 3), at(row + 1)))).otherwise(alone))


def extract(text: Column) -> Column:
    """struct(cost_pct, fv_pct, count, risk_rating, confidence). A cost share below that of fair value is dropped as a misreading."""
    sentences = F.split(F.regexp_replace(text, r"\s+", " "), r"(?<=[a-z0-9%)][.;])\s+(?=[A-Z])")
    return let(F.transform(sentences, lambda s: F.lower(s)), lambda low: let(_read(low), _judged))


def _read(low: Column) -> Column:
    """struct(shares: struct(fv, cost, count), risk) as the sentences tell them."""
    pairs = [F.lit(x) for kv in WORDS.items() for x in kv]

    def shares(about: Column) -> Column:
        known = F.filter(F.flatten(F.transform(about, _shares)), lambda p: p["measure"].isNotNull() & (p["pct"] <= MOST))
        first = lambda k, m: F.get(F.filter(k, lambda p: p["measure"] == m), F.lit(0))["pct"]
        counted = F.filter(about, lambda s: s.rlike(r"\b(compan|issuer|investment|loan)\w* (was|were|are|is) (placed )?(on )?non-accrual"))
        number = F.regexp_extract(F.get(counted, F.lit(0)), r"\b(\d{1,3}|" + "|".join(WORDS) + r")\b(?! *%)[a-z -]*\b(?:compan|issuer|investment|loan)", 1)
        count = let(number, lambda n: F.coalesce(F.try_element_at(F.create_map(*pairs), n), n.try_cast("int")))
        return let(known, lambda k: F.struct(first(k, "fair value").alias("fv"), first(k, "cost").alias("cost"), count.alias("count")))

    about = F.filter(low, lambda s: s.contains("non-accrual") & ~s.rlike(r"(other than|excluding|excludes) (income from )?non-accrual"))
    rated = F.filter(low, lambda s: s.contains("average") & s.rlike(r"risk rating|grade"))
    risk = F.regexp_extract(F.get(rated, F.lit(0)), r"(?:rating|grade)\D*\b([1-5](?:\.\d+)?)\b", 1).try_cast("double")
    return F.struct(let(about, shares).alias("shares"), risk.alias("risk"))


def _judged(x: Column) -> Column:
    fv, risk, count = x["shares"]["fv"], x["risk"], x["shares"]["count"]
    cost = F.when(fv.isNull() | (x["shares"]["cost"] >= fv), x["shares"]["cost"])
    sure = F.when(cost.isNotNull() & fv.isNotNull(), "high").when(cost.isNotNull() | fv.isNotNull(), "medium").when(risk.isNotNull(), "low").otherwise("none")
    return F.struct(cost.alias("cost_pct"), fv.alias("fv_pct"), count.alias("count"), risk.alias("risk_rating"), sure.alias("confidence"))
