"""Names, labels and buckets, as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab

LEGAL = r"(\s*,?\s*\b(incorporated|inc|corporation|corp|company|co|limited|ltd|llc|l\.l\.c|lp|l\.p|llp|plc|holdings?|group)\b\.?)+$"


def first_match(c: Column, rules: Iterable[tuple[str, str]], otherwise: Column | None = None) -> Column:
    """The label of the first rule whose pattern is found in c; ``otherwise`` (null) if none is."""
    out = None
    for label, pattern in rules:
        out = F.when(c.rlike(pattern), label) if out is None else out.when(c.rlike(pattern), label)
    return out.otherwise(otherwise)


def let(value: Column, f):
    """f of a value that is worked out once."""
    return F.get(F.transform(F.array(value), f), 0)


def holds(c: Column, lines: Iterable[Iterable[Iterable[str]]]) -> Column:
    """Whether c holds, for one of the lines, a phrase of every group in it."""
    out = F.lit(False)
    for groups in lines:
        every = F.lit(True)
        for phrases in groups:
            some = F.lit(False)
            for p in phrases:
                some = some | F.contains(c, F.lit(p))
            every = every & some
        out = out | every
    return out


def blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def instrument_type(c: Column) -> Column:
    """The standard instrument type; blank stays blank."""
    return F.when(blank(c), "").otherwise(first_match(F.lower(F.trim(c)), vocab.TYPE_RULES, F.lit("Other")))


def _lookup(key: Column, table: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def reference_rate(c: Column) -> Column:
    """The standard rate name: taxonomy members after ``#`` by table (unknown: blank), spellings by
    table without tenor, ``N/A`` for none, else as given."""
    low = F.lower(F.trim(c))
    bare = F.regexp_replace(low, r"[+ ]", "")
    name = F.coalesce(_lookup(bare, vocab.RATE_NAMES), _lookup(F.element_at(F.split(bare, r"\("), 1), vocab.RATE_NAMES))
    member = F.coalesce(_lookup(F.lower(F.substring_index(c, "#", -1)), vocab.RATE_MEMBERS), F.lit(""))
    return (
        F.when(blank(c), "")
        .when(c.contains("#"), member)
        .otherwise(F.coalesce(name, F.when(low.isin("n/a", "na", "none", "-"), "N/A"), c))
    )


def clean_spread(c: Column) -> Column:
    """A spread cell without dates, rate names and not-available marks."""
    t = F.trim(c)
    bad = t.rlike(r"^\d{4}-\d{2}-\d{2}|^\d{1,2}/\d{4}") | F.upper(t).isin(vocab.NOT_SPREADS)
    return F.when(blank(c) | bad, "").otherwise(t)


def benchmark(c: Column) -> Column:
    """A position's benchmark by what the cell contains: null where none is given, ``Other`` for an unknown one."""
    up = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(up.isin(vocab.NO_BENCHMARK), None).otherwise(first_match(up, vocab.BENCHMARKS, F.lit("Other")))


def rate_type(benchmark_: Column) -> Column:
    return F.when(benchmark_.isNull(), "Not Reported").when(benchmark_.isin(vocab.FLOATING), "Floating").otherwise("Fixed")


def sector(c: Column, rules: Iterable[tuple[str, str]] = tuple(vocab.SECTOR_RULES)) -> Column:
    """The sector of an industry cell: what is no industry is blank, an unknown one stays as it is."""
    bare = F.trim(F.coalesce(c, F.lit("")))
    low = F.replace(F.lower(bare), F.lit("&amp;"), F.lit("&"))
    none = (F.length(bare) > vocab.INDUSTRY_LENGTH) | low.isin(["", *vocab.NO_INDUSTRY])
    for pattern in vocab.NOT_INDUSTRY:
        none = none | low.rlike(pattern)
    known = F.coalesce(first_match(low, [(x, p) for p, x in vocab.SECTOR_PREFIXES]), _lookup(low, vocab.SECTOR_NAMES))
    return F.when(none, "").otherwise(F.coalesce(known, first_match(low, rules, bare)))


def standard_sector(c: Column, rules: Iterable[tuple[str, str]] = tuple(vocab.SECTOR_RULES)) -> Column:
    """sector(), with ``Other`` for a cell that is no industry, blank for a blank one."""
    found = sector(c, rules)
    return F.when((found == "") & ~blank(c), "Other").otherwise(found)


def clean_industry(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(blank(c) | low.isin(vocab.NO_INDUSTRY) | low.rlike(r"^[\d.,$%()\s]+$"), "Not Reported").otherwise(F.trim(c))


def name_key(c: Column) -> Column:
    """A company's key: lower case, ``&`` as and, no punctuation, single spaces."""
    t = F.regexp_replace(F.replace(F.lower(c), F.lit("&"), F.lit(" and ")), r"[^a-z0-9 ]+", " ")
    return F.trim(F.regexp_replace(t, r" +", " "))


def without_legal_form(c: Column) -> Column:
    """The lower-cased name without its legal form, unless nothing else is left."""
    bare = F.trim(F.regexp_replace(F.lower(F.trim(c)), LEGAL, ""))
    return F.when(bare == "", F.lower(F.trim(c))).otherwise(bare)


def block_key(c: Column) -> Column:
    """The first word, lower-cased."""
    return F.element_at(F.split(F.lower(F.trim(c)), r"[\s,]+"), 1)


def stable_id(c: Column) -> Column:
    return F.concat(F.lit("co_"), F.substring(F.sha2(F.lower(F.trim(c)).cast("binary"), 256), 1, 12))


def camel_words(c: Column) -> Column:
    """``SeniorSecuredMember`` -> ``Senior Secured``."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"Member$", ""), r"([a-z])([A-Z])", "$1 $2"))


def rate_of_url(c: Column) -> Column:
    """The rate name of an enumeration's address or plain text: of what stands behind the last slash, in capitals, the first
    known name that it holds, else the taxonomy's name of the member, else itself; null for a blank one."""
    last = F.upper(F.trim(F.substring_index(F.trim(c), "/", -1)))
    named = first_match(last, [(n, n) for n in vocab.RATES_IN_URLS])
    member = _lookup(F.lower(F.substring_index(last, "#", -1)), vocab.RATE_MEMBERS)
    return F.coalesce(named, member, F.nullif(last, F.lit("")))


def tidy(c: Column) -> Column:
    """Plain spaces, dashes and quotes, squeezed; trailing footnotes like ``(1)(2)`` dropped."""
    t = F.translate(c, " –—‘’“”", " --''\"\"")
    plain = F.regexp_replace(t, r"\s{2,}|[^\S ]", " ")
    return F.trim(let(plain, lambda x: F.when(x.contains(")"), F.regexp_replace(x, r"(\s*\(\d{1,2}\))+\s*$", "")).otherwise(x)))


def strip_markup(html: Column) -> Column:
    """Text of HTML: scripts, styles and tags go, the common entities are read, white space is squeezed."""
    t = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&#160;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def plain_text(html: Column) -> Column:
    """strip_markup, with numbers and per cent signs that markup split joined again."""
    return F.regexp_replace(F.regexp_replace(strip_markup(html), r"(\d)\s*\.\s+(\d)", "$1.$2"), r"(\d)\s+%", "$1%")


def spread_bucket(x: Column) -> Column:
    b = vocab.SPREAD_BUCKETS
    return F.when(x < 3, b[0]).when(x < 4, b[1]).when(x < 5, b[2]).when(x < 6, b[3]).when(x < 7, b[4]).when(x.isNotNull(), b[5])


def age_bucket(years: Column) -> Column:
    b = vocab.AGE_BUCKETS
    return F.when(years < 1, b[0]).when(years < 2, b[1]).when(years < 3, b[2]).when(years < 4, b[3]).when(years < 5, b[4]).when(years.isNotNull(), b[5])


def wall_bucket(year: Column, first: int, last: int) -> Column:
    """``≤first``, each year between, ``last+``."""
    return F.when(year <= first, f"≤{first}").when(year >= last, f"{last}+").otherwise(year.cast("string"))


def maturity_bucket(year: Column, single_to: int) -> Column:
    """Years up to single_to on their own, then two years together, then the rest; beyond twelve more, on their own."""
    pair = f"{single_to + 1}–{single_to + 2}"
    return (
        F.when(year <= single_to, year.cast("string"))
        .when(year <= single_to + 2, pair)
        .when(year > single_to + 12, year.cast("string"))
        .when(year.isNotNull(), f"{single_to + 3}+")
    )
