"""Schedules out of tables: the row of heads, columns without spacers, and rows as records with what they inherit.

Tables are those of ``sources.documents.html_tables`` (a cell over several columns followed by blanks): doc, idx, grid.
All windows lie within a document, whose rows came from one page.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names, parse, rates, text
from ..functions.text import let

# Phrases of heads by field, in the order in which fields are tried.
HEAD_PHRASES = {
    "company_name": ["portfolio company", "company name", "issuer", "borrower", "name", "investment (", "company/"],
    "investment_type": ["type of investment", "investment type", "instrument type", "security type"],
    "industry": ["industry", "sector", "business description"],
    "cash_rate": ["total rate", "cash rate", "cash interest", "interest rate", "coupon"],
    "pik_rate": ["pik rate", "pik", "payment-in-kind"],
    "reference_rate": ["reference rate and spread", "reference rate", "interest", "base rate", "index rate"],
    "spread": ["spread", "margin"],
    "acquisition_date": ["investment date", "acquisition date", "purchase date", "origination date", "acquisition"],
    "maturity_date": ["maturity date", "maturity", "due date"],
    "principal_amount": ["stated principal", "principal amount", "principal balance", "par/shares", "par", "principal", "face amount", "face value"],
    "amortized_cost": ["amortized cost", "cost basis", "book value"],
    "fair_value": ["fair value", "fair market value"],
    "percent_of_net_assets": ["% of net assets", "percent of net assets", "net assets %", "% net assets"],
    "cost": ["cost"],
    "commitment_limit": ["commitment limit", "total commitment", "commitment"],
    "undrawn_commitment": ["undrawn commitment", "undrawn", "unfunded"],
}
FIELDS = list(HEAD_PHRASES)
MONEY = ["principal_amount", "amortized_cost", "fair_value", "cost", "commitment_limit", "undrawn_commitment", "percent_of_net_assets"]
# Columns that hold money where a wide table doesn't say so.
MONEY_PLACES = {6: "principal_amount", 7: "amortized_cost", 8: "fair_value"}
# Kinds by words of a section's head, the first that it has.
SECTIONS = [
    ("First Lien", ["senior secured first lien debt", "first lien secured", "first lien senior secured"]),
    ("Second Lien", ["senior secured second lien", "second lien"]),
    ("Subordinated Debt", ["subordinated debt"]),
    ("Unsecured Debt", ["unsecured debt"]),
    ("Structured Note", ["collateralized securities and structured products", "structured product", "clo "]),
    ("Money Market Fund", ["short term investments", "money market"]),
    ("Preferred Equity", ["preferred equity"]),
    ("Common Equity", ["common equity"]),
    ("Partnership Interest", ["partnership interest"]),
    ("Revolver", ["revolver"]),
    ("Delayed Draw", ["delayed draw"]),
    ("Warrants", ["warrant"]),
]
# Sections that name no industry.
CATEGORIES = [
    "first lien/senior secured debt", "second lien/senior secured debt", "subordinated debt", "collateralized loan obligations", "joint ventures",
    "preferred stock and units", "common stock and membership units", "asset manager affiliates", "derivatives", "non-controlled affiliated investments",
    "non-control affiliated investments", "non-controlled/non-affiliate investments", "non-controlled non-affiliate investments", "first lien debt", "equity",
    "joint venture",
]
# Sections that name an industry, and the industry.
INDUSTRIES = {
    "aerospace & defense": "Aerospace & Defense", "automotive": "Automotive", "consumer & retail": "Consumer & Retail", "healthcare": "Healthcare",
    "software & technology": "Software & Technology", "financial services": "Financial Services", "business services": "Business Services",
    "industrials": "Industrials", "media & entertainment": "Media & Entertainment", "food & beverage": "Food & Beverage",
    "transportation & logistics": "Transportation & Logistics", "telecommunications": "Telecommunications", "energy": "Energy",
    "environmental services": "Environmental Services", "containers & packaging": "Containers & Packaging", "chemicals & materials": "Chemicals & Materials",
    "beverage food & tobacco": "Food & Beverage", "beverage, food & tobacco": "Food & Beverage", "capital equipment": "Industrials",
    "chemicals plastics & rubber": "Chemicals & Materials", "construction & building": "Industrials", "consumer goods: durable": "Consumer & Retail",
    "consumer goods: non-durable": "Consumer & Retail", "consumer goods: wholesale": "Consumer & Retail", "containers packaging & glass": "Containers & Packaging",
    "energy: electricity": "Energy", "energy: oil & gas": "Energy",
}
# What a summary with a percentage behind it begins with, or holds.
SUMMED = [
    "first lien", "second lien", "senior secured", "subordinated", "unsecured", "collateralized loan", "joint ventures", "preferred stock and units",
    "common stock and membership", "asset manager affiliates", "derivatives",
]
# Pieces of a name that make it a company's.
FORMS = ["llc", "inc.", "corp", "ltd", "lp", "llp", "holdings", "co.", "company"]
# Kinds of a record by pieces of what it says, the first that it has (a piece of a longer word counts).
RECORD_KINDS = [
    ("Common Equity", ["common stock"]), ("Revolver", [" - revolver"]), ("Delayed Draw", [" - delayed draw"]), ("Other Equity", ["equity interest"]),
    ("First Lien", ["first lien senior secured loan"]), ("Second Lien", ["second lien senior secured loan"]), ("Subordinated Debt", ["subordinated debt"]),
]
# Words that make a short first line of a table its section.
CONTEXT_WORDS = [
    "first lien", "second lien", "senior secured", "subordinated", "common equity", "preferred equity", "warrant", "mezzanine", "unsecured", "revolver",
    "delayed draw", "unitranche", "clo", "structured", "junior", "debt investment", "equity investment",
]
PERCENT_BEHIND = r"-\s*\d+\.?\d*\s*%?\s*$"


def has_any(c: Column, phrases: Sequence[str]) -> Column:
    out = F.contains(c, F.lit(phrases[0]))
    for p in phrases[1:]:
        out = out | F.contains(c, F.lit(p))
    return out


def least(phrases: Sequence[str]) -> list[str]:
    """The phrases that hold no other: text that holds any holds one of these."""
    return [p for p in dict.fromkeys(phrases) if not any(q != p and q in p for q in phrases)]


def part_of_any(c: Column, phrases: Sequence[str]) -> Column:
    """Whether a phrase holds c, which has no line breaks."""
    return F.contains(F.lit("\n".join(dict.fromkeys(phrases))), c)


def plain(c: Column) -> Column:
    # A single space needs no replacing.
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s{2,}|[^\S ]", " "))


def merged_heads(first: Column, second: Column) -> Column:
    """One head of each column out of two rows: the first, but the second where that is blank or a title of over 50 characters."""
    both = F.arrays_zip(first.alias("a"), second.alias("b"))

    def head(x):
        a, b = F.trim(F.coalesce(x["a"], F.lit(""))), F.trim(F.coalesce(x["b"], F.lit("")))
        return F.when((a == "") | ((b != "") & (F.length(a) > 50) & (F.length(b) <= 50)), b).otherwise(a)

    return F.transform(both, head)


def fields_of_heads(heads: Column, phrases: Mapping[str, Sequence[str]] = HEAD_PHRASES) -> Column:
    """map<field, place>: columns from the left, each with the first field that none before it has and one of whose phrases it holds, or is part of.

    In tables of nine columns or more with a company, MONEY_PLACES hold for columns and fields that are still free.
    """
    # A head that is a phrase itself, as most are, is looked up.
    fields = lambda p: [f for f, words in phrases.items() if any(w in p or p in w for w in words)]
    known = F.create_map(*[c for p in dict.fromkeys(p for words in phrases.values() for p in words) for c in (F.lit(p), F.array(*map(F.lit, fields(p))))])
    fits = lambda h, words: part_of_any(h, words) | has_any(h, least(words))
    found = lambda x: F.array_compact(F.array(*[F.when(fits(x, w), F.lit(f)) for f, w in phrases.items()]))
    able = lambda heads: F.transform(heads, lambda h: let(plain(h), lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.coalesce(F.try_element_at(known, x), found(x)))))
    one = lambda f, i: F.map_from_arrays(F.array(f), F.array(i))

    def step(done, x):
        free = F.filter(x["able"], lambda f: ~F.map_contains_key(done, f))
        return let(F.get(free, 0), lambda f: F.when(f.isNotNull(), F.map_concat(done, one(f, x["i"]))).otherwise(done))

    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
    taken = lambda heads: F.aggregate(F.transform(able(heads), lambda a, i: F.struct(a.alias("able"), i.alias("i"))), none, step)

    def placed(m, place, field):
        def add(m):
            free = ~F.map_contains_key(m, field) & ~F.array_contains(F.map_values(m), place)
            return F.when(free, F.map_concat(m, one(F.lit(field), F.lit(place)))).otherwise(m)

        return let(m, add)

    def read(heads):
        def whole(m):
            more = m
            for place, field in MONEY_PLACES.items():
                more = placed(more, place, field)
            return F.when((F.size(heads) >= 9) & F.map_contains_key(m, "company_name"), more).otherwise(m)

        return let(taken(heads), whole)

    # Heads, and what is found of them, are worked out once.
    return let(heads, read)


def with_heads(tables: DataFrame) -> DataFrame:
    """(doc, idx, r, row, at): the rows below each table's heads, and the columns of its fields. Tables without heads have none.

    Every row is tried: heads name the company, or three other fields beside a filled column without one, which then is
    the company's. A row of up to three filled cells is read together with the next; so is one without an industry, if the next has it.
    """
    filled = lambda a: F.size(F.filter(a, lambda x: F.trim(x) != ""))
    every = sorted({w for words in HEAD_PHRASES.values() for w in words})
    holding = lambda xs: F.exists(xs, lambda x: part_of_any(x, every)) | F.exists(xs, lambda x: has_any(x, least(every)))
    some = lambda head: let(F.filter(F.transform(head, plain), lambda x: x != ""), holding)

    def whole(head, m):
        free = F.filter(F.transform(head, lambda h, i: F.when((F.trim(h) != "") & ~F.array_contains(F.map_values(m), i), i)), lambda i: i.isNotNull())
        company = F.map_from_arrays(F.array(F.lit("company_name")), F.array(F.get(free, 0)))
        known = F.map_contains_key(m, "company_name")
        return F.when(known, m).when((F.size(m) >= 3) & (F.size(free) > 0), F.map_concat(m, company))

    def read(row, after, r):
        """The heads of a row: its place, the columns of fields, and whether the next row is one of heads too; null if it has none."""
        # Only rows that hold a phrase are read as heads.
        at = lambda head: F.when(some(head), let(fields_of_heads(head), lambda m: whole(head, m)))

        def with_more(at, sparse):
            # A second row of heads adds the fields that the first lacks, if the industry is among them.
            more = F.when(~sparse & ~F.map_contains_key(at, "industry") & after.isNotNull(), fields_of_heads(after))
            both = lambda m: F.when(F.map_contains_key(m, "industry"), F.map_concat(at, F.map_filter(m, lambda k, v: ~F.map_contains_key(at, k))))
            found = lambda m: F.struct(r.alias("r"), F.coalesce(m, at).alias("at"), (sparse | m.isNotNull()).cast("int").alias("two"))
            return F.when(at.isNotNull(), let(let(more, both), found))

        heads = lambda sparse: let(let(F.when(sparse, merged_heads(row, after)).otherwise(row), at), lambda at: with_more(at, sparse))
        return let((filled(row) <= 3) & after.isNotNull(), heads)

    # The rows below the first with heads are not tried.
    none = F.lit(None).cast("struct<r:int,at:map<string,int>,two:int>")
    places = F.transform("grid", lambda _, i: i)
    first = F.aggregate(places, none, lambda done, r: F.when(done.isNotNull(), done).otherwise(let(F.get("grid", r), lambda row: let(F.get("grid", r + 1), lambda after: read(row, after, r)))))
    # Heads are worked out once a table: a filter on them, or on what is exploded, would be moved below and work them out again.
    found = tables.select("doc", "idx", "grid", first.alias("__first"))
    found = found.select("doc", "idx", "__first", F.when(F.col("__first").isNotNull(), F.col("grid")).alias("grid"))
    rows = found.select("doc", "idx", "__first", F.posexplode_outer("grid").alias("r", "row"))
    return rows.filter(F.coalesce(F.col("r") > F.col("__first.r") + F.col("__first.two"), F.lit(False))).select("doc", "idx", "r", "row", F.col("__first.at").alias("at"))


def section_kind(cell: Column) -> Column:
    """The kind that a section's head tells (``Kind - 12.5%``, without a legal form); null for other cells."""

    def told(low):
        kind = F.when(low.rlike(r"(^|[^a-z])equity\s*$"), "Common Equity")
        out = None
        for label, words in SECTIONS:
            out = F.when(has_any(low, words), label) if out is None else out.when(has_any(low, words), label)
        return F.when(low.contains("%") & low.rlike(r"-\s*\d+\.?\d*\s*%") & ~has_any(low, FORMS), out.otherwise(kind))

    return F.when(F.length(cell) >= 5, let(plain(cell), told))


def _without_percent(c: Column) -> Column:
    return let(plain(c), lambda low: F.when(low.contains("-"), F.trim(F.regexp_replace(low, PERCENT_BEHIND, ""))).otherwise(low))


def industry_of_section(cell: Column) -> Column:
    """The industry that a section's head names; null for categories and other cells."""
    low = _without_percent(cell)
    pairs = [F.lit(x) for kv in INDUSTRIES.items() for x in kv]
    table = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(table, low), F.try_element_at(table, F.regexp_replace(low, r",\s*", " ")))


def kind_of_row(company: Column, bare: Column, detail: Column) -> Column:
    """section, summary, category, fragment, continued, data or other, of a row by its company's cell, the name without
    instruments, and whether it has a kind, a maturity or money."""
    def told(low):
        summary = (F.length(company) >= 5) & (
            (low.contains("-") & low.rlike(PERCENT_BEHIND) & (low.startswith("investments in ") | has_any(low, ["non-control", "non-affiliate"]) | low.rlike("^(" + "|".join(SUMMED) + ")"))) | (low.endswith("total") & low.rlike(r"\s+total$"))
        )
        category = (F.length(bare) >= 3) & (_without_percent(bare).isin(*CATEGORIES, *INDUSTRIES))
        fragment = (F.length(bare) <= 15) & F.trim(bare).rlike(r"^[A-Za-z]{1,4}\s+(Inc\.?|LLC\.?)$")
        no_data = (
            (F.length(company) < 2) | low.isin("total", "totals", "aggregate", "portfolio company", "company") | low.startswith("total ")
            | has_any(low, ["total investments", "liabilities in excess"]) | (low.contains("net assets") & low.contains("100"))
            | (has_any(low, ["-", "–"]) & low.rlike(r"^(equity|senior secured|subordinated|unsecured)\s*[-–]\s*\d"))
            | low.isin("senior secured first lien debt", "senior secured second lien debt", "subordinated debt", "unsecured debt")
            | company.rlike(r"^[\d\s.,$%\-]+$")
        )
        data = ~no_data & (has_any(low, FORMS) | company.rlike(r"^\p{Lu}"))
        return (
            F.when(section_kind(company).isNotNull(), "section").when(summary, "summary").when(category, "category").when(fragment, "fragment")
            .when((company == "") & detail, "continued").when((company != "") & data, "data").otherwise("other")
        )

    return let(plain(company), told)


def record_kind(told: Column) -> Column:
    """The kind of a record by what it says; as it says where no rule holds."""
    low = F.lower(told)
    out = F.when(low.contains("secured debt") & ~low.contains("second"), "First Lien")
    for label, words in RECORD_KINDS:
        out = out.when(has_any(low, words), label)
    return out.otherwise(told)


def reference_and_spread(cell: Column) -> Column:
    """struct(reference, spread) of one cell: the rate's name (the cell itself where none is known), the spread in per cent; figures right behind a letter and plus are basis points."""
    up = F.upper(F.trim(cell))
    known = F.when(has_any(up, ["SF+", "SOFR", "S+", " SF "]), "SOFR").when(has_any(up, ["L+", "LIBOR", " L "]), "LIBOR").when(has_any(up, ["PRIME", "P+"]), "Prime")
    known = known.when(up.contains("EURIBOR"), "Euribor").when(up.contains("SONIA"), "SONIA").otherwise(F.trim(F.replace(cell, F.lit(","), F.lit(" "))))
    points = F.regexp_extract(up, r"[SLP]\+\s*(\d{2,4})\b", 1).try_cast("int")
    percent = F.nullif(F.regexp_extract(cell, r"(\d+(?:\.\d+)?)\s*%", 1), F.lit(""))
    spread = F.when(points.between(10, 5000), F.format_string("%.2f%%", points / 100)).otherwise(F.concat(percent, F.lit("%")))
    return F.struct(F.nullif(known, F.lit("")).alias("reference"), spread.alias("spread"))


def records(tables: DataFrame) -> DataFrame:
    """A record for each position of the tables' rows: doc, idx, r and FIELDS, blanks as null, money as double, dates as ISO text.

    A section's head gives its kind to the rows below it in the table, an industry's name its industry to all rows below it
    in the document, a company its name to the rows without one right below it in the table. Sums, sections and pieces of names give no record.
    """
    cell = lambda f: F.trim(F.coalesce(F.try_element_at("row", F.try_element_at("at", F.lit(f)) + 1), F.lit("")))
    rows = with_heads(tables)
    known = rows.select("doc", "idx", "r", *[cell(f).alias(f) for f in FIELDS], *[F.map_contains_key("at", f).alias(f"__{f}") for f in ("cost", "amortized_cost")])
    known = known.withColumn("__bare", names.instrument_suffix(text.tidy(F.col("company_name"))))
    detail = (F.col("investment_type") != "") | (F.col("maturity_date") != "") | (F.col("principal_amount") != "") | (F.col("fair_value") != "")
    known = known.withColumn("__kind", kind_of_row(F.col("company_name"), F.col("__bare.name"), detail))
    full = lambda c: F.nullif(F.col(c), F.lit(""))
    words = lambda c: F.nullif(F.trim(F.replace(F.col(c), F.lit(","), F.lit(" "))), F.lit(""))
    rate = reference_and_spread(F.col("reference_rate"))
    cost = F.when(F.col("__cost"), F.col("cost")).otherwise(F.col("amortized_cost"))
    # What a row tells by itself is worked out where it is read, so that only this is dealt by document, once for both windows.
    is_ = lambda *kinds: F.col("__kind").isin(*kinds)
    own = {
        "investment_type": F.coalesce(F.when(is_("data"), F.col("__bare.type")), words("investment_type")), "industry": words("industry"),
        "cash_rate": words("cash_rate"), "pik_rate": words("pik_rate"), "reference_rate": rate["reference"], "spread": F.coalesce(words("spread"), rate["spread"]),
        "acquisition_date": parse.normalize_date(full("acquisition_date")), "maturity_date": parse.normalize_date(full("maturity_date")),
        **{f: parse.to_double(F.col(f)) for f in MONEY}, "cost": parse.to_double(cost),
    }
    told = known.select("doc", "idx", "r", "__kind",
        F.when(is_("section"), section_kind(F.col("company_name"))).alias("__section"), F.when(is_("data"), F.col("__bare.name")).alias("company_name"),
        F.when(is_("category"), industry_of_section(F.col("company_name"))).alias("__industry"), *[F.when(is_("data", "continued"), c).alias(f) for f, c in own.items()],
    ).repartition("doc")
    in_table = Window.partitionBy("doc", "idx").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    in_page = Window.partitionBy("doc").orderBy("idx", "r").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c, w: F.last(c, ignorenulls=True).over(w)
    d = told.withColumns({"__section": last("__section", in_table), "company_name": last("company_name", in_table), "__industry": last("__industry", in_page)})
    d = d.filter(is_("data") | (is_("continued") & F.col("company_name").isNotNull()))
    out = {"investment_type": record_kind(F.coalesce("investment_type", "__section", F.lit("First Lien"))), "industry": F.coalesce("industry", "__industry")}
    return d.select("doc", "idx", "r", *[out.get(f, F.col(f)).alias(f) for f in FIELDS])


def section_context(lines: Column, first: int = 6, longest: int = 120) -> Column:
    """The first of a table's first lines that is short, without tabs, and holds a section's word; null if there is none."""
    low = F.transform(F.slice(lines, 1, first), lambda x: F.trim(x))
    return F.get(F.filter(low, lambda x: (x != "") & (F.length(x) < longest) & ~x.contains("\t") & has_any(F.lower(x), CONTEXT_WORDS)), 0)


# Words of heads whose columns stay though mostly empty.
RATE_HEADS = ["rate", "spread", "pik", "interest", "reference", "margin", "coupon", "index"]
SIGNS = ["%", "$"]


def without_spacers(grid: Column) -> Column:
    """A table (array of rows, the first of heads) by the rules of ``drop_spacers``, for tables that are one value each: blanks are '', rows
    are as wide as the columns that stay. Nothing is shuffled, and no cell becomes a row."""
    blank = F.lit("")
    shorter = lambda a: F.transform(a, lambda x: F.trim(F.coalesce(x, blank)))

    def facts(cells):
        """Of a column's cells, what decides on it: whether it stays, and whether it is of signs."""
        below, n = F.slice(cells, 2, F.greatest(F.size(cells), F.lit(1))), F.size(cells) - 1
        rate = F.lower(F.get(cells, 0)).rlike("|".join(RATE_HEADS))

        def judged(some):
            full, signs = F.size(some), F.size(F.filter(some, lambda x: x.isin(*SIGNS)))
            stays = ((F.get(cells, 0) != "") | (full > 0)) & (rate | ((n - full) * 10 <= n * 8))
            return F.struct(cells.alias("cells"), stays.alias("stays"), (signs * 2 > full).alias("sign"))

        return let(F.filter(below, lambda x: x != ""), judged)

    def joined(done, x):
        """Every column of signs belongs to the nearest column before it that is none; of several the largest sign counts."""

        def signed(last):
            marks = F.when(last["marks"].isNull(), x["cells"]).otherwise(F.zip_with(last["marks"], x["cells"], lambda a, b: F.greatest(a, b)))
            return F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["cells"].alias("cells"), marks.alias("marks"))))

        one = F.struct(x["cells"].alias("cells"), F.lit(None).cast("array<string>").alias("marks"))
        return F.when(x["sign"] & (F.size(done) > 0), let(F.element_at(done, -1), signed)).otherwise(F.concat(done, F.array(one)))

    def read(rows):
        width = F.array_max(F.transform(rows, lambda row: F.size(row)))
        places = F.when(width > 0, F.sequence(F.lit(0), width - 1)).otherwise(F.array().cast("array<int>"))
        columns = F.transform(places, lambda c: let(F.transform(rows, lambda row: F.coalesce(F.get(row, c), blank)), facts))
        none = F.array().cast("array<struct<cells:array<string>,marks:array<string>>>")
        kept = F.aggregate(F.filter(columns, lambda x: x["stays"]), none, joined)
        shown = lambda v, m: F.when(v == "", v).when(m == "$", F.concat(m, v)).when(m == "%", F.concat(v, m)).otherwise(v)
        cells = F.transform(kept, lambda x: F.when(x["marks"].isNull(), x["cells"]).otherwise(F.zip_with(x["cells"], x["marks"], shown)))
        return let(cells, lambda cells: F.transform(rows, lambda _, r: F.transform(cells, lambda column: F.get(column, r))))

    return let(F.transform(grid, shorter), read)


def drop_spacers(cells: DataFrame, sizes: DataFrame) -> DataFrame:
    """Cells (doc, idx, r, c, text; row 0 has the heads, blank cells may be absent) without the columns that are blank in over 80 per
    cent of a table's rows, with columns of signs joined to the column before them; c counts the columns that stay.

    sizes: (doc, idx, n_rows, n_cols) of each table. Columns of rates stay. A column is of signs if over half of its filled cells are
    ``%`` or ``$``; the sign is written on the value before it, and goes where that is blank. Columns are counted
    per table and joined back, so a table's width and length are nobody's loop.
    """
    key = ["doc", "idx"]
    filled = cells.filter(F.trim("text") != "").select(*key, "r", "c", F.trim("text").alias("text"))
    below = F.col("r") > 0
    per = filled.groupBy(*key, "c").agg(
        F.count_if(below).alias("__full"), F.count_if(below & F.col("text").isin(*SIGNS)).alias("__signs"), F.max(F.when(~below, F.lower("text"))).alias("__head"),
    )
    per = per.join(sizes.select(*key, (F.col("n_rows") - 1).alias("__n")), key)
    rate = F.coalesce(F.col("__head").rlike("|".join(RATE_HEADS)), F.lit(False))
    per = per.filter(rate | ((F.col("__n") - F.col("__full")) * 10 <= F.col("__n") * 8))
    order = Window.partitionBy(*key).orderBy("c")
    signs = F.col("__signs") * 2 > F.col("__full")
    per = per.withColumn("__sign", signs & (F.row_number().over(order) > 1))
    # Every column of signs belongs to the nearest column before it that is none.
    per = per.withColumn("__of", F.sum((~F.col("__sign")).cast("int")).over(order) - 1).select(*key, "c", "__sign", "__of")
    d = filled.join(per, [*key, "c"]).groupBy(*key, "r", F.col("__of").cast("int").alias("c")).agg(
        F.max(F.when(~F.col("__sign"), F.col("text"))).alias("__value"), F.max(F.when(F.col("__sign"), F.col("text"))).alias("__mark"),
    )
    shown = F.when(F.col("__mark") == "$", F.concat(F.lit("$"), "__value")).when(F.col("__mark") == "%", F.concat("__value", F.lit("%"))).otherwise(F.col("__value"))
    return d.filter("__value is not null").select(*key, "r", "c", shown.alias("text"))
