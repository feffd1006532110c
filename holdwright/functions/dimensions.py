"""Positions told in one string, as filers tag them: its shape, its head by that shape, its details by their labels.

A shape says where company, industry and instrument stand; details (rates, dates, shares of net assets) are found
by the words before them, alike in every shape. All of it is Column expressions, so a table of strings is one projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import parse, text, vocab

# Words that end a company's name.
LEGAL_FORMS = ["LLC", "L.L.C", "LP", "L.P", "LLP", "L.L.P", "Inc", "Corp", "Corporation", "Company", "Co", "Ltd", "Limited", "PLC", "GmbH", "Pty Ltd", "N.V", "S.A"]
# Words that end a name where nothing better is known.
NAME_ENDS = [*LEGAL_FORMS, "Group", "Holding", "Holdings", "Partner", "Partners"]
# Sectors that lead a spaced string, longest first.
SPACED_SECTORS = [
    "Human Resource Support Services", "Retail and Consumer Products", "Oil Gas and Consumable Fuels", "Chemicals & Materials", "Chemicals",
    "Business Services", "Financial Services", "Communications", "Pharmaceuticals", "Transportation", "Electronics", "Internet Services",
    "Manufacturing", "Media & Entertainment", "Healthcare", "Education",
]
# Sectors that follow a country.
COUNTRY_SECTORS = [
    "Food and Agriculture Technologies", "Consumer Products & Services", "Supply Chain Technology", "Real Estate Technology",
    "Transportation Technology", "Education Technology", "Human Resource Technology", "Medical Devices", "Construction Technology",
    "Finance and Insurance", "Green Technology", "Space Technology", "Artificial Intelligence & Automation", "Biotechnology", "Connectivity",
    "Healthcare", "Industrials", "SaaS",
]
# Instruments that end the head of a spaced string.
SPACED_INSTRUMENTS = [
    r"First-lien\s+loan", r"First-lien\s+revolving", r"Second-lien\s+note", r"Partnership\s+Interest", r"Warrants?\s+\(",
    r"Series\s+[A-Z]\s+Preferred\s+Shares", r"Preferred\s+Shares", r"Class\s+[AB][-\s]?[12]?\s+Units?",
]
# Instruments behind the word Investment in an unbroken string.
BLOB_INSTRUMENTS = [
    r"(?:First|Second)\s+Lien(?:\s+(?:Senior\s+Secured|Secured))?\s+Debt", r"(?:Subordinated|Unsecured|Mezzanine)\s+Debt",
    r"Senior\s+Secured\s+(?:First\s+Lien\s+)?(?:Debt|Loan|Term\s+Loan|Bond)", r"(?:First|Second)\s+Lien\s+(?:Term\s+Loan|Revolver|Delayed\s+Draw)",
    r"(?:Preferred|Common)\s+(?:Equity|Stock)", "Equity", "Warrants?",
]
# Instruments of a commitment, which stand before the company.
COMMITTED = r"First\s+Lien\s+Debt|Second\s+Lien\s+Debt|Subordinated\s+Debt|Unsecured\s+Debt|Preferred\s+Equity|Common\s+Equity|Equity|Debt"
# Kinds by words of the instrument, the first that has one.
KINDS = {
    "DEBT": ["revolv", "delayed draw", "ddtl", "first lien", "second lien", "2nd lien", "subordinated", "term loan"],
    "WARRANT": ["warrant"],
    "COMMON": ["common unit", "common stock", "shares of common", "class a", "class b"],
    "PREFERRED": ["preferred unit", "preferred stock", "shares of preferred"],
    "EQUITY": ["equity", "unit", "membership interest", "member interest"],
}
# Words that make a segment an instrument.
INSTRUMENT_WORDS = [
    "loan", "lien", "secured", "subordinat", "revolv", "draw", "stock", "equity", "unit", "warrant", "note", "bond", "preferred", "common",
    "membership", "interest", "debt", "member",
]
# Segments that are an instrument where an industry could stand.
SHORT_INSTRUMENTS = ["revolver", "delayed draw", "delayed draw term loan", "term loan"]
# Categories that lead a piped string, and where the company and its industry follow; kind.
PIPED = {"Senior Secured Loans": (3, "DEBT"), "Equipment Financing": (2, "DEBT"), "Common Equity/Equity Interests/Warrants": (2, "EQUITY")}
# What a segment begins with that tells a detail and not a name.
LABELS = r"(?i)^\s*(Acquisition|Maturity|Investment|Net Assets|Reference)"
# Benchmarks as they are written, and by their letters.
BENCHMARKS = r"SOFR|LIBOR|Prime|Euribor|SONIA|STIBOR|AMERIBOR|CDOR|BKBM|Base\s*Rate"
LETTERS = {"S": "SOFR", "L": "LIBOR", "P": "PRIME", "E": "EURIBOR", "B": "SOFR"}
AFFILIATION = r"(?:non[-\s]+controlled/(?:non[-\s]+)?affiliated|non[-\s]+controlled|controlled|affiliated)"
NUMBER, DAY = r"(\d+(?:\.\d+)?)", r"(\d{1,2}/\d{1,2}/\d{2,4}|\d{1,2}/\d{4}|[A-Z][a-z]+ (?:\d{1,2},? )?\d{4})"
# Details by the words before them.
DETAILS = {
    "cash_rate": [rf"(?i)\bInterest\s+Rate\s+{NUMBER}%", rf"(?i)\bFixed\s+(?:interest\s+)?rate\s+{NUMBER}%", rf"(?i)\bInvestment\s*[-:]\s*[^,]*?-\s*{NUMBER}%"],
    "pik_rate": [rf"(?i){NUMBER}\s*%\s*PIK", rf"(?i)\bPIK\s+(?:Interest\s+)?{NUMBER}%"],
    "floor": [rf"(?i)\bFloor\s+rate\s+{NUMBER}%"],
    "net_assets": [rf"(?i)\bNet\s+Assets?\s*[-:]\s*{NUMBER}%"],
    "acquired": [rf"(?i:\b(?:Acquisition|Investment)\s+Date)\s*[-:]?\s*{DAY}"],
    "matures": [rf"(?i:\bMaturity\s+Date)\s*[-:]?\s*{DAY}", rf"(?i:\bCommitment\s+Expiration\s+Date)\s*{DAY}"],
}
HEAD = ["company", "industry", "kind", "description", "affiliation"]
FIELDS = [*HEAD, "rate", "spread", *DETAILS]

# Shapes in order: the first whose pattern is found.
SHAPES = [
    ("spaced", rf"^(?:Debt Investments|Equity and Other Investments) .*\s(?i:{'|'.join(SPACED_INSTRUMENTS)})"),
    ("country", r"^Portfolio Company .*\sUnited States\s"),
    ("issuer", r"(?i)^Investment,\s*(?:Non-?Affiliated\s+Issuer|Affiliated\s+Issuer|Non-?Controlled|Controlled)\s*,"),
    ("issuer_piped", r"(?i)^Investment\s*\|\s*(?:Non-?Affiliated|Affiliated)(?:\s+Issuer)?\s*\|"),
    ("joined", r"(?i)^(?:Debt|Equity)\s+Investments?\s+.*\sand\s"),
    ("blob", r"^Investments?[-\s]|^(?i:Debt|Equity)\s+(?i:Investments?)\s*-"),
    ("piped", r"\|"),
    ("commas", r""),
]


def _trim(c: Column) -> Column:
    return F.trim(c)  # transform would give F.trim an item's place as well


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, trimmed; null where there is none."""
    return F.nullif(F.trim(F.regexp_extract(c, pattern, group)), F.lit(""))


def any_of(words: Sequence[str], end: str = "") -> str:
    """A pattern for whole words, whose dots may be left out."""
    return r"(?i)\b(?:" + "|".join(w.replace(".", r"\.?").replace(" ", r"\s+") for w in words) + r")(?![A-Za-z0-9])\.?" + end


def segments(c: Column, mark: str) -> Column:
    """The trimmed pieces between marks that stand outside brackets, as a fold: a piece with a bracket open takes the next one in."""
    opened = lambda s: F.length(F.replace(s, F.lit(")"))) - F.length(F.replace(s, F.lit("(")))

    def step(done, piece):
        last = F.try_element_at(done, F.lit(-1))
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.concat(last, F.lit(mark), piece)))
        return F.when(opened(last) != 0, longer).otherwise(F.concat(done, F.array(piece)))

    done = F.aggregate(F.split(c, rf"\Q{mark}\E"), F.array().cast("array<string>"), step)
    return F.transform(text.let(done, lambda s: F.slice(s, 1, F.size(s) - F.when(F.try_element_at(s, F.lit(-1)) == "", 1).otherwise(0))), _trim)


def _places(items: Column, keep) -> Column:
    """Places (from 0) of the items that keep."""
    return F.filter(F.transform(items, lambda s, i: F.when(keep(s), i)), lambda i: i.isNotNull())


def _joined(items: Column, begin, size) -> Column:
    return F.nullif(F.array_join(F.slice(items, begin, F.greatest(size, F.lit(0))), ", "), F.lit(""))


def _pick(c: Column, table: dict) -> Column:
    """The table's value for c; null where it has none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)


def _kind(c: Column, otherwise: str | None = None) -> Column:
    """The kind that an instrument's words tell."""
    return text.first_match(F.lower(c), [(k, "|".join(words)) for k, words in KINDS.items()], F.lit(otherwise))


def _debt_or(c: Column, pattern: str) -> Column:
    return F.when(c.rlike(pattern), "EQUITY").otherwise("DEBT")


def _head(**fields: Column) -> Column:
    """struct(HEAD) with blanks as null."""
    return F.struct(*[F.nullif(fields[f], F.lit("")).alias(f) if f in fields else F.lit(None).cast("string").alias(f) for f in HEAD])


def _led(head: Column, sectors: Sequence[str]) -> tuple[Column, Column]:
    """Company and industry of a head that begins with one of the sectors, if it does."""
    pattern = "^(" + "|".join(s.replace("&", "[&]") for s in sectors) + ") (.+)$"
    return F.coalesce(found(head, pattern, 2), head), found(head, pattern)


def _spaced(c: Column) -> Column:
    """Kind, industry, company and instrument with blanks between them."""
    head = found(c, rf"^(?:Debt|Equity and Other) Investments (.*?)\s+(?i:{'|'.join(SPACED_INSTRUMENTS)})")
    company, industry = _led(head, SPACED_SECTORS)
    return _head(company=company, industry=industry, kind=F.when(c.startswith("Debt"), "DEBT").otherwise("EQUITY"))


def _country(c: Column) -> Column:
    """Kind, country, industry, company and details; what has no legal form may be an industry alone."""
    lead = r"(?i)^Portfolio\s+Company\s+(Debt\s+Securities|Warrant\s+Investments|Equity\s+Investments)\s*-\s*United\s+States\s+"
    tail = r"(?i)\s+(?:Type\s+of\s+Investment|Investment\s+Date|Expiration\s+Date)\s.*$"
    rest = F.nullif(F.when(c.rlike(lead), F.trim(F.regexp_replace(F.regexp_replace(c, lead, ""), tail, ""))), F.lit(""))

    def read(rest):
        company, industry = _led(rest, COUNTRY_SECTORS)
        alone = F.when(~rest.rlike(r"(?i)\b(Inc|LLC|Ltd|Corp|LP)\b"), rest)
        return _head(company=company, industry=F.coalesce(industry, alone), kind=_debt_or(found(c, lead), "(?i)equity"))

    return text.let(rest, read)


def _issuer(c: Column, industries: Sequence[str]) -> Column:
    """Investment, whose issuer, instrument, then the company's segments and the industry's or a short instrument."""

    def read(s):
        kind = F.nullif(F.get(s, 2), F.lit(""))

        def of_rest(rest):
            n, last = F.size(rest), F.lower(F.try_element_at(rest, F.lit(-1)))
            legal = F.try_element_at(_places(rest, lambda x: x.rlike(any_of(LEGAL_FORMS, r"\s*(?:\([^)]*\))?\s*$"))), F.lit(-1)) + 1
            marked = lambda x: x.rlike("[&:]")
            sector = (n >= 2) & (marked(last) | last.isin(*industries))
            two = (n >= 3) & ~marked(F.try_element_at(rest, F.lit(-2)))
            behind = F.when(sector & two, 2).when(sector | last.isin(*SHORT_INSTRUMENTS), 1).otherwise(0)
            return text.let(F.coalesce(legal, n - behind), lambda at: F.struct(_joined(rest, F.lit(1), at).alias("company"), _joined(rest, at + 1, n - at).alias("tail")))

        def told(r):
            short = F.lower(r["tail"]).isin(*SHORT_INSTRUMENTS)
            return _head(
                company=r["company"], industry=F.when(~short, r["tail"]), description=F.when(short, r["tail"]).otherwise(kind),
                kind=F.when(kind.isNotNull(), _debt_or(kind, "(?i)equity|warrant|preferred")), affiliation=_affiliation(c),
            )

        return text.let(text.let(F.slice(s, 4, F.greatest(F.size(s) - 3, F.lit(0))), of_rest), told)

    return text.let(segments(c, ","), read)


def _affiliation(c: Column) -> Column:
    lead = F.lower(F.substring(c, 1, 60))
    return F.when(lead.rlike(r"non-?affiliated"), "non-affiliated").when(lead.contains("affiliated"), "affiliated")


def _issuer_piped(c: Column) -> Column:
    """The same with pipes; the company at the fourth place, the industry with its part behind it."""
    return text.let(
        F.transform(F.split(c, r"\|"), _trim),
        lambda p: _head(
            company=F.get(p, 3), industry=F.trim(F.substring_index(F.get(p, 4), ":", 1)), affiliation=_affiliation(c),
            kind=F.when(F.size(p) >= 3, _debt_or(F.get(p, 2), "(?i)equity")),
        ),
    )


def _joined_by_and(c: Column) -> Column:
    """Kind with the industry, company, then instrument and details, with the word and between them; totals have no company."""
    words = "senior secured|first lien|second lien|subordinated|unsecured|mezzanine|preferred stock|common stock|warrant|preferred unit|common unit|membership"

    def read(s):
        total = F.exists(F.slice(s, 2, 2), lambda x: F.lower(x).startswith("total "))
        told = F.filter(F.slice(s, 3, F.greatest(F.size(s) - 2, F.lit(0))), lambda x: F.lower(x).rlike(words))
        return _head(
            company=F.when(~total, F.get(s, 1)), description=F.when(~total, F.try_element_at(told, F.lit(-1))),
            industry=F.trim(F.regexp_replace(F.get(s, 0), r"(?i)^(?:debt|equity) investments?", "")), kind=F.upper(found(c, "(?i)^(debt|equity)")),
        )

    return text.let(F.transform(F.split(c, " and "), _trim), read)


def _blob(c: Column, industries: Sequence[str]) -> Column:
    """Whose and what kind, industry, company, the word Investment with the instrument, details, without a mark between them;
    or a commitment, whose instrument stands before the company."""
    whose = rf"(?i)^(?:(?:Debt|Equity)\s+)?Investments?\s*[-\s]+\s*{AFFILIATION}\s+"
    lead = rf"{whose}(?:(?:Debt|Equity)\s+Investments?\s*)?"
    commit = rf"(?i)^Investments?\s*[-\s]+\s*{AFFILIATION}\s+({COMMITTED})\s+(?!Investments?\b)"
    draws = found(c, r"(?i)Commitment\s+Type\s+([\w\s]+?)\s+Commitment")
    draws = F.when(draws.rlike("(?i)revolv"), "Revolver").when(draws.rlike("(?i)delayed draw|ddtl"), "Delayed Draw Term Loan")
    committed = _head(
        company=F.trim(F.regexp_replace(F.regexp_replace(c, commit, ""), r"(?is)\s+Commitment\s+Type.*$", "")), description=F.coalesce(draws, found(c, commit)),
        kind=F.when(found(c, commit).rlike("(?i)debt"), "DEBT").otherwise("EQUITY"),
    )
    rest = F.when(c.rlike(whose), F.regexp_replace(c, lead, "")).otherwise(F.regexp_replace(c, r"^Investments?\S*\s+", ""))
    head = F.trim(F.regexp_replace(rest, r"(?is)(?:Reference\s+Rate|Interest\s+Rate\s+\d|Maturity\s+Date|Fixed\s+Rate|Floating\s+Rate).*$", ""))
    kind = rf"(?i)\bInvestments?\s+({'|'.join(BLOB_INSTRUMENTS)})\b"
    named = F.trim(F.regexp_replace(head, rf"(?s){kind}.*$", ""))
    named = F.trim(F.regexp_replace(named, r"(?i)\s+(?:One|Two|Three|Four|Five|Six|Seven|Eight|Nine|Ten|\d+)\s*$", ""))
    told = found(c, rf"(?i)^(?:Investments?\s*[-\s]+\s*{AFFILIATION}\s+)?(Debt|Equity)\s+Investments?")
    longest = F.array(*map(F.lit, sorted(industries, key=lambda x: (-len(x), x))))

    def read(n):
        def split(sector):
            at = F.instr(F.lower(n), sector)
            return _head(
                company=F.when(sector.isNull(), n).otherwise(F.coalesce(F.nullif(F.trim(F.substring(n, at + F.length(sector), F.length(n))), F.lit("")), n)),
                industry=F.substring(n, at, F.length(sector)), description=found(head, kind), kind=F.upper(told),
            )

        return text.let(F.try_element_at(F.filter(longest, lambda x: F.contains(F.lower(n), x)), F.lit(1)), split)

    return F.when(c.rlike(commit), committed).otherwise(text.let(named, read))


def _piped(c: Column) -> Column:
    """Company and instrument; or one of the known categories, then the company at its place and the industry."""

    def read(p):
        place, kind = (_pick(F.get(p, 0), {k: v[i] for k, v in PIPED.items()}) for i in (0, 1))
        full = F.when(place == 3, F.size(p) >= 4).otherwise(F.size(p) >= place)
        said = F.nullif(F.array_join(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), " | "), F.lit(""))
        return _head(
            company=F.when(place.isNull(), F.get(p, 0)).when(full, F.get(p, place - 1)), industry=F.when(full, F.get(p, place)),
            description=F.when(place.isNull(), said).when(full & (place == 3), F.get(p, 1)), kind=F.when(place.isNull(), _kind(said)).when(full, kind),
        )

    return text.let(F.transform(F.split(c, r"\|"), _trim), read)


def _commas(c: Column, industries: Sequence[str]) -> Column:
    """Company and instrument or industry, with a number behind it perhaps; or a kind, industry, company and details."""
    lead = r"(?i)^\s*(DEBT|EQUITY|PREFERRED|WARRANT|COMMON|SUBORDINATED|CONVERTIBLE)\s+Investment\b"
    bare = lambda s: F.trim(F.regexp_replace(s, r"\s+\d+$", ""))
    name = lambda s: F.when(~s.rlike(LABELS), F.nullif(s, F.lit("")))
    words = "|".join(INSTRUMENT_WORDS)
    told = F.trim(F.regexp_replace(found(c, r"(?i)\bInvestment\s*[-:]\s*([^,]+)"), r"\s*-\s*[\d.]+%.*$", ""))

    def rich(s):
        legal = F.filter(F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), lambda x: x.rlike(r"(?i)\b(LLC|Inc|Corp|LP|Ltd|Holdings|Group|Partners)\b") & ~x.rlike(LABELS))
        return _head(company=F.coalesce(name(F.get(s, 2)), F.try_element_at(legal, F.lit(1))), industry=name(F.get(s, 1)), description=told, kind=F.upper(found(c, lead)))

    def plain(s):
        tells = lambda x: F.lower(bare(x)).rlike(words) | F.lower(bare(x)).isin(*industries)

        def split(at):
            last = bare(F.get(s, at))
            instrument = F.lower(last).rlike(words)
            return _head(company=F.coalesce(_joined(s, F.lit(1), at), F.trim(c)), industry=F.when(~instrument, last), description=F.coalesce(F.when(instrument, last), told))

        return text.let(F.try_element_at(F.filter(_places(s, tells), lambda i: i > 0), F.lit(-1)), split)

    return text.let(segments(c, ","), lambda s: F.when(c.rlike(lead), rich(s)).otherwise(plain(s)))


def _date(c: Column) -> Column:
    """A day as ISO text; a month is its first day."""
    day = F.regexp_replace(c, ",", "")
    day = F.when(day.rlike(r"^\d{1,2}/\d{4}$"), F.concat(F.substring_index(day, "/", 1), F.lit("/1/"), F.substring_index(day, "/", -1))).otherwise(day)
    month = F.when(day.rlike("^[A-Z]"), F.concat(F.substring(day, 1, 3), F.lit(" "), F.coalesce(found(day, r"^\w+ (\d{1,2}) "), F.lit("1")), F.lit(" "), F.right(day, F.lit(4))))
    return F.coalesce(F.date_format(F.try_to_date(month, "MMM d yyyy"), "yyyy-MM-dd"), parse.normalize_date(day))


def details(c: Column) -> dict[str, Column]:
    """Rate, spread and what the labels of DETAILS introduce, wherever it stands."""
    rate = rf"(?i)(?:\bSpread\s+([SLPEB])|\b({BENCHMARKS}))\s*([+-])\s*{NUMBER}\s*%"
    letter = F.upper(found(c, rate, 1))
    named = text.first_match(letter, [(v, f"^{k}$") for k, v in LETTERS.items()])
    out = {"rate": F.coalesce(named, F.upper(found(c, rate, 2)))}
    out["spread"] = F.concat(F.when(found(c, rate, 3) == "-", "-").otherwise(""), found(c, rate, 4), F.lit("%"))
    for field, patterns in DETAILS.items():
        x = F.coalesce(*[found(c, p) for p in patterns])
        out[field] = _date(x) if field in ("acquired", "matures") else F.concat(x, F.lit("%"))
    return out


def shape_of(c: Column) -> Column:
    """The name of the first shape that fits; null for a blank string."""
    return F.when(~text.blank(c), text.first_match(c, SHAPES))


def read(c: Column, industries: Sequence[str] = tuple(vocab.INDUSTRY_NAMES)) -> Column:
    """struct(shape, FIELDS...) of a dimension string. What it doesn't tell is null; a blank string tells nothing.

    industries: lower-cased names by which a segment, or a stretch of an unbroken string, is an industry.
    """
    c = F.trim(c)
    heads = {
        "spaced": _spaced(c), "country": _country(c), "issuer": _issuer(c, industries), "issuer_piped": _issuer_piped(c),
        "joined": _joined_by_and(c), "blob": _blob(c, industries), "piped": _piped(c), "commas": _commas(c, industries),
    }
    rest = details(c)

    def of_shape(shape: Column) -> Column:
        told = None
        for name, head in heads.items():
            told = F.when(shape == name, head) if told is None else told.when(shape == name, head)
        return text.let(told, lambda h: F.struct(shape.alias("shape"), *[h[f].alias(f) for f in HEAD], *[rest[f].alias(f) for f in FIELDS[len(HEAD) :]]))

    return text.let(shape_of(c), of_shape)


# What stands before a name with a hyphen and perhaps a percentage.
BEFORE_NAME = r"(?:first|1st|second|2nd)\s+lien|senior\s+secured(?:\s+debt)?|senior\s+unsecured(?:\s+debt)?|subordinated\s+debt|unsecured\s+debt|debt\s+investments?|equity\s+investments?|common\s+stock|preferred\s+stock|warrants?"
# Names of sums and sections.
NO_NAME = r"(?i)^(?:(?:sub)?total\s.*|(?:debt|equity) investments|(?:control\s+and\s+)?affiliate\s+investments?|-?\s*\d+(?:\.\d+)?%)$"
# Segments that belong to no name, and what no name begins with.
NO_PART = r"(?i)^(?:Investment|Non-?Affiliated Issuer|Affiliated Issuer|Non-?Controlled|Controlled|First Lien Debt|Second Lien Debt|Subordinated Debt|Unsecured Debt|Debt Investments?|Equity Investments?|Investment Funds)\b"
NO_START = r"(?i)^(?:Acquisition|Maturity|Investment|Net Assets|Reference|Total|Debt Investments?|Equity Investments?|Common Stock|Preferred Stock|Unsecured Debt)\b"
#: Segments that a recovered name has at most, and its length.
WINDOW, SHORTEST, LONGEST = 5, 4, 140


def is_cut_off(name: Column) -> Column:
    """Whether a name looks like the end of one: a small first letter, a bracket that was never opened, a word of a group alone."""
    n = F.trim(F.coalesce(name, F.lit("")))
    tail = (n.endswith(")") & ~n.contains("(")) | n.rlike(r"(?i)^(?:Group|Holdings?|Management|Mgmt\.?\s*&\s*Development)\b")
    return (n == "") | n.rlike(r"^\p{Ll}") | tail | ((F.length(n) <= 14) & n.rlike(r"(?i)\b(?:Group|Holdings?|Development)\b"))


def recovered_name(c: Column) -> Column:
    """The longest run of at most WINDOW segments that ends in a legal form and holds no details; the first of equals; null if there is none."""

    def windows(s):
        ends = _places(s, lambda x: x.rlike(any_of(NAME_ENDS)))

        def from_end(e):
            def from_start(k):
                run = F.slice(s, e - k + 1, k + 1)
                skip = F.coalesce(F.get(_places(run, lambda x: ~x.rlike(NO_PART)), 0), F.size(run))
                name = F.array_join(F.slice(run, skip + 1, F.size(run) - skip), ", ")
                fits = F.length(name).between(SHORTEST, LONGEST) & ~name.rlike(NO_START)
                return F.when(fits, F.struct(F.length(name).alias("n"), (-e).alias("end"), k.alias("k"), name.alias("name")))

            return F.transform(F.sequence(F.lit(0), F.least(e, F.lit(WINDOW - 1))), from_start)

        best = F.array_max(F.array_compact(F.flatten(F.transform(ends, from_end))))
        return F.regexp_replace(F.regexp_replace(best["name"], r"\s+", " "), r"\s+\d+\s*$", "")

    return text.let(F.filter(segments(c, ","), lambda x: x != ""), windows)


def sane_company(name: Column, raw: Column, total: Column | None = None) -> Column:
    """struct(company, industry): a parsed name without what leaked into it, recovered from the whole string where it was cut off.

    Sums, sections and bare percentages are no company (null). industry: what stood behind the word Industry.
    """
    n = F.regexp_replace(F.trim(F.coalesce(name, F.lit(""))), r"(?<=[a-z])Industry\b", " Industry")
    n = F.trim(F.regexp_replace(n, rf"(?i)^\s*(?:{BEFORE_NAME})\s*-\s*(?:\d+(?:\.\d+)?%?)?\s*", ""))
    leak = r"(?i)\bIndustry\s+([A-Za-z&/\-\s]+)$"
    industry = F.regexp_replace(found(n, leak), r"\s+", " ")
    n = F.trim(F.regexp_replace(n, leak, ""))
    n = F.when(is_cut_off(n), F.coalesce(recovered_name(raw), n)).otherwise(n)
    gone = text.blank(name) | (n == "") | n.rlike(NO_NAME)
    gone = gone if total is None else gone | F.coalesce(total, F.lit(False))
    return F.struct(F.when(~gone, n).alias("company"), F.when(~text.blank(name), industry).alias("industry"))
