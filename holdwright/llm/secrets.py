"""Secrets in texts, and credentials of several parts.

Three kinds stand alone: ``assign`` (a password, secret, token or key given a value), ``access`` (access key
ids) and ``hex`` (long hexadecimal runs). Parts that prove nothing by themselves are weak: ``ident`` (an account's
or client's name), ``secret`` (a long mixed token) and ``endpoint`` (an address). They are reported only where
their complements are near: every identifier opens an interval of ``REACH`` characters to both sides, cut at the
end of its scope, and the parts that start inside it are joined to it.

* an identifier (access or ident) and a secret (assign, hex or secret) inside its interval are a credential,
  which reports both, and each address inside the interval too;
* an address alone, a name alone, a token alone, or two of a kind report nothing.

A scope is a paragraph: lines up to an empty one or to a section's head (``[name]`` on a line). Parts are sorted
by place, an interval's parts are found by bisection, and each identifier is linked to its nearest secret and
address, so the work grows with the text and not with pairs.

A document is searched where it lies: no shuffle, and no key that could be hot. Places are code points, ends exclusive.

Defined results: null and empty texts have no spans; rows that repeat an id or a text are documents of their own;
an empty table gives no rows; all other columns of the input stay, but those that the result names.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Kinds in the order in which spans with one start come.
KINDS = ("assign", "access", "hex", "ident", "secret", "endpoint")
#: Characters to both sides of an identifier within which its other parts are looked for.
REACH = 400
#: Bits a character that a weak token holds at least.
ENTROPY = 3.5

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: An assignment holds one of these, in either case.
ASSIGNED = re.compile(r"pass(?:word|wd)|secret|token|api_?key", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
IDENT = re.compile(
    r"""(?<![A-Za-z0-9])(?:(?:access|client|application|account|tenant|subscription)[_-]?(?:key[_-]?)?id|user(?:_?name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    re.IGNORECASE | re.ASCII,
)
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
ENDPOINT = re.compile(
    r"""(?<![A-Za-z0-9])(?:(?:https?|wss?|ftps?|amqps?|rediss?|mysql|postgres(?:ql)?|mongodb(?:\+srv)?)://[^\s"'<>]+|(?:host(?:_?name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?)""",
    re.IGNORECASE | re.ASCII,
)
SCOPE_END = re.compile(r"\n[ \t\r]*(?=\n)|\n(?=[ \t]*\[[^\]\n]{1,80}\][ \t\r]*(?:\n|$))")

Span = tuple[int, int, int]  # kind, start, end


def _mixed(token: str) -> bool:
    """Small and capital letters and digits, and as many different ones as chance would give."""
    if not (re.search("[a-z]", token) and re.search("[A-Z]", token) and re.search("[0-9]", token)):
        return False
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= ENTROPY


def standing(text: str) -> list[Span]:
    """The spans that stand alone, by kind."""
    out = []
    if ASSIGNED.search(text):
        out += [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(1, *m.span()) for m in ACCESS.finditer(text)]
    return out + [(2, *m.span()) for m in HEX.finditer(text)]


def _apart(spans: list[Span]):
    """Whether a stretch overlaps none of the spans."""
    spans = sorted((s, e) for _, s, e in spans)
    starts, ends = [s for s, _ in spans], list(accumulate((e for _, e in spans), max))

    def apart(start: int, end: int) -> bool:
        k = bisect_left(starts, end)
        return k == 0 or ends[k - 1] <= start

    return apart


def linked(text: str, found: list[Span]) -> tuple[list[Span], list[tuple]]:
    """The weak spans that complement each other or those found, and the credentials: (identifier, secret, address or None)."""
    apart, clear = _apart(found), _apart([x for x in found if x[0] == 1])
    secrets = [x for x in found if x[0] != 1 and clear(*x[1:])]  # a token that is the identifier is not its secret
    secrets += [(4, *m.span()) for m in TOKEN.finditer(text) if apart(*m.span()) and _mixed(m[0])]
    if not secrets:
        return [], []
    names = [x for x in found if x[0] == 1]
    names += [(3, *m.span()) for m in IDENT.finditer(text) if apart(*m.span())]
    if not names:
        return [], []
    places = [(5, *m.span()) for m in ENDPOINT.finditer(text)]
    cuts = [0, *[m.end() for m in SCOPE_END.finditer(text)], len(text)]
    by_start = lambda spans: sorted(spans, key=lambda x: x[1:])
    secrets, places, names = by_start(secrets), by_start(places), by_start(names)
    at = {4: [s for _, s, _ in secrets], 5: [s for _, s, _ in places]}
    inside = {4: [0] * (len(secrets) + 1), 5: [0] * (len(places) + 1)}  # where intervals begin (+1) and end (-1), in order of the spans
    weak, links = [], []

    for name in names:
        scope = bisect_right(cuts, name[1])
        lo, hi = max(cuts[scope - 1], name[1] - REACH), min(cuts[min(scope, len(cuts) - 1)], name[2] + REACH)
        a, z = bisect_left(at[4], lo), bisect_left(at[4], hi)
        if a == z:
            continue
        near = lambda x, name=name: (max(x[1] - name[2], name[1] - x[2]), x[1])
        k = bisect_left(at[4], name[1], a, z)
        secret = min(secrets[max(a, k - 1) : min(z, k + 1)], key=near)
        b, y = bisect_left(at[5], lo), bisect_left(at[5], hi)
        k = bisect_left(at[5], name[1], b, y)
        place = min(places[max(b, k - 1) : min(y, k + 1)], key=near, default=None)
        links.append((name, secret, place))
        if name[0] == 3:
            weak.append(name)
        for kind, i, j in ((4, a, z), (5, b, y)):
            inside[kind][i] += 1
            inside[kind][j] -= 1
    for kind, spans in ((4, secrets), (5, places)):
        weak += [x for x, n in zip(spans, accumulate(inside[kind]), strict=False) if n and x[0] == kind]
    return weak, links


SPAN = "struct<kind: string, start: int, stop: int>"


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with two more columns: spans (kind, start, stop), by start and kind, and credentials (ident, secret, endpoint),
    a span each, the last null where there is none near."""
    added = StructType.fromDDL(f"spans array<{SPAN}>, credentials array<struct<ident: {SPAN}, secret: {SPAN}, endpoint: {SPAN}>>")
    kept = [c for c in docs.columns if c.lower() not in ("spans", "credentials")]
    schema = StructType([*docs.select(*kept).schema.fields, *added.fields])
    place = next(k for k, c in enumerate(kept) if c.lower() == text_col.lower())

    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = lambda x: x and {"kind": KINDS[x[0]], "start": x[1], "stop": x[2]}
        for b in batches:
            spans, credentials = [], []
            for scalar in b.column(place):
                text = scalar.as_py() or ""
                found = standing(text)
                weak, links = linked(text, found)
                spans.append([told(x) for x in sorted(found + weak, key=lambda x: (x[1], x[0]))])
                credentials.append([{"ident": told(n), "secret": told(s), "endpoint": told(p)} for n, s, p in links])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(spans, arrow[0].type), pa.array(credentials, arrow[1].type)], names=[*kept, "spans", "credentials"])

    return docs.select(*kept).mapInArrow(run, schema)


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The counts of standing kinds, the SHA-256 of those spans as text, and all spans as text."""
    is_kind = lambda *k: lambda s: s["kind"].isin(*k)
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    told = lambda spans: F.array_join(F.transform(spans, shown), ",")
    counts = [F.size(F.filter("spans", is_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return scanned.select(id_col, *counts, F.sha2(told(F.filter("spans", is_kind(*KINDS[:3]))), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
