"""The better of near positions against loops over all pairs."""

import random

import pytest

from holdwright.operators import dedup
from holdwright.plans import cleaning

FIELDS = ["principal", "maturity", "cost", "note"]


def brute(rows):
    """Pairs, best rows first: each row that is left takes those away that are near and worse."""
    groups = {}
    for r in rows:
        if all((str(r[c]).strip() if r[c] is not None else "") in dedup.NO_MONEY for c in ("principal", "cost")):
            continue
        key = (" ".join((r["company"] or "").split("(")[0].lower().split()), " ".join((r["kind"] or "").lower().split()))
        try:
            p = float((r["principal"] or "").replace(",", "").replace(" ", ""))
        except ValueError:
            p = None
        day = None
        if r["maturity"]:
            m, d, y = map(int, r["maturity"].split("/"))
            day = (y, m, d)
        rank = (0, tuple(-x for x in day)) if day else (1, -sum(bool((str(r[c]) if r[c] is not None else "").strip()) for c in FIELDS), -r["size"])
        groups.setdefault(key, []).append([rank, p, r])
    out = []
    for some in groups.values():
        some.sort(key=lambda x: x[0])
        left = [True] * len(some)
        for i, (rank, p, r) in enumerate(some):
            if not left[i]:
                continue
            out.append(tuple(r))
            for j in range(i + 1, len(some)):
                q = some[j][1]
                near = p is None and q is None if p is None or q is None else abs(p - q) <= 0.01 * max(abs(p), abs(q), 1.0)
                if near and some[j][0] > rank:
                    left[j] = False
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random(spark, seed):
    r = random.Random(seed)
    cell = lambda: r.choice([None, "", "-", "100", "100.5", "101.4", "1,00 0", "0.5", "0.504", "-100", "-100.9", "x", "98.9", "0"])
    rows = [
        (k, r.choice(["Oak LLC", "OAK  llc (1)", "Elm", None]), r.choice(["Loan", "loan ", None]), cell(), r.choice([None, "1/2/2025", "3/4/2026", "3/4/2026"]), r.choice([None, "5", "0", "n/a"]), r.choice([None, " ", "y"]), r.randrange(3))
        for k in range(300)
    ]
    df = spark.createDataFrame(rows, "id int, company string, kind string, principal string, maturity string, cost string, note string, size int")
    assert got(dedup.drop_worse_positions(df.repartition(7), "company", "kind", "principal", "maturity", ["principal", "cost"], FIELDS, "size")) == brute(df.collect())
    assert dedup.drop_worse_positions(df.limit(0), "company", "kind", "principal", "maturity", ["principal", "cost"], FIELDS, "size").count() == 0


def test_lines(spark, sf, monkeypatch):
    seen = []
    real = dedup.drop_worse_positions
    monkeypatch.setattr(dedup, "drop_worse_positions", lambda rows, *a: seen.append(rows) or real(rows, *a))
    out = got(cleaning.later_positions(spark, sf))
    assert out == brute(seen[0].collect()) and len(out) < seen[0].count()
