import json

from pyspark.sql import functions as F

from holdwright.sources import documents, facts, holdings


def test_holdings_csv_by_header(spark, tmp_path):
    a, b = tmp_path / "AAA", tmp_path / "BBB"
    a.mkdir(), b.mkdir()
    (a / "2024-01-31.csv").write_text('company_name,fair_value,ticker,ticker\n"Acme, ""Inc""",(5),AAA,AAA\n,1,AAA,AAA\nShort\n')
    (b / "2024-02-29.csv").write_text("floor,fair_value,company_name,odd\n1.00%,\"1,200\",Beta,x\n")
    (b / "notes.csv").write_text("company_name\nno\n")
    d = holdings.typed(holdings.read_csv_holdings(spark, str(tmp_path)))
    rows = {r.company_name: r for r in d.collect()}
    assert set(rows) == {'Acme, "Inc"', "Short", "Beta"}
    assert rows['Acme, "Inc"'].fair_value_num == -5 and rows["Beta"].floor_rate_num == 1 and rows["Beta"].fair_value_num == 1200
    assert str(rows["Beta"].filing_date) == "2024-02-29" and rows["Beta"].ticker == "BBB" and rows["Short"].row_seq == 2
    out = str(tmp_path / "out")
    holdings.write_holdings(d, out)
    holdings.write_holdings(d.filter("ticker = 'BBB'"), out)
    back = spark.read.parquet(out)
    assert back.count() == 3 and holdings.not_landed(d, back).count() == 0
    assert holdings.index(d).filter("ticker = 'AAA' and row_count = 2").count() == 1
    holdings.write_json(holdings.index(d), str(tmp_path / "json"), "ticker")
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_company_facts(spark, tmp_path):
    def f(start, end, val, form="10-Q", filed="2024-05-01"):
        return {"start": start, "end": end, "val": val, "form": form, "filed": filed, "fy": 2024, "fp": "Q1"}

    units = {"USD": [f("2024-01-01", "2024-03-31", 5), f("2024-01-01", "2024-02-01", 6), f(None, "2024-03-31", 7), f("2024-01-01", "2024-03-31", 8, "S-1")]}
    payload = {"cik": "1", "entityName": "E", "facts": {"us-gaap": {"Assets": {"label": "A", "units": units}}, "aaa": {"Assets": {"label": "A", "units": units}, "Odd": {"label": "O", "units": units}}}}
    (tmp_path / "x.json").write_text(json.dumps(payload))
    (tmp_path / "bad.json").write_text("{not json")
    d = facts.read_company_facts(spark, str(tmp_path))
    assert d.count() == 12
    kept = facts.preferred_namespace(d)
    assert {(r.namespace, r.concept) for r in kept.select("namespace", "concept").distinct().collect()} == {("us-gaap", "Assets"), ("aaa", "Odd")}
    assert [r.val for r in facts.usable(kept, False).filter("concept = 'Assets'").collect()] == [5.0]
    assert [r.val for r in facts.usable(kept, True).filter("concept = 'Assets'").collect()] == [7.0]


def test_filings(spark, tmp_path):
    recent = {"form": ["10-Q", "8-K", "10-K"], "filingDate": ["2024-05-01", "2024-05-02", "bad"], "reportDate": ["2024-03-31", "", ""], "accessionNumber": ["a", "b", "c"], "primaryDocument": ["p", "q", "r"]}
    (tmp_path / "s.json").write_text(json.dumps({"name": "N", "filings": {"recent": recent}}))
    rows = facts.read_filings(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r.form, str(r.filed), r.seq) for r in rows] == [("10-Q", "2024-05-01", 0), ("10-K", "None", 2)]
    pairs = spark.createDataFrame([("a", 12), ("b", 5)], "ticker string, cik long")
    ids = facts.zero_padded_ids(pairs, spark.createDataFrame([("b", 77)], "ticker string, cik long"))
    assert {(r.ticker, r.cik) for r in ids.collect()} == {("A", "0000000012"), ("B", "0000000077")}


HTML = """<html><p>x</p>
<table><tr><th colspan=2>Portfolio Company</th><th>Fair Value</th></tr><tr><td>Acme &amp; Co<br>Inc</td><td>5,000</td></tr><tr><td>a<table><tr><td>inner</td></tr></table></table>
<table><tr><td>tiny</td></tr></table></html>"""


def test_html_tables(spark):
    pages = spark.createDataFrame([("d", HTML), ("e", None), ("f", "<table><tr><td>no end " + "x" * 60)], "doc string, html string")
    rows = documents.html_tables(pages, "doc", "html", least=20).orderBy("doc").collect()
    assert [r.doc for r in rows] == ["d", "f"] and rows[0].pos == HTML.index("<table>")
    assert rows[0].grid == [["Portfolio Company", "Portfolio Company", "Fair Value"], ["Acme & Co Inc", "5,000", ""], ["ainner", "", ""]]
    pad = documents.html_tables(pages, "doc", "html", repeat=False, least=20).filter("doc = 'd'").first()
    assert pad.grid[0] == ["Portfolio Company", "", "Fair Value"]
    t = documents.html_tables(pages, "doc", "html", least=20)
    assert documents.cells(t).filter("doc = 'd' and r = 0").count() == 3
    assert t.filter(documents.is_investment_table(F.col("text"))).count() == 1
    texts = [("A Borrower of ours", True), ("the OBLIGOR", True), ("spread and SOFR, 5 percent, Oak Holdings", True), ("spread and SOFR, 5 percent", False), ("maturity of $5 at Oak LLC", False), ("", False)]
    df = spark.createDataFrame([(t,) for t, _ in texts], "t string")
    assert [r[0] for r in df.select(documents.is_investment_table(F.col("t"))).collect()] == [w for _, w in texts]
    seq = spark.createDataFrame([("d", i, p) for i, p in enumerate([False, True, False])] + [("e", 0, True)], "doc string, idx long, prior boolean")
    assert documents.before_prior_year(seq, F.col("prior")).count() == 2


XML = """<x:xbrl xmlns:x="u" xmlns:d="v"><x:context id="c1"><x:entity><x:segment><d:explicitMember dimension="axis">Acme Member</d:explicitMember></x:segment></x:entity>
<x:period><x:instant>2024-03-31</x:instant></x:period></x:context><x:context id="c2"><x:period><x:startDate>2024-01-01</x:startDate><x:endDate>2024-03-31</x:endDate></x:period></x:context>
<d:FairValue contextRef="c1" unitRef="USD" decimals="-3">5000</d:FairValue><d:Total contextRef="c2">9</d:Total></x:xbrl>"""


def test_xbrl(spark):
    d = spark.createDataFrame([("f", XML), ("g", None)], "doc string, xml string")
    contexts, found = documents.xbrl_contexts(d, "doc", "xml"), documents.xbrl_facts(d, "doc", "xml")
    assert contexts.count() == 2 and found.count() == 2
    p = documents.positions(contexts, found, "2024-03-31").collect()
    assert [(r.concept, r.value, r.dimensions) for r in p] == [("FairValue", "5000", {"axis": "Acme Member"})]


def test_under_headings(spark):
    kinds = [("a", "tTthtpts tht"), ("b", "ttoo"), ("c", "hp"), (None, "ht")]
    rows = [(d, i, k) for d, ks in kinds for i, k in enumerate(ks)] + [("d", 0, None)]
    e = spark.createDataFrame(rows, "doc string, pos long, kind string")
    k = F.col("kind")
    got = documents.under_headings(e, "doc", "pos", k == "h", k == "s", k.isin("t", "p", "o", "T"), k == "p", k == "o")
    assert got.columns == e.columns
    assert sorted((r.doc or "", r.pos) for r in got.collect()) == [("", 1), ("a", 4), ("a", 11), ("b", 2), ("b", 3)]
    assert documents.under_headings(e.limit(0), "doc", "pos", k == "h", k == "s", k == "t", k == "p", k == "o").count() == 0


def test_quotes(spark):
    bodies = ['{"longName": "", "shortName": null, "currentPrice": 0, "regularMarketPrice": 3.5, "bid": "x"}', None, "", "[]"]
    got = facts.market_quotes(spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "ticker string, payload string")).orderBy("ticker").collect()
    assert [(r.name, r.currency, r.current_price) for r in got] == [("0", "USD", 3.5), ("1", "USD", None), ("2", "USD", None), ("3", "USD", None)]


def test_around_maturity(spark):
    from holdwright.operators import filings

    rows = [["S + 5%", "3/31/2027", "1", "2", "3"], ["a", "Sept 2027", "7"], ["n/a"], [None, "", "10-2027", "-"], [], None, ["x", "1"]]
    got = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, cells array<string>").select("i", filings.around_maturity(F.col("cells")).alias("r")).orderBy("i").select("r.*").collect()
    assert [(r.rate, r.maturity, r.principal, r.cost, r.fair_value) for r in got[:5]] == [
        (["S + 5%"], "2027-03-31", 1, 2, 3), (["a"], "2027-09-01", None, None, 7), ([], None, None, None, None), ([], "2027-10-01", None, None, 0), ([], None, None, None, None),
    ]
    assert got[5].maturity is None and got[5].fair_value is None and got[6].rate == ["x", "1"]


def test_broken_instance_has_no_rows(spark):
    split = XML.replace("Acme Member", "<d:a>Category</d:a> <d:b>Acme LLC</d:b>")
    df = spark.createDataFrame([("good", XML), ("cut", XML[: len(XML) // 2]), ("text", "no xml at all"), ("null", None), ("empty", ""), ("split", split)], "doc string, xml string")
    whole = lambda f: {r["doc"] for r in f(df, "doc", "xml").collect()}
    assert whole(documents.xbrl_contexts) == {"good", "split"}
    assert whole(documents.xbrl_facts) <= {"good", "split"}
    dims = documents.xbrl_contexts(df, "doc", "xml").filter("doc = 'split' and size(dimensions) > 0").first()["dimensions"]
    assert list(dims.values()) == ["Category | Acme LLC"]
