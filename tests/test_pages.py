"""Pages of plain tags are read without the parser, with its events; heads of a table without windows over its rows."""

import random

from holdwright.operators import grids
from holdwright.sources import documents

PLAIN = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th colspan='3'>", "<TD COLSPAN='2' colspan=\"4\">", "<td colspan=''>", "<br>", "text", "&amp;", "&lt", "a & b", "\n", " > ", "<p>"]
OTHER = ["<br/>", "<td colspan='&#50;'>", '<div id="a>b">', "<!-- c -->", "<script>x<y</script>", "<title>t", "</title>", "<td colspan=3>", "< x", "</td >"]


class Parsed(documents._Tables):
    def read(self, html):
        for part in html.split("\n")[:-1]:
            self.line.append(self.line[-1] + len(part) + 1)
        self.feed(html)
        self.close()
        self._end_cell()
        return self.found


def test_plain_pages_read_as_parsed(monkeypatch):
    choose = random.Random(7)
    for some in (PLAIN, PLAIN + OTHER):
        for _ in range(3000):
            html = "<table>" + "".join(choose.choice(some) for _ in range(choose.randint(1, 25)))
            assert documents._Tables().read(html) == Parsed().read(html), html
    want = Parsed().read("<table><tr><td>a</td></tr></table>")
    monkeypatch.setattr(documents._Tables, "feed", lambda self, html: 1 / 0)
    assert documents._Tables().read("<table><tr><td>a</td></tr></table>") == want


def test_heads_are_found_within_a_table(spark, capsys):
    body = ["A", "1"]
    rows = [
        ("p", 0, [["A title", ""], ["Portfolio Company", "Fair Value"], body, ["Issuer", "Cost"]]),
        ("p", 1, [["Portfolio Company", ""], ["", "Fair Value"], body]),
        ("q", 0, [["x", "y"], ["7", "8"]]),
        ("q", 1, []),
    ]
    df = grids.with_heads(spark.createDataFrame(rows, "doc string, idx long, grid array<array<string>>"))
    got = sorted((r.doc, r.idx, r.r, r.row, sorted(r["at"].items())) for r in df.collect())
    at = [("company_name", 0), ("fair_value", 1)]
    # A sparse row of heads takes the row below it in, as it did.
    assert got == [("p", 0, 3, ["Issuer", "Cost"], at), ("p", 1, 2, body, at)]
    df.explain()
    assert "Window" not in capsys.readouterr().out


def _plain_page(choose):
    html = "é<html>" if choose.random() < 0.3 else ""
    for _ in range(choose.randint(0, 3)):
        html += choose.choice(["", "x<p>", "&"]) + "<table>"
        for _ in range(choose.randint(0, 4)):
            cell = lambda: choose.choice(["<td>", "<th>", "<td colspan='3'>", '<TH class="b" colspan="2">']) + choose.choice(["", "x", "x y", " a  b", "é", "&amp;&lt", "5>3", " z"]) + choose.choice(["</td>", ""])
            html += "<tr>" + "".join(cell() for _ in range(choose.randint(0, 4))) + choose.choice(["</tr>", ""]) + choose.choice(["\n", ""])
        html += "</table>"
    return html


def test_many_plain_pages_read_as_parsed(spark, monkeypatch):
    """Tables of plain pages, read many at once, are those of the parser, which reads the others."""
    choose = random.Random(11)
    odd = lambda: "".join(choose.choice([*PLAIN, *OTHER, "<table>", "</table>"]) for _ in range(choose.randint(0, 15)))
    pages = [None, "", *[_plain_page(choose) if choose.random() < 0.7 else odd() for _ in range(1500)]]
    df = spark.createDataFrame(list(enumerate(pages)), "k int, html string").repartition(3)
    for repeat, least in ((True, 0), (False, 5)):
        want = []
        for k, page in enumerate(pages):
            n = 0
            for pos, rows in Parsed().read(page) if page else []:
                grid = [[t if repeat or i == 0 else "" for t, span in row for i in range(span)] for row in rows]
                text = " ".join(t for row in rows for t, _ in row if t)
                if len(text) >= least:
                    want.append((k, n, pos, text, [r + [""] * (max(map(len, grid)) - len(r)) for r in grid]))
                    n += 1
        got = documents.html_tables(df, "k", "html", repeat=repeat, least=least).collect()
        assert sorted((int(r.doc), r.idx, r.pos, r.text, r.grid) for r in got) == want
    # Plain pages don't come to the parser.
    data = "<table><tr><td>a</td></tr></table>é<table><tr><th colspan='2'>b</th></tr></table>".encode()
    left, page, columns = documents._plain_tables(documents.np.frombuffer(data, "uint8"), documents.np.array([0, len(data)]), False, {})
    assert not left.any() and page.tolist() == [0, 0] and columns["grid"].to_pylist() == [[["a"]], [["b", ""]]] and columns["pos"].to_pylist() == [0, 35]


def test_heads_are_worked_out_once_a_table(spark, tmp_path):
    """No filter on heads, nor on rows below them, is moved under the step that works them out; what is dealt by document are rows."""
    path = str(tmp_path / "t")
    spark.createDataFrame([("p", 0, [["Issuer", "Cost", "Fair Value", "Maturity Date"], ["Maple Holdings", "1", "2", "1/31/2024"]])], "doc string, idx long, grid array<array<string>>").write.parquet(path)
    tables = spark.read.parquet(path)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(grids.with_heads(tables)).count("aggregate(transform(grid") == 1
    whole = plan(grids.records(tables))
    assert whole.count("aggregate(transform(grid") == 1
    assert "RLIKE" not in whole.split("RepartitionByExpression")[0]
    assert [(r.company_name, r.cost) for r in grids.records(tables).collect()] == [("Maple Holdings", 1.0)]
