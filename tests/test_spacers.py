"""Tables without spacers: as grids they give what they give as cells, and a query over grids shuffles its lines once."""

import random

from pyspark.sql import functions as F

from holdwright import plans
from holdwright.operators import grids

TEXTS = ["", "", "", None, " ", "%", "%", "$", "$", "5", " a b ", "x", "é%"]
HEADS = ["", "", None, "Name", "Spread", "$", "Coupon Rate", "interest"]


def test_grids_read_as_cells(spark):
    choose, tables = random.Random(3), [[], [[]], [["", ""], ["", ""]], [["%", "n", "$", "%"], ["%", "A", "$", "%"]], [["n"]]]
    for _ in range(400):
        wide, long = choose.randint(1, 7), choose.randint(0, 7)
        tables.append([[choose.choice(HEADS) for _ in range(wide)], *[[choose.choice(TEXTS) for _ in range(wide)] for _ in range(long)]])
    cells = [("d", k, r, c, t) for k, g in enumerate(tables) for r, row in enumerate(g) for c, t in enumerate(row)]
    sizes = [("d", k, len(g)) for k, g in enumerate(tables)]
    want = grids.drop_spacers(spark.createDataFrame(cells, "doc string, idx int, r int, c int, text string"), spark.createDataFrame(sizes, "doc string, idx int, n_rows int")).collect()
    df = spark.createDataFrame(list(enumerate(tables)), "k int, grid array<array<string>>")
    got = df.select("k", grids.without_spacers(F.col("grid")).alias("grid")).collect()
    assert {(x.k, r, c): t for x in got for r, row in enumerate(x.grid) for c, t in enumerate(row) if t} == {(x.idx, x.r, x.c): x.text for x in want}
    assert all(len(x.grid) == len(tables[x.k]) and len({len(row) for row in x.grid}) < 2 for x in got)


def test_lines_are_shuffled_once(spark, sf, capsys):
    df = plans.queries()["spacer_columns"](spark, sf)
    df.explain()
    shown = capsys.readouterr().out.split("Initial Plan")[-1]
    assert shown.count("Exchange hashpartitioning") == 1 and "Generate" not in shown and "Join" not in shown
