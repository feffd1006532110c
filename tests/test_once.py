"""How often a plan works a thing out, and over how many tasks."""

from pyspark.sql import functions as F

from holdwright import plans
from holdwright.functions import credit, rates
from holdwright.operators import filings, grids


def shown(capsys, df):
    df.explain("extended")
    return capsys.readouterr().out


def test_cells_are_cut_once(spark, capsys):
    cell = spark.createDataFrame([("SOFR + 5.75%, Floor 0.75%",)], "x string").select(F.concat("x", F.lit("")).alias("x")).cache()
    plan = lambda c: shown(capsys, cell.select(c.alias("c"))).split("== Optimized")[0].split("== Analyzed")[1]
    assert plan(rates.parse(F.col("x"))).count("regexp_extract_all") == 1
    assert plan(rates.of_terms(F.col("x"))).count("regexp_extract_all") == 1
    assert plan(credit.extract(F.col("x"))).count("regexp_extract_all") == 1
    # The first cell that is a maturity is looked for once.
    assert plan(filings.around_maturity(F.array("x"))).count(r"|n/?a|") == 1
    # Heads are worked out once, though three columns may be added by place.
    assert plan(grids.fields_of_heads(F.array(F.upper("x")))).count("upper(") == 1


def test_rows_that_take_long_are_dealt(spark, sf, capsys):
    for name in ("credit_texts", "header_fields", "dimension_strings", "recovered_names", "standardized_rows", "clean_companies", "rate_cells_read"):
        assert "RepartitionByExpression" in shown(capsys, plans.queries()[name](spark, sf)), name
