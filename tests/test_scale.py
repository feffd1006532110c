"""What a plan of holdings shuffles."""

import re

from pyspark.sql import functions as F

from holdwright.plans import binding


def shown(capsys, df, mode="formatted"):
    df.explain(mode)
    return capsys.readouterr().out


def test_lines_are_not_shuffled_by_customer(spark, sf, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = shown(capsys, binding.holdings(spark, sf).groupBy("ticker").agg(F.sum("fv"), F.max("company")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = dict(re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\(([a-z_]+)#", plan)[::-1])
    moved = {key: cols for cols, key in moved.items()}
    assert "l_" not in moved["o_custkey"]
    # A line goes by its figures' results, not by what they are made of.
    assert not any("l_extendedprice" in cols or "l_discount" in cols for cols in moved.values())
