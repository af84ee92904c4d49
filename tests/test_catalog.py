import datetime as dt

from pyspark.sql import functions as F

from lakeledger.functions import catalog as C


def _one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(col("v").alias("r")).first()["r"]


def test_valid_month(spark):
    cases = {"202608": True, "199901": True, "999999": False, "202613": False, "202600": False,
             "": False, None: False, "202608\n": False, "2026081": False, "1899-1": False}
    for v, want in cases.items():
        assert _one(spark, C.valid_month, v) is want, v


def test_previous_month(spark):
    assert _one(spark, lambda c: C.previous_month(c), dt.date(2026, 3, 31), "date") == "202602"
    assert _one(spark, lambda c: C.previous_month(c), dt.date(2026, 1, 15), "date") == "202512"


def test_table_name_rules(spark):
    df = spark.createDataFrame([("d_ranking_detail_202401_us",), ("d_ranking_detail_999999_us",),
                                ("x_ranking_detail_202401_us",), ("d_ranking_detail_2024_us",)], "n string")
    rows = df.select(C.known_table("n").alias("k"), C.month_in_name("n").alias("m")).collect()
    assert [(r.k, r.m) for r in rows] == [(True, "202401"), (True, "999999"), (False, "202401"), (False, "")]


def test_plan_units_expands_without_join(spark):
    from lakeledger.operators import export
    months = spark.createDataFrame([("202401",), ("bogus",), (None,)], "month string")
    plan = export.plan_units(months)
    assert plan.count() == 12 * 16
    assert plan.select("server").distinct().count() == 12
    assert plan.where(F.col("table_name") == "m_ranking_url_202401_us").count() == 12
    assert "Join" not in plan._jdf.queryExecution().executedPlan().toString()
