"""Normal tail and Shapiro-Wilk against independent values; ties in ordered statistics."""

import math

from pyspark.sql import functions as F

from txscore.functions import distributions as D
from txscore.operators import ordered
from txscore.operators import stats as ST


def test_normal_tail_to_double_precision(spark):
    z = [i / 8 for i in range(-64, 200)]
    df = spark.createDataFrame([(v,) for v in z], "z double").select("z", F.expr(D.norm_sf_sql("z")).alias("p"))
    for r in df.collect():
        want = 0.5 * math.erfc(r.z / math.sqrt(2))
        assert abs(r.p - want) <= 1e-12 * want, (r.z, r.p, want)


def test_shapiro_wilk_of_the_published_example(spark):
    """The weights of eleven men of the original paper; R prints W = 0.78881, p = 0.006704."""
    x = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    df = spark.createDataFrame([("a", float(v)) for v in x], "g string, x double")
    r = ST.shapiro_wilk(df, ["g"], "x").first()
    assert abs(r.w - 0.78881) < 1e-5 and abs(r.p_value - 0.006704) < 1e-6 and not r.normal


def test_ranks_of_a_value_that_most_rows_share(spark, monkeypatch):
    monkeypatch.setattr(ordered, "TIE_CHUNK", 7)
    rows = [("a", 0.0)] * 500 + [("a", float(i)) for i in range(-20, 20)] + [("b", 1.0)] * 3 + [(None, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = sorted(((r.g or "", r.rn, r.x) for r in ordered.value_ranks(df, ["g"], "x").collect()))
    want = []
    for g in ("", "a", "b"):
        values = sorted(x for h, x in rows if (h or "") == g)
        want += [(g, i + 1, x) for i, x in enumerate(values)]
    assert got == want
    sw = {r.g: r.n for r in ST.shapiro_wilk(df, ["g"], "x").collect()}
    assert sw == {"a": 540, "b": 3}
