"""Histograms and molten tables."""

import math

from pyspark.sql import functions as F

from covaria.operators import explore


def table(spark):
    rows = [(float(i % 17), i * 0.37 - 20, None if i % 4 else -3.0, 5.0, None) for i in range(400)] + [(float("nan"), float("inf"), 1e6, 5.0, None)]
    return spark.createDataFrame(rows, "`it's` double, `b``c.d` double, x double, same double, none double")


def test_histogram_counts_every_finite_value_once(spark):
    df = table(spark)
    got = explore.histogram(df, df.columns)
    assert "Generate" not in got._jdf.queryExecution().toString()
    rows = got.collect()
    for i, name in enumerate(df.columns):
        values = [r[i] for r in df.collect() if r[i] is not None and math.isfinite(r[i])]
        bins = {r.bin_start: r.n for r in rows if r.covariate == name}
        if not values:
            assert not bins
            continue
        step = explore.nice_step(min(values), max(values))
        want = {}
        for v in values:
            want[math.floor(v / step) * step] = want.get(math.floor(v / step) * step, 0) + 1
        assert bins == want and all(r.bin_end > r.bin_start for r in rows)
    assert explore.histogram(df.limit(0), df.columns).count() == 0


def test_molten_names_are_not_read_as_sql(spark):
    df = table(spark)
    got = explore.melt(df.limit(3).withColumn("id", F.lit(1)), df.columns, ["id"])
    assert {r.covariate for r in got.collect()} == set(df.columns) and got.count() == 15 and got.columns == ["id", "covariate", "value"]
