"""Distributed running sums: a hot group spanning many range chunks."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from jobsheet.operators.prefix import prefix_sums


def test_prefix_sums_hot_group(spark):
    rng = np.random.default_rng(5)
    # group 'hot' holds ~1/3 of the keys plus many small groups
    rows = [("hot", float(k), int(rng.integers(1, 5))) for k in range(3000)]
    rows += [(f"g{i % 50}", float(k), int(rng.integers(1, 5))) for i, k in enumerate(range(6000))]
    df = spark.createDataFrame(rows, "g string, x double, c long")
    out = prefix_sums(df, ["g"], "x", ["c"], partitions=16).toPandas()
    ref = pd.DataFrame(rows, columns=["g", "x", "c"]).sort_values(["g", "x"])
    ref["cum"] = ref.groupby("g")["c"].cumsum()
    ref["tot"] = ref.groupby("g")["c"].transform("sum")
    m = out.merge(ref, on=["g", "x"])
    assert len(m) == len(rows)
    assert (m["cum_c"] == m["cum"]).all() and (m["tot_c"] == m["tot"]).all()
    desc = prefix_sums(df, ["g"], "x", ["c"], descending=True, partitions=16).where(F.col("g") == "hot")
    first = desc.orderBy(F.desc("x")).first()
    assert first["cum_c"] == first["c"]


def test_exact_quantiles(spark):
    import numpy as np

    from jobsheet.operators.prefix import exact_quantiles
    rng = np.random.default_rng(2)
    rows = [(g, float(v)) for g, n in (("a", 101), ("b", 40), ("c", 1)) for v in rng.integers(0, 30, n)] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    qs = {"q0": 0.0, "q5": 0.5, "q95": 0.95, "q1": 1.0}
    for r in exact_quantiles(df, "v", qs, ["g"]).collect():
        own = [v for g, v in rows if g == r.g and v is not None]
        assert np.allclose([r[n] for n in qs], np.quantile(own, list(qs.values())))
    one = exact_quantiles(df, "v", {"m": 0.5}).collect()
    assert len(one) == 1 and np.isclose(one[0].m, np.median([v for _, v in rows if v is not None]))
    assert exact_quantiles(df.where("g = 'd'"), "v", {"m": 0.5}).first().m is None
