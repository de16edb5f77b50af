"""Nearest rows by dense features and counts: both rankings of one pass."""

import numpy as np
import pandas as pd
import pytest

from essayspark.operators import knn as K


@pytest.mark.parametrize("whole", [True, False])
def test_neighbours_of_counts_from_one_pass(spark, whole):
    """Both rankings of one pass against plain sorting; whole counts take the float32 product, others do not."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(90):
        idx = sorted(rng.choice(12, size=int(rng.integers(0, 8)), replace=False).tolist())
        val = [float(v) if whole else float(v) + 0.25 for v in rng.integers(1, 6, len(idx))]
        rows.append((i, "ab"[i % 3 == 0], [float(i % 7), float(rng.normal())], idx, val, 12, i % 4, i % 5))
    df = spark.createDataFrame(rows, "id int, g string, x array<double>, idx array<int>, val array<double>, width int, label int, fold int")
    full = np.zeros((90, 14))
    for i, _, x, idx, val, *_ in rows:
        full[i, :2] = x
        full[i, [2 + j for j in idx]] = val
    sparse = ("idx", "val", "width")
    got = K.neighbours(df.withColumnRenamed("id", "q"), df, 4, qkey="q", tkey="id", vec="x", label="label", group="g", fold="fold", rows_per_block=16,
                       sparse=sparse, every=True).collect()
    found = {}
    for r in got:
        found.setdefault((r.q, r.across), {})[r["rank"]] = r.id
    for i in range(90):
        for across in (True, False):
            near = [(round(float(((full[i] - full[j]) ** 2).sum()), 9), j) for j in range(90) if rows[j][1] == rows[i][1] and not (across and rows[j][7] == rows[i][7])]
            assert [found[i, across][r] for r in range(1, 5)] == [j for _, j in sorted(near)[:4]]
    pdf = pd.DataFrame(rows, columns=["id", "g", "x", *sparse, "label", "fold"])
    assert (K._whole_counts(pdf, pdf, sparse) is not None) == whole
    big = pdf.assign(val=[[5000.0] * len(v) for v in pdf["val"]])
    assert K._whole_counts(big, big, sparse) is None  # products beyond 2^24 are not exact in float32
