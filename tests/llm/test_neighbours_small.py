"""Small tables: all neighbours that are due are found."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.neighbours import nearest


@pytest.mark.parametrize("n", [16, 24])
def test_small_tables_are_searched_whole(spark, n):
    vectors = np.random.default_rng(n).normal(size=(n, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(df, F.lit(True)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    scores = vectors @ vectors.T
    assert got == {i: set([j for j in np.argsort(-scores[i]).tolist() if j != i][:20]) for i in range(n)}
