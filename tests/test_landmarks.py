"""Landmarks of many groups."""

import numpy as np
from pyspark.sql import functions as F

from cairn.operators import distance


def test_more_groups_than_before(spark):
    """Six hundred groups are six hundred landmarks, in order; null groups are none."""
    rows = spark.range(1800).select(F.when(F.col("id") < 1797, F.col("id") % 600).alias("g"), F.array(F.col("id") * 1.0, F.lit(1.0)).alias("v"))
    labels, x = distance.landmarks(rows, "g", "v")
    assert labels == list(range(600)) and x.shape == (600, 2)
    assert np.allclose(x[:590, 0], np.arange(590) + 600)


def test_the_largest_groups_are_landmarks(spark, monkeypatch):
    monkeypatch.setattr(distance, "MAX_LANDMARKS", 3)
    rows = spark.range(21).select(F.floor((F.sqrt(8 * F.col("id") + 1) - 1) / 2).alias("g"), F.array(F.lit(1.0)).alias("v"))
    assert distance.landmarks(rows, "g", "v")[0] == [3, 4, 5]
