"""The given model that queries score with, so that their oracles need no fit."""

from __future__ import annotations

from pyspark.sql import DataFrame

from buyerlens.operators import preprocess, scoring
from buyerlens.operators.clustering import CentroidModel

# Parameters of a given model: centroids in the prepared space, column order as
# the preparation puts it out, and labels for three of its four segments.
CENTRES = [
    [-1.0, 1.5, 1.0, 0.3, 0.2, 1.6],
    [0.8, -0.6, -0.9, -0.8, -0.7, -0.4],
    [0.5, -0.5, 0.8, 1.0, 0.9, -0.4],
    [-1.2, -0.6, -0.1, 0.1, 0.0, -0.5],
]
LABELS = {0: "champions", 1: "hibernating", 2: "big_spenders"}
STAMP = "2001-08-06 07:00:00"


def given_model(features: DataFrame) -> scoring.SegmentModel:
    """The given centroids behind a preparation fitted on these features."""
    prepared = preprocess.fit_preprocessor(features)
    return scoring.SegmentModel(prepared, CentroidModel(prepared.outputs, CENTRES), LABELS, version="7")
