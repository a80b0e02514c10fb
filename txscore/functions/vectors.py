"""Probability vectors without Python UDFs."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def class_probability(vector: Column, index: int) -> Column:
    return vector_to_array(vector)[index]


def probability_vector(positive: Column) -> Column:
    """(1 - p, p) as an ML vector."""
    return array_to_vector(F.array(F.lit(1.0) - positive, positive))
