"""tablesmith: a Spark-native engine for the life of a tabular dataset.

Cleaning, schema validation, profiling, exact stratified splitting, drift between two samples,
preprocessing fitted on the training part, MLlib classifiers and threshold evaluation. Every operator takes a
DataFrame plus column lists and returns a DataFrame built from DataFrame / SQL expressions.
"""

from tablesmith.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
