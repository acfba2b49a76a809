"""freshet: Spark-native checks for building, diagnosing and repairing event pipelines.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
built-in Spark expressions, so Catalyst can prune, push down and plan it.
"""

__version__ = "0.1.0"
