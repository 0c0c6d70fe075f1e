"""aerolag: delay features, profiling, training sets and evaluation on Spark.

Every operator is a function from DataFrame to DataFrame (usable with
``df.transform``) or a ``pyspark.ml`` stage. Nothing keeps global state.
"""

__version__ = "0.1.0"
