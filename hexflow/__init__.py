"""hexflow: road-traffic analytics on Spark.

Subpackages: ``functions`` (Column expressions), ``operators`` (DataFrame
transforms shared by batch and stream), ``sources`` (inputs, table sinks),
``streaming`` (Structured Streaming jobs), ``plans`` (query compositions,
dashboard, maintenance, the query registry and its SQL twins).
"""

__version__ = "0.1.0"
