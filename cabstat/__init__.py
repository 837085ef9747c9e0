"""cabstat: paired trip-feed enrichment and aggregation on PySpark.

Every operator is a function from DataFrame(s) to a DataFrame built from
Spark's own expressions, so the same code serves batch and Structured
Streaming inputs.
"""

__version__ = "0.1.0"
