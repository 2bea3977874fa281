"""ledgerlake: a Spark-native payments analytics engine.

Stream screening, Bronze/Silver/Gold layers, marts, data-quality checks and
reports, written with the DataFrame API, Spark SQL and Structured Streaming.
"""

__version__ = "0.1.0"
