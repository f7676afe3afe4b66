"""A Spark-native analytics engine for tick and candle market data."""

__version__ = "0.1.0"
