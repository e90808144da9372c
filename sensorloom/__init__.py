"""sensorloom: measurements of fixed sensor networks, analysed as Spark DataFrames."""

__version__ = "0.1.0"
