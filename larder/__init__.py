"""larder — a Spark-native engine for packaged-product catalogue analytics.

Functions take and return DataFrames; Column helpers take and return Columns.
"""

__version__ = "0.1.0"
