"""threadloom: forum pages and post tables into dialogue training data, on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark's own column expressions, usable with ``df.transform``.
"""

__version__ = "0.1.0"
