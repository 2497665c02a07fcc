"""pageops: page corpora, keyed records, contact text and validated attempts
as Spark DataFrame transforms."""

__version__ = "0.1.0"
