"""kbforge: a Spark-first engine for building, curating and searching knowledge bases."""

__version__ = "0.1.0"
