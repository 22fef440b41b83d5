"""fiscalgrove: a Spark-native engine for hierarchical, multi-record fiscal files.

Every operator takes and returns DataFrames and stays lazy; the only actions are
in ``sources.tables`` (writes) and ``streaming`` (micro-batch handlers).
"""

__version__ = "0.1.0"
