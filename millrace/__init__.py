"""millrace: ingestion, data-quality and observability operators for PySpark.

Every operator is a function from DataFrames to a DataFrame, so it composes
with ``DataFrame.transform`` and stays lazy until the caller runs an action.
"""

__version__ = "0.1.0"
