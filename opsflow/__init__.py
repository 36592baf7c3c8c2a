"""opsflow: DataFrame operators for operational order data on Spark.

Every operator is a plain function from DataFrames to a DataFrame. Times come
in as an explicit ``as_of``, row order as an explicit ``order_by``; nothing
reads a clock and nothing collects rows to the driver.
"""

__all__ = ["operators", "sources", "functions", "plans", "streaming"]
