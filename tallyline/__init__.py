"""tallyline: order/delivery and ledger analytics as Spark DataFrame operators.

Every operator is a plain function from DataFrames (plus column names and
parameters) to a DataFrame.  Nothing is collected to the driver; all work is
expressed with built-in Spark expressions, joins, aggregations and windows so
that Catalyst/AQE plan it.
"""

__all__ = ["session"]
