"""Retail demand analytics on Spark DataFrames.

Every public operator takes a DataFrame and returns a DataFrame.  Operators never start or stop a
session, never collect data rows to the driver and use no Python UDFs.
"""

__version__ = "0.1.0"
