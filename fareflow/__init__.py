"""fareflow: travel-fare history analytics as plain PySpark DataFrame functions.

Every operator takes DataFrames and returns a DataFrame.  Expressions stay in
built-in Spark SQL functions, so Catalyst sees the whole plan; there is no
Python UDF anywhere in the package.
"""

__version__ = "0.1.0"
