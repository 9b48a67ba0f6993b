"""ledgerlens — business analytics operators on PySpark DataFrames.

Every operator takes Spark DataFrames and column names and returns a
DataFrame; the heavy work stays in Catalyst/Tungsten (built-in functions,
joins, aggregations, windows).  Driver-side code only ever touches
results whose size is bounded by construction (a handful of scalars,
one row per partition, one row per group of a bounded dimension).
"""

__version__ = "0.1.0"
