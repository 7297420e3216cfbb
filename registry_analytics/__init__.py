"""Spark-native analytics for business and taxpayer registries.

Every operator is a lazy DataFrame / Spark SQL expression that takes column
names as parameters, so the same code runs on any table at any scale.

Layout
------
functions/  column -> column expressions (strip, normalise codes, parse numbers, format)
operators/  DataFrame -> DataFrame operators (profiles, dedup, rules, dimensions, joins)
sources/    readers and writers (CSV, JDBC, parquet tables, long-form results store)
plans/      the registry jobs and reports composed from the operators
streaming/  nothing: the registry work is batch only (see its docstring)
"""

__version__ = "0.1.0"
