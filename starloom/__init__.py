"""starloom: incremental star-schema warehousing with PySpark DataFrames.

Sub-packages
------------
functions   column expressions (text, numbers, dates, code lookups)
operators   DataFrame -> DataFrame building blocks
sources     readers and writers
plans       business questions, SQL views, overview tables, the batch load
streaming   file-arrival driven batch load
catalogue   every operator bound to a set of TPC-H shaped tables
"""
