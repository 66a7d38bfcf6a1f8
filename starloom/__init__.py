"""starloom: star-schema analytics on Spark DataFrames.

Sub-packages
------------
sources    readers, writers and the code-dictionary parser
functions  Column -> Column expressions (no Python UDFs)
operators  DataFrame -> DataFrame building blocks (joins, aggregates, checks)
plans      composed jobs: staging, star tables, the OLAP question, driver mappings
streaming  incremental refresh of the fact table with Structured Streaming
"""

__version__ = "0.1.0"
