"""zoneflow: operational event analytics on PySpark.

Raw event records, hourly context and a zone lookup become a canonical event
table, a one-row-per-event fact table, a zone-hour feature table and the marts,
reports, audits, tests and models built on it.  Operators are plain functions
from DataFrame to DataFrame made of native Spark SQL expressions.
"""

__version__ = "0.1.0"
