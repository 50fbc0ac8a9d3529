"""eventide: event-driven recommendation analytics as Spark DataFrame jobs.

Every operator is a plain ``DataFrame -> DataFrame`` function built from Spark
SQL expressions, windows, joins and aggregates, so Catalyst plans it and the
same code runs on a laptop or a large cluster.
"""

__version__ = "0.1.0"
