"""docweave: standing queries over XML, HTML and RSS documents on Spark.

Sub-packages: ``sources`` (readers, sinks), ``functions`` (column expressions
and per-row helpers), ``operators`` (DataFrame operators), ``plans``
(registered queries and their SQL twins), ``streaming`` (Structured Streaming
jobs).
"""
