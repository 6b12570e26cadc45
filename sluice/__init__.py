"""sluice: batch data preparation for Spark.

Scan raw text sources, clean them, reshape list columns, enrich facts with
dimensions, and publish the resulting tables. Every transform takes and returns
a lazy ``DataFrame``; only the sinks and ``sluice.plans`` start jobs.
"""
