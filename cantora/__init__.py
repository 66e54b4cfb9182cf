"""Music-catalog and lyrics analytics as Spark DataFrame jobs.

``sources``    landed files and relational tables in and out
``functions``  Column -> Column text, coercion, metric and claim functions
``operators``  DataFrame -> DataFrame joins, matching, loading, marts
``plans``      canned analyses, stand-in model over the driver tables, pipeline
``streaming``  incremental ingest of newly landed files
"""
