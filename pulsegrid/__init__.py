"""Product-telemetry analytics as Spark jobs.

``functions``  column expressions (no DataFrame needed)
``operators``  DataFrame -> DataFrame transformations
``sources``    readers, table writes, exports
``plans``      whole table builds: read, compute, write a date window
``streaming``  Structured Streaming ingest
"""
