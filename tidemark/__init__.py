"""tidemark: table replication and change data capture as Spark jobs.

Layout

- ``functions``  Column expressions (literals, log positions, status text, buckets)
- ``sources``    scans of source tables, column catalogs and change logs
- ``operators``  DataFrame-to-DataFrame work: log parsing, merging, schema comparison
- ``plans``      table store, control tables, monitoring reports and sync flows
- ``streaming``  the same work driven by Structured Streaming
"""

__version__ = "0.1.0"
