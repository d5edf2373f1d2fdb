"""tierlake: tiered ERP-extract processing (landing -> staging -> final) on Spark.

Every operator is a function from DataFrames (and small spec objects) to a
DataFrame; Catalyst plans the work.  Modules:

* ``functions``  - Column expressions (tolerant casts, text helpers, templates)
* ``operators``  - dedup, change preview, upserts, routing, audits, recon
* ``sources``    - landing CSV, ZIP, JSON pages, XML rowsets, file catalog, snapshot store
* ``plans``      - declarative entity specs and the per-file load/preview/merge flow
* ``streaming``  - file-arrival ingest with Structured Streaming
"""

__version__ = "0.1.0"
