"""tagweave: customer tagging on Spark DataFrames.

A tag catalog (a five-level tree) says where the source data is (level 4) and which
value earns which tag (level 5).  The library matches users against those rules with
column expressions and broadcast joins, merges the result with each user's earlier
tags, and upserts it by key into a versioned Parquet store.

Layout:
  sources/    catalog scans, the wide-column ("cells") source, the versioned tag store
  functions/  column expressions: rule strings, schedules, tag lists
  operators/  lookups, matching, merging, id assignment, catalog maintenance jobs
  plans/      tag-model specs and the end-to-end ``run()`` job
  streaming/  the scheduled (micro-batch) form of ``run()``
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
