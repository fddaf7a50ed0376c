"""Training-data operators: sharding, filters, models, deduplication, archives.

Nothing outside this subpackage imports it, and every operator takes and
returns DataFrames.  Python code that runs on executors is importable as
``mnemon.llm.*``; on a cluster ship the package with ``--py-files``.
"""
