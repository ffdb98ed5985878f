"""snapstar: polled JSON snapshots -> bronze/silver tables -> star schema -> serving.

Everything is DataFrame code on built-in Spark functions.  The package is
split by role:

* ``sources``   - landing/bronze readers, payload flatteners, table writers
* ``functions`` - column expressions (time zones, labels, keys, JSON checks)
* ``operators`` - reusable relational operators (dedup, SCD2, as-of join,
  quality rules, audit checks)
* ``plans``     - compositions: dimensions, facts, serving tables, reports,
  and the catalogue of queries over the driver tables
* ``streaming`` - file-stream forms of the bronze load and insert-only merge
"""

from snapstar.session import ensure_checkpoint_dir, ensure_utc, get_session

__all__ = ["get_session", "ensure_utc", "ensure_checkpoint_dir"]
