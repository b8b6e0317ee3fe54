"""casebook: business-analytics operators for transactional tables, built on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function made of native Spark
expressions (no Python UDFs), so Catalyst keeps predicate pushdown, column pruning and
whole-stage codegen, and the work is partitioned by Spark on any cluster size.

Layout
------
- ``casebook.sources``   typed load/save, driver-table readers, domain adapters
- ``casebook.functions`` column-level helpers (dirty-value cleaning, date maths, lists)
- ``casebook.operators`` the user-level operators (spend, first/last, ledgers, billing, ...)
- ``casebook.plans``     plan inspection and size-bounded broadcast helpers
- ``casebook.catalog``   one Spark query per analytical question, used by the entry file
"""

from casebook.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
