"""quayside: landing readers, payload flatteners, replacing-table maintenance,
incremental planning and streaming loads as PySpark DataFrame jobs.

Entry points: ``quayside.session.configure`` / ``build_session``,
``quayside.operators.tables`` (TableSpec, upsert, read_latest, compact, prunes),
``quayside.sources``, ``quayside.operators``, ``quayside.plans`` and
``quayside.streaming``.
"""

__version__ = "0.1.0"
