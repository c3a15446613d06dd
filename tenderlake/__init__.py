"""tenderlake: public-procurement warehouse pipeline written as Spark DataFrame jobs.

Layers follow the warehouse the pipeline feeds: ``staging`` frames are
transient, ``datalake`` and ``dwh`` tables are parquet snapshots managed by
:class:`tenderlake.sinks.warehouse.Warehouse`.
"""

__version__ = "0.1.0"
