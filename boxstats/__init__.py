"""boxstats: box-score analytics as Spark DataFrame operators.

Subpackages: ``functions`` (column expressions), ``operators`` (DataFrame -> DataFrame
operators), ``sources`` and ``sinks`` (fixed-schema reads, replace-by-key writes),
``streaming`` (incremental file ingest), ``model`` (Spark ML points model) and ``plans``
(pipeline stages, the driver's bindings and registered queries).
"""

__version__ = "0.1.0"
