"""tidewater: raw -> staging loads on Spark.

Subpackages: ``functions`` (Column expressions), ``sources`` (raw file readers),
``operators`` (projections, validation, merge plans, reports), ``plans``
(partition and load plans), ``sinks`` (staging tables), ``streaming``
(incremental loads); ``job`` runs a whole load.
"""

__version__ = "0.1.0"
