"""batchwright: declared tables loaded from dated batch folders, on Spark.

Layers:

* :mod:`batchwright.specs` - table specs and the registry;
* :mod:`batchwright.sources` - delimited scans, batch manifest, JDBC reads;
* :mod:`batchwright.functions` - batch dates, stamps, change predicates;
* :mod:`batchwright.operators` - SCD2 merge, load strategies, loop decisions;
* :mod:`batchwright.sinks` - versioned Parquet tables, staged JDBC targets;
* :mod:`batchwright.plans` - registries, batch run / replay / one-time load.
"""

from .specs import APPEND, FULL, SCD, TRUNCATE, Registry, TableSpec

__all__ = ["APPEND", "FULL", "SCD", "TRUNCATE", "Registry", "TableSpec"]
