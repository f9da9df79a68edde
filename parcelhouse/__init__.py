"""Feature store for keyed regional measurements, written as Spark jobs.

The package is organised by the kind of work:

* ``functions``  - column expressions (identifiers, values, feature names)
* ``sources``    - scans of registries, region files, reports, questionnaires
* ``operators``  - DataFrame-in, DataFrame-out relational work
* ``streaming``  - incremental load and the load ledger
* ``plans``      - stored tables, catalog, published layout, end-to-end load
* ``workloads``  - the operators bound to the benchmark tables
"""
