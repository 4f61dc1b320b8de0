"""recsift: recommendation-data analytics expressed as Spark DataFrame plans.

Layers:

* ``sources``   - interaction tables, write-through materialisation, artefact store.
* ``functions`` - column expressions (deterministic hash buckets, ranking formulas).
* ``operators`` - DataFrame -> DataFrame building blocks (filters, sampling, splits,
  quality checks, recommendation lists, fusion, metrics, bounded joins).
* ``plans``     - compositions of operators (preparation, tuning, final test).
* ``streaming`` - intentionally empty: the workload is batch only.
"""

__version__ = "0.1.0"
