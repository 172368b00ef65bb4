"""kpiflow: Spark-native clickstream/order analytics.

Every operator is a plain ``DataFrame -> DataFrame`` function made of native
Spark SQL expressions, so the same code serves batch tables and Structured
Streaming sources. Layout:

* ``sources``   - Kafka / file / table sources and the test-fixture envelope.
* ``functions`` - Column-level helpers (channel normalisation, intent score,
  validation rules, partition columns).
* ``operators`` - bronze routing, dedupe, attribution joins, window KPIs,
  quality, drift, serving and operations queries.
* ``plans``     - the operators wired into bronze/silver/gold plans and the
  named query catalogue used by ``__spark_entry__``.
* ``streaming`` - sinks and streaming jobs (append path and touched-window
  rewrite path).
"""

from kpiflow.settings import Settings, DEFAULT_SETTINGS

__all__ = ["Settings", "DEFAULT_SETTINGS"]
