"""wardline: clinical stream analytics as PySpark DataFrame operators.

Every operator is a plain ``DataFrame -> DataFrame`` function that runs the
same way on a static DataFrame and on a streaming one (where the operator's
shape allows it).  Layout:

* ``sources``   – table loaders, fixture projections, stream sources, decoders
* ``operators`` – validation, ksql-style tables, patient context, alerts,
                  DLQ analytics, readmission mart, health roll-ups, log upkeep
* ``functions`` – reusable Column expressions (Python-compatible parsing,
                  formatting, age arithmetic)
* ``plans``     – the query registry and its DuckDB oracle SQL
* ``streaming`` – Structured Streaming runners and idempotent sinks
"""

__all__ = ["session", "rules"]
