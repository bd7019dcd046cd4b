"""ledgerlens — order-line analytics expressed as lazy Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark
built-ins; nothing inside an operator triggers an action.  Sub-packages:

* ``sources``   – table adapters, file scans/sinks, the distributed generator
* ``functions`` – column-level helpers (hash uniforms, exact money sums, list order)
* ``operators`` – cleaning, filters, summaries, profiling, run-log analytics
* ``plans``     – whole jobs: base, tuned (cache/repartition), single-pass
* ``streaming`` – the order reports over a file stream
"""

from ledgerlens.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
