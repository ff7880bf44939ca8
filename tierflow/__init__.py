"""Customer analytics on a bronze / silver / gold lake, as Spark jobs.

Operators are plain functions ``DataFrame (+ parameters) -> DataFrame``. Actions happen only where
something is written or gated: ``operators.sinks``, ``operators.quality.gate``, ``streaming`` and
``plans.flows``.
"""
