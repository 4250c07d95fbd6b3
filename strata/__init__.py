"""strata — a Spark-native layered (bronze / silver / gold) warehouse library.

Column factories live in ``strata.functions``, table readers and writers in
``strata.sources``, relational operators in ``strata.operators``, the
warehouse models in ``strata.plans`` and the continuous runner in
``strata.streaming``.  Everything is plain DataFrame / SQL API, so Catalyst
and adaptive query execution plan the physical work.
"""

__version__ = "0.1.0"
