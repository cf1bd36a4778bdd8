"""tablewise: tabular profiling, preparation and classification as Spark jobs.

Subpackages: ``operators`` (audit, explore, prepare, features, metrics,
select, score, train, orderstats), ``sources`` (CSV / JSON / parquet /
fingerprints), ``functions`` (column expressions, similarity), ``plans``
(fixture views, query registry, composite jobs), ``streaming``.
"""

__version__ = "0.1.0"
