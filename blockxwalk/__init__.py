"""blockxwalk: street-block crosswalks and cascaded parcel matching on Spark.

Street segments roll up to physical blocks; blocks get names from address
ranges with manual overrides and review flags; tax parcels (BBL), buildings
(BIN) and addresses are linked to blocks through five matching waves (direct
key, application key, billing chain, distance buffer, bounded nearest).

Layout
------
functions/  Column-level rules (text/number NULL semantics, keys, geometry)
operators/  DataFrame operators (aggregates, joins, grid spatial join, cascade, graph)
sources/    readers, sinks and the test-table recipes
plans/      the pipeline stages, the query registry and the oracle SQL
streaming/  (no streaming in this workload; see its docstring)
"""

__version__ = "0.1.0"
