"""airmesh — distributed graph and sensor-ML operators on Spark DataFrames.

Every public operator takes and returns ``pyspark.sql.DataFrame`` objects and
is expressed with built-in DataFrame / SQL / MLlib primitives, so Catalyst can
push filters and prune columns into the scan and pick join strategies.

Sub-packages
------------
sources    readers for delimited text and parquet, ordinal schema binding,
           missing-value rejection, typed casts, stand-in tables, score sinks.
functions  column expressions (haversine distance, path text, split hashes).
operators  graph construction, carrier totals, itineraries, bounded paths,
           connected components, PageRank, label propagation, sampling,
           feature pipelines, classifiers, metrics and clustering sweeps.
plans      named query plans over a directory of parquet tables plus the
           equivalent DuckDB SQL used as a correctness oracle.
"""

__version__ = "0.1.0"
