"""flightloom: a Spark-native flight-delay analytics engine.

Layers, each a set of ``DataFrame -> DataFrame`` functions:

* ``sources``   -- landed JSON pages, headerless CSV, Parquet tables, sinks
* ``functions`` -- reusable column expressions
* ``operators`` -- flattening, staging, dedup, rolling delay, upsert, checks
* ``plans``     -- marts, serving questions and the daily run built from them
* ``streaming`` -- incremental pickup of landed pages
"""
