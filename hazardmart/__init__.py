"""Star-schema analytics over official event declarations, built on Spark DataFrames.

Layers, bottom up:

* ``functions``  Column expressions (text, number, money and year cleansing)
* ``operators``  DataFrame to DataFrame steps (conform, keys, grain, quality, analytics)
* ``sources``    readers and writers (Parquet, CSV, JDBC, landed intermediates)
* ``plans``      whole jobs (source cleansing, event table, star schema, full load)
* ``trial``      the same operators aimed at the bundled test tables
"""
