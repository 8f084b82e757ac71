"""starforge: files to an explorable star schema, expressed as Spark DataFrame jobs.

Layers (each a set of lazy DataFrame transforms):

* ``sources``   - file catalog, format readers, Parquet sinks
* ``functions`` - column expressions (name normalisation, trimming, dates, checksums)
* ``operators`` - cleaning, type inference, harmonisation, profiling, star schema,
                  surrogate keys, incremental loads, cubes, drill-through, validation
* ``plans``     - end-to-end jobs and the registry of driver queries
* ``streaming`` - Structured Streaming forms of the incremental operators
"""

__version__ = "0.1.0"
