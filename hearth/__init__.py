"""hearth — property sales, housing vacancy and planning analytics on Spark.

Every operator takes and returns a ``DataFrame`` (or a ``Column``) and is built
only from the public DataFrame / SQL / Structured Streaming APIs, so Catalyst
and AQE plan the physical work.  Sub-packages:

* ``functions``  — column expressions (cleaning, labels, dates, predicates)
* ``sources``    — readers, writers, the snapshot store and the stand-in frames
* ``operators``  — keys, joins, aggregates, dimensions, cube decoding,
                   quality checks, merge / watermark, measures
* ``plans``      — layer builds (bronze → silver → gold → star), report
                   queries and the query catalogue
* ``streaming``  — available-now incremental upsert
"""

__version__ = "0.1.0"
