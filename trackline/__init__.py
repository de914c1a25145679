"""trackline: Spark-native analytics for vessel position reports (AIS).

Every operator is a lazy ``DataFrame -> DataFrame`` function; see
``trackline.operators`` (cleaning, tracks, fleet reports, vessels, traffic,
changes), ``trackline.sources`` (CSV/ZIP readers, archive catalog, writers),
``trackline.streaming`` (incremental ingest) and ``trackline.plans``
(pipeline and the registered queries).
"""

__version__ = "0.1.0"
