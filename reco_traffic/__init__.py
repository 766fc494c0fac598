"""Rating statistics, latent-factor recommendations and road-camera analytics
expressed as Spark DataFrame functions.

Layout
------
- ``sources``   readers and writers (CSV, text, stored tables, JSON events)
- ``functions`` column expressions (cosine, year-month, congestion class, parsers)
- ``operators`` DataFrame -> DataFrame building blocks (statistics, similarity,
  candidate scoring, traffic features, Spark ML model steps)
- ``plans``     whole jobs composed from operators, the test-table mappings and
  the registered query catalogue
- ``streaming`` Structured Streaming jobs and the keyed batch log they write to

Every function is lazy: nothing calls an action except the model fits, the
jobs that write tables, and the streaming runners.
"""

__version__ = "0.1.0"
