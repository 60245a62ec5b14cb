"""Curation of text and bibliographic records on Spark.

Every public function takes and returns DataFrames (or Columns); only the
readers and sinks in :mod:`sievework.sources` touch a path.
"""

__version__ = "0.1.0"
