"""linebeam: Spark-native analytics over line-oriented text and key-value records.

Every operator is a plain function ``DataFrame -> DataFrame`` (or returns a
Column expression) built from Spark's public DataFrame/SQL functions, so that
Catalyst, AQE and whole-stage codegen do the physical work.

Sub-packages
  functions  column expressions (tokenising, number lists, attribute rows, dates)
  sources    readers (text lines, many paths, gzip, file provenance, XML rows, points)
  sinks      writers (TSV, lines, year partitions, overwrite)
  operators  word counts, inverted index, statistics, joins, Bloom filter, hot list
  plans      bindings of the test tables, the query registry and its SQL oracle
  streaming  the same stateless operators over a file stream
"""

from linebeam.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
