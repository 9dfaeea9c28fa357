"""The Bloom lookup runs unchanged on a file stream."""

from conftest import write_files
from linebeam import streaming
from linebeam.operators import bloom
from linebeam.sources import text


def test_stream_lookup_equals_batch(spark, stage):
    src = stage("stream-in")
    write_files(src, {"a.txt": "alpha\ngamma\n", "b.txt": "delta\nbeta\n"})
    bf = bloom.bloom_build(spark.createDataFrame([("alpha",), ("beta",)], "key string"), "key")
    out, ck = stage("stream-out"), stage("stream-ck")
    streaming.run_available(streaming.semi_filter_stream(streaming.read_lines_stream(spark, src), "value", bf), out, ck)
    got = sorted(r["value"] for r in spark.read.text(out).collect())
    batch = bloom.bloom_semi_filter(text.read_lines(spark, src), "value", bf)
    assert got == sorted(r["value"] for r in batch.collect())
    assert {"alpha", "beta"} <= set(got)
