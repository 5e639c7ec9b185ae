import os
import shutil
import tempfile

from pointlake.streaming.wordcount import stream_word_count


def test_stream_word_count(spark, fixture_path):
    src = tempfile.mkdtemp(prefix="pl-stream-src-")
    ckpt = tempfile.mkdtemp(prefix="pl-stream-ckpt-")
    shutil.copy(fixture_path("words_5.txt"), os.path.join(src, "part1.txt"))
    q = (stream_word_count(spark, src).writeStream.outputMode("complete")
         .format("memory").queryName("wc_stream").option("checkpointLocation", ckpt).start())
    try:
        q.processAllAvailable()
        with open(os.path.join(src, "part2.txt"), "w") as f:
            f.write("dataset again\n")
        q.processAllAvailable()
        counts = {r.word: r.n for r in spark.sql("SELECT * FROM wc_stream").collect()}
    finally:
        q.stop()
    assert counts["dataset"] == 6 and counts["again"] == 1 and counts["TemplateHW1"] == 4
