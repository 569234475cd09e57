"""A fitted pipeline scores a file stream exactly like the batch frame."""
import tempfile

from riskloom.plans.models import pipeline_for
from riskloom.streaming import score_stream


def test_stream_equals_batch(spark, panel):
    dev, ev = panel.where("ID % 5 != 4"), panel.where("ID % 5 = 4")
    fitted = pipeline_for("logreg_clean", ["util"], overrides={"max_iter": 30}).fit(dev)
    src = tempfile.mkdtemp(prefix="riskloom-stream-src-")
    ev.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    out = score_stream(stream, fitted, 0.5)
    got = {}

    def collect(batch, _):
        for r in batch.collect():
            got[r["Id"]] = r["Predicted"]

    q = out.writeStream.foreachBatch(collect).trigger(availableNow=True) \
        .option("checkpointLocation", tempfile.mkdtemp(prefix="riskloom-stream-ck-")).start()
    q.awaitTermination(300)
    batch = {r["Id"]: r["Predicted"] for r in
             score_stream(spark.read.parquet(src), fitted, 0.5).collect()}
    assert got == batch and len(got) == ev.count()
