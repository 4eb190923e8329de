from pyspark.sql import functions as F

from orderlens.operators.prep import TEST, TRAIN
from orderlens.operators import train as TR
from orderlens.plans.params import W_END, W_START
from orderlens.plans.workflow import Workflow
from orderlens.session import scratch_path
from orderlens.sources.binding import bind_tables
from orderlens.streaming import score_stream
from tests.conftest import SF


def test_stream_scores_like_batch(spark):
    wf = Workflow(spark, bind_tables(spark, SF), W_START, W_END)
    model = TR.gbt({"maxDepth": 2, "maxIter": 3}).fit(wf.split(TRAIN))
    rows = wf.prepared.data.where(F.col("split") == TEST).drop("split")
    src = scratch_path(spark, "stream-src")
    rows.write.parquet(src)
    sink = scratch_path(spark, "stream-sink")
    q = score_stream(spark, wf.feature_model, model, src, rows.schema, sink)
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    batch = model.transform(wf.split(TEST)).select("order_id", "prediction")
    assert got.count() == rows.count()
    assert got.select("order_id", "prediction").exceptAll(batch).count() == 0
