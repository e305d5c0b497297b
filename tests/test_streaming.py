"""Row-wise steps with fitted values take a streaming table as it is."""

from pyspark.sql import functions as F

from millrace.operators import logistic, prepare, sampling
from millrace.session import scratch_path
from millrace.sources import frames


def _steps(df, scaler, beta):
    scaled = scaler.transform(df)
    parts = sampling.split_hash(scaled, ["event_id"], 0.75, seed=1)
    return logistic.score(parts, frames.EVENT_FEATURES, beta).select("event_id", "part", "score", "prediction")


def test_a_stream_is_scored_like_a_table(spark, folder):
    events = frames.event_frame(spark, folder)
    scaler, beta = prepare.fit_zscore(events, frames.EVENT_FEATURES), [0.1, 0.4, -0.2]
    path = scratch_path(spark, "events")
    events.repartition(3).write.parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = (
        _steps(stream, scaler, beta).writeStream.format("memory").queryName("scored_events")
        .option("checkpointLocation", scratch_path(spark, "stream")).trigger(availableNow=True).start()
    )
    try:
        query.awaitTermination(120)
        got = spark.table("scored_events")
        want = _steps(events, scaler, beta)
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
        assert got.select(F.count_distinct("part")).first()[0] == 2
    finally:
        query.stop()
