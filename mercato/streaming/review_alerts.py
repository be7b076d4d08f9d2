"""Structured Streaming form of the review scoring rules (C5 + C6).

The reference scores one typed review at a time in its dashboard; here new
review files arriving in a folder are scored continuously: the same Column rules
as the batch job (``keyword_sentiment`` / ``negative_alerts``), a watermark on
the review time so the per-window alert counts can be finalised and their state
dropped, and an exactly-once file sink with its checkpoint in the cluster's
shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import review_text
from ..operators.features import sentiment_label
from ..operators.scoring import keyword_sentiment, negative_alerts


def review_stream(spark: SparkSession, source_dir: str, schema: StructType,
                  max_files_per_trigger: int = 100) -> DataFrame:
    """Reviews arriving as parquet files under ``source_dir``."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
                 .parquet(source_dir))


def score_reviews(reviews: DataFrame) -> DataFrame:
    """Keyword sentiment of every commented review (stateless, per micro-batch)."""
    r = reviews.filter(F.col("review_comment_message").isNotNull())
    r = r.withColumn("review_text", review_text(F.col("review_comment_title"), F.col("review_comment_message")))
    r = r.withColumn("sentiment", sentiment_label("review_score"))
    return keyword_sentiment(r).drop("review_text")


def alert_stream(reviews: DataFrame) -> DataFrame:
    """Negative reviews with their follow-up actions."""
    return negative_alerts(score_reviews(reviews)).select(
        "review_id", "order_id", "review_answer_timestamp", "predicted_sentiment", "confidence", "actions")


def alert_counts(reviews: DataFrame, window: str = "1 day", watermark: str = "2 days") -> DataFrame:
    """Predicted-sentiment counts per event-time window; the watermark bounds the
    state and lets finished windows be emitted in append mode."""
    # watermarks need a zoned timestamp: the wall clock is kept (UTC session zone)
    s = score_reviews(reviews).withColumn("event_time", F.col("review_answer_timestamp").cast("timestamp"))
    s = s.withWatermark("event_time", watermark)
    return (s.groupBy(F.window("event_time", window).alias("window"), "predicted_sentiment")
             .agg(F.count(F.lit(1)).alias("reviews")))


def start_alerts(spark: SparkSession, source_dir: str, schema: StructType, sink_dir: str,
                 checkpoint_dir: str | None = None, trigger_seconds: int = 30):
    """Start the alert query (parquet sink, exactly-once via the checkpoint)."""
    from ..session import ensure_checkpoint_dir
    ckpt = checkpoint_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/review_alerts"
    return (alert_stream(review_stream(spark, source_dir, schema)).writeStream
            .format("parquet").option("path", sink_dir).option("checkpointLocation", ckpt)
            .outputMode("append").trigger(processingTime=f"{trigger_seconds} seconds").start())
