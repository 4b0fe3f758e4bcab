"""Decoder logs as a stream.

The reference has no streaming; its log post-processing is stateless, so the
same column functions run unchanged on a file stream of decoder logs. Per-line
BLEU statistics need a grouping per line, so they are computed per
micro-batch in ``foreachBatch`` (each batch is an ordinary DataFrame) and
written idempotently under its batch id: a retried batch overwrites its own
output, and the corpus score is the sum over all written statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linea.functions import text as T
from linea.operators import bleu as B
from linea.operators import compose as C
from linea.plans.jobs import postprocess
from linea.sources.text import parse_decoder_log


def log_stream(spark: SparkSession, log_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``line`` rows from text files arriving in ``log_dir``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(log_dir).select(F.col("value").alias("line"))


def postprocessed(stream: DataFrame, bidirectional: bool = True) -> DataFrame:
    """S6 -> (F2) -> T7 -> T9 -> T8 on a streaming log: ``sent_id, lang, hyp``."""
    parsed = parse_decoder_log(stream)
    if bidirectional:
        routed = C.route_by_parity(parsed)
        return routed.select("sent_id", "lang", T.join_compounds(T.detruecase("text")).alias("hyp"))
    return parsed.select(F.col("id").alias("sent_id"), F.lit(None).cast("string").alias("lang"),
                         postprocess("text").alias("hyp"))


def write_sentence_stats(hyps: DataFrame, refs: DataFrame, out_dir: str, checkpoint: str,
                         available_now: bool = True):
    """Start a query writing per-line BLEU statistics of each micro-batch.

    ``refs``: static ``sent_id, lang, ref``. Output: parquet under
    ``out_dir/batch=<id>`` with ``sent_id, lang`` and the 10 statistic columns.
    """
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # a batch holds some of the lines, so only a hypothesis without a reference can be told here
        known = batch.join(refs.withColumn("__ref", F.lit(True)), ["sent_id", "lang"], "left")
        err = F.raise_error(F.concat(F.lit("no reference for line "), F.col("sent_id").cast("string")))
        pairs = known.withColumn("ref", F.when(F.col("__ref"), F.col("ref")).otherwise(err))
        toks = pairs.select("sent_id", "lang", T.split_ws("hyp").alias("hyp"),
                            F.array(T.split_space("ref")).alias("refs"))
        st = B.sentence_stats(toks, line="sent_id", keys=["lang"], multi_ref=False)
        st.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={batch_id}")

    w = hyps.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def corpus_bleu_from_stats(spark: SparkSession, out_dir: str) -> DataFrame:
    """Corpus BLEU per direction over everything the stream has written so far."""
    st = spark.read.parquet(out_dir)
    direction = F.when(F.col("lang") == "vi", F.lit("en>vi")).otherwise(F.lit("vi>en"))
    return B.bleu_plain(B.sum_stats(st.withColumn("direction", direction), ["direction"]), ["direction"])
