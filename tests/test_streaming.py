"""The log post-processing and BLEU statistics run on a file stream and equal the batch job."""
import os
import tempfile

from linea.plans import jobs as J
from linea.sources import fixtures as FX
from linea.streaming import logs as L

from .conftest import SF0001


def test_stream_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="linea-stream-")
    log_dir, out_dir, ck = (os.path.join(d, x) for x in ("logs", "stats", "ck"))
    os.makedirs(log_dir)
    lines = [r.line for r in FX.decoder_log(spark, SF0001).collect()]
    half = len(lines) // 2
    for i, chunk in enumerate((lines[:half], lines[half:])):
        with open(os.path.join(log_dir, f"part{i}.log"), "w") as f:
            f.write("\n".join(chunk) + "\n")
    stream = L.postprocessed(L.log_stream(spark, log_dir, max_files_per_trigger=1))
    q = L.write_sentence_stats(stream, FX.eval_refs(spark, SF0001), out_dir, ck)
    q.awaitTermination(300)
    got = {r.direction: r.bleu for r in L.corpus_bleu_from_stats(spark, out_dir).collect()}
    exp = {r.direction: r.bleu for r in J.evaluate_bidirectional(FX.decoder_log(spark, SF0001),
                                                                 FX.eval_refs(spark, SF0001)).collect()}
    assert got == exp and len(got) == 2
