"""Registered queries of the training-data operators, one per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linea.llm import ann, conversations, html_text, langid, line_dedup, mixing, omh, packing, periodic, secret_scan, simhash, toxicity, urls
from linea.llm.common import let, load, materialise, remainder


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the lexicon is learned from labels whose crc32 remainder mod 5 is not 0."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load(spark, sf_dir, "labels").where("toxic is not null").select("doc_id", "toxic")
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(True))
    lexicon = toxicity.learn(docs.where(~held_out).join(labels, "doc_id"))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.scores(lexicon, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate classes of all documents (4-word shingles, at most 4 bits)."""
    found = simhash.cluster(load(spark, sf_dir, "documents"), k=4, max_bits=4)
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed by concatenate and cut into sequences of 2,048 tokens."""
    pieces = packing.pack(load(spark, sf_dir, "documents"), window=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "sequence_tokens", "padded_to")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in all documents: the fixed patterns and the randomness battery."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = materialise(secret_scan.scanned(docs).drop("text"))
    judge = secret_scan.learn(found.select(F.explode("__runs.v").alias("v")), secret_scan.language(docs))
    rows = secret_scan.accepted(found, judge)
    count = lambda k: F.size(F.filter("__base", lambda x: x["kind"] == k)).cast("bigint")
    return rows.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(secret_scan.KINDS[:3])],
                       F.sha2(F.encode(secret_scan.told(F.col("__base")), "UTF-8"), 256).alias("base_sha256"),
                       secret_scan.told(F.col("spans")).alias("spans"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of all documents and of their edited texts, and their likeness."""
    rows = omh.edited(load(spark, sf_dir, "documents"))
    rows = rows.withColumn("efp", omh.fingerprint(F.col("edited")))
    return rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_chars"),
                       F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                       omh.told(F.col("fp")).alias("fingerprint"), omh.told(F.col("efp")).alias("edited_fingerprint"),
                       omh.likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
                       omh.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest neighbours by inner product of every embedding whose vec_id is divisible by 20."""
    rows = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


#: Listed rules of the URL filter: verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: listed rules, else rules mined from urls of labelled documents.

    A url's number is the document that the page shows; documents of label quality 0 are to be blocked.
    """
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(urls.path(F.col("url")), r"/(\d{1,18})(?:[/.]|$)", 1)
    shown = pages.select("url", F.when(number != "", number.cast("bigint")).alias("doc_id"))
    labels = load(spark, sf_dir, "labels").where("quality is not null").select("doc_id", "quality")
    labelled = shown.join(labels, "doc_id").select(urls.tokens(F.col("url")).alias("tokens"), (F.col("quality") == 0).alias("block"))
    return (urls.judge(pages, "url", URL_RULES, urls.mine(labelled))
            .select("page_id", "host", "path", "rule", "verdict"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    rows = html_text.main_text(pages, urls.host(F.col("url")))
    return rows.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150% of all words takes of every document; sources weigh 5, 2, 1 and stop at two epochs."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    measured = materialise(mixing.measure(docs).drop("text"))
    planned = materialise(mixing.plan(measured, weights=(5, 2, 1), share=1.5, max_epochs=2.0))
    return mixing.allot(measured, planned).select("doc_id", *mixing.ADDED)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from rows whose crc32 remainder mod 4 is not 2."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(True))
    model = langid.train(docs.where(~held_out))
    return (langid.identify(docs.drop("lang"), model)
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structure repair of every conversation of ``conversations`` after the contract's damage."""
    rows = load(spark, sf_dir, "conversations")
    told = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    code = F.crc32(F.encode(told, "UTF-8")) % 20
    text = F.coalesce("text", F.lit(" "))
    copies = F.array_repeat(F.lit(0), F.when(code == 3, 2).otherwise(1))
    hurt = rows.select("conv_id", "turn", F.when(code == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                       (code != 0).alias("present"), F.explode(copies).alias("copy"))
    return conversations.repair(hurt, present=F.col("present")).summary


def _periodic_text(doc_id, text):
    """The contract's damage: in a tenth of the documents, the words from a place on repeat its first ones."""
    h = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        head, unit = F.slice(words, 1, a), F.slice(words, a + 1, p)
        whole = F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(head, F.slice(whole, 1, n - a)), " ")

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hit = (h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]")
    return F.when(hit, let(words, repeated)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words, after the contract's damage."""
    docs = load(spark, sf_dir, "documents").select("doc_id", _periodic_text(F.col("doc_id"), F.col("text")).alias("text"))
    rows = periodic.detect(docs, least=12)
    # greatest length first, then smallest start, then smallest period
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    told = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    rows = rows.withColumn("top", top)
    return rows.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("top.s")).alias("start"), F.col("top.length").alias("length"),
                       (-F.col("top.p")).alias("period"), F.floor(1000 * F.col("top.length") / -F.col("top.p")).alias("exponent_milli"),
                       sha(told).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of 40 characters or more that five documents or more hold, but in the largest of them."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    rows = line_dedup.drop_repeated(docs, min_chars=40, min_docs=5)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


LINE_DEDUP_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r"""


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_simhash, op3_packing, op4_secrets, op5_order_minhash,
                                  op6_nearest, op7_url_filter, op8_html_text, op9_mixing, op10_language_id,
                                  op11_conversation_repair, op12_periodic_runs, op13_line_dedup)}
SQL: dict[str, str] = {"op13_line_dedup": LINE_DEDUP_SQL}
