"""The registered queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import chat, decontaminate, htmltext, langid, merkle, minhash, pieces, quality
from tallyloom.llm import resampling, secret_scan, suffixes, topk, toxicity
from tallyloom.llm.tables import bounded, learns, table

Query = Callable[[SparkSession, str], DataFrame]

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
PROBE_CHAT = "</s>[INST] ok [/INST]"


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item found in every document."""
    links = decontaminate.contaminations(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return links.select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "first_word", "words", "matches"
    )


def op2_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best candidates of every twentieth vector, against all vectors."""
    vectors = table(spark, folder, "embeddings")
    best = topk.top_k(vectors.filter("vec_id % 20 = 0"), vectors, 20, "vec_id", "embedding")
    return best.select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"
    )


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation and one that tries to forge marks, formatted and read back."""
    chats = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_CHAT).alias("text"),
    )
    made = chat.format_chats(chats.unionByName(probe))
    made = made.withColumn("formatted", chat.formatted(F.col("segments")))
    made = made.withColumn("turns", chat.parsed(F.col("formatted")))
    made = made.withColumn("loss", chat.loss_text(F.col("segments")))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return made.select(
        F.col("conversation").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in pieces, and whether decoding them gives its text back."""
    return pieces.encode_texts(table(spark, folder, "documents"), PIECE_MODEL, checked=True)


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return htmltext.extract_text(table(spark, folder, "pages"))


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its set size and the near-duplicate component it belongs to."""
    near = minhash.near_duplicates(table(spark, folder, "documents"))
    return near.select(
        F.col("doc").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        (F.col("doc") == F.col("component")).alias("kept"),
    )


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the bytes that smaller documents have too."""
    left = suffixes.remove_repeats(table(spark, folder, "documents"), keep_bytes=False)
    return left.select(
        F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every document, learned from rows not held out."""
    docs = table(spark, folder, "documents")
    model = quality.fit_quality(docs, table(spark, folder, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id",
        (~learns("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity score of every document, by a lexicon learned from rows not held out."""
    docs = table(spark, folder, "documents")
    lexicon = toxicity.learn_lexicon(docs, table(spark, folder, "labels"))
    scored = toxicity.score_texts(docs, lexicon)
    return scored.select(
        "doc_id",
        (~learns("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "hits",
    )


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the known forms and all spans of every document."""
    found = secret_scan.scan_secrets(table(spark, folder, "documents"))

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["past"])), ","
        )

    def known(*kinds: str) -> Column:
        return F.filter("found", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(known(kind)).cast("long").alias(f"n_{kind}") for kind in secret_scan.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(listed(known(*secret_scan.KINDS)), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, by a network trained on rows not held out."""
    docs = table(spark, folder, "documents")
    found = langid.predict_languages(docs, langid.fit_languages(docs))
    return found.select("doc_id", (~langid.may_learn("doc_id")).alias("held_out"), "lang_pred", "score")


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its leaf, its proof, and whether a leaf, tampered with in one row
    of seven, still leads to the root."""
    docs = table(spark, folder, "documents")
    fields = {name: F.col(name) for name in merkle.FIELDS}
    tampers = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    changed = fields | {"n_chars": F.when(tampers, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    leaves = docs.select(
        "doc_id",
        "lang",
        merkle.leaf_digest(*fields.values()).alias("leaf"),
        merkle.leaf_digest(*changed.values()).alias("seen"),
    )
    made = merkle.manifest(leaves, "lang", "doc_id", keep=["seen"])
    made = made.withColumn("folded_root", merkle.folded(F.col("seen"), F.col("steps")))
    return made.select(
        "doc_id",
        *[merkle.hex_text(name).alias(name) for name in ("leaf", "subroot", "root")],
        merkle.proof_digest(F.col("steps")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == merkle.hex_text("root")).alias("verified"),
    )


def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """The weight of every document towards the benchmark's features, and the rank of those drawn."""
    docs, target = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return resampling.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def _in_bounded_session(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(bounded(spark), folder)

    run.__doc__ = query.__doc__
    return run


QUERIES: dict[str, Query] = {
    query.__name__: _in_bounded_session(query)
    for query in (
        op1_decontamination,
        op2_exact_topk,
        op3_chat_format,
        op4_sentencepiece,
        op5_html_text,
        op6_minhash_near_dedup,
        op7_suffix_dedup,
        op8_quality,
        op9_toxicity,
        op10_secret_scan,
        op11_language_id,
        op12_merkle_manifest,
        op13_resampling,
    )
}
