"""The registered queries of the corpus operators: (spark, sf_dir) -> the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacekit.llm.byte_bpe import decode_documents, encode_documents
from pacekit.llm.common import read_table, stored, text_crc32, whole_text
from pacekit.llm.embedding_dedup import near_vectors
from pacekit.llm.exact_dedup import exact_dedup
from pacekit.llm.merkle import FIELDS, build_manifest, fold_path, leaf_hash, proof_text
from pacekit.llm.mixing import mix
from pacekit.llm.ngram_join import jaccard_components
from pacekit.llm.packing import pack_documents
from pacekit.llm.periodic_runs import find_runs, run_digests, with_planted_runs
from pacekit.llm.pii import BASE_KINDS, find_personal_data
from pacekit.llm.secret_scan import scan_secrets, span_list
from pacekit.llm.sharding import shuffle_to_shards
from pacekit.llm.toxicity import score_toxicity
from pacekit.llm.warc import convert_pages

PIECE_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                 "sequence_tokens", "padded_length")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id", *[F.expr(f"size(filter(spans, s -> s.base and s.kind = '{k}'))").cast("long").alias(f"n_{k}")
                    for k in BASE_KINDS],
        F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"),
        F.expr("size(filter(spans, s -> not s.base))").cast("long").alias("n_added"))


def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = convert_pages(read_table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "date")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    of = {k: F.expr(f"filter(secrets, s -> s.kind = '{k}')") for k in ("assign", "access", "hex", "guess")}
    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id", *[F.size(of[k]).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("secrets")).alias("spans"),
        F.size(of["guess"]).cast("long").alias("n_guess"),
        F.array_max(F.transform("secrets", lambda s: s["log10_guesses"])).alias("most_log10_guesses"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_documents(read_table(spark, sf_dir, "documents"), word_tokenizer(), with_ids=True)
    return out.select(*PIECE_COLUMNS)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a row is told by its place in its file, so equal rows are no hot key and no text is read for a key
    docs = read_table(spark, sf_dir, "documents").select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sharded = shuffle_to_shards(docs, keys=("doc_id", "_file", "_row")).drop("_file", "_row")
    out = stored(sharded, "shards", ["shard"])             # whole documents; what follows is read from the shards
    text = whole_text("text")
    out = out.withColumn("size", (F.octet_length(text) + 1).cast("long")).withColumn("text_crc32", text_crc32(text))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def byte_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_ranks()
    coded = encode_documents(read_table(spark, sf_dir, "documents"), ranks)
    back = decode_documents(coded, ranks)
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate("text", upper, upper.lower())
    tampered = F.when(text_crc32(F.col("doc_id").cast("string")) % 5 == 0,
                      leaf_hash([lowered if f == "text" else F.col(f) for f in FIELDS]))
    proofs = build_manifest(docs, carry={"tampered": tampered}).proofs()
    return proofs.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        fold_path(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(find_runs(with_planted_runs(read_table(spark, sf_dir, "documents"))))


REGISTRY = {
    "op1_personal_data": op1_personal_data,
    "op2_arc_to_warc": op2_arc_to_warc,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_ngram_join": op4_ngram_join,
    "op5_near_vectors": op5_near_vectors,
    "op6_secret_scan": op6_secret_scan,
    "op7_mix_sources": op7_mix_sources,
    "op8_pack_windows": op8_pack_windows,
    "op9_toxicity": op9_toxicity,
    "op10_shard_rows": op10_shard_rows,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_periodic_runs": op13_periodic_runs,
}
