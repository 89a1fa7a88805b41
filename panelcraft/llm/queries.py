"""Named queries of the corpus operators over the shipped tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (embed_tiles, fill_in_middle, hilbert_blocks, langid_kn, neighbours_in_order, packing, pseudo_likelihood,
               rank_queue_bpe, semicrf, simhash_gray, ssk_svm, token_planes, warc)
from .common import remainder_column, shared_folder, shared_table
from .public_ids import ALONE_BYTES, ENCODED_BYTES, FIRST_BYTES


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op2_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    path = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}/ids"
    token_planes.write(documents(spark, sf_dir), path, cache_bytes=FIRST_BYTES, first=True)
    return token_planes.read(spark, path)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), cache_bytes=ALONE_BYTES, slice_bytes=ENCODED_BYTES)


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_gray.groups(documents(spark, sf_dir))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours_in_order.against_next(documents(spark, sf_dir))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_queue_bpe.round_trip(documents(spark, sf_dir))


def op9_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_tiles.links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    machine = ssk_svm.fit(docs, ssk_svm.teaching(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    held_out = F.coalesce(remainder_column("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return ssk_svm.score(docs, machine).select("doc_id", held_out, "score", "predicted")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return semicrf.digest(semicrf.find(docs, semicrf.fit(docs)))


def op8_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    counted = shared_table(pseudo_likelihood.count_words(docs), "words")
    words = pseudo_likelihood.listed_words(counted)
    shares = pseudo_likelihood.share_out(counted, words)
    texts = shared_table(pseudo_likelihood.coded(docs, words, shares), "coded")
    return pseudo_likelihood.score_coded(texts, pseudo_likelihood.fit(texts), shares)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid_kn.fit(langid_kn.labelled(docs))
    held_out = F.coalesce(remainder_column("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return langid_kn.identify(docs, model).select("doc_id", held_out, "lang_pred", "score", "accepted")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    path = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}/warc"
    return warc.digest(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_blocks.digest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(documents(spark, sf_dir))


QUERIES = {"op1_personal_data": op1_personal_data, "op8_pseudo_likelihood": op8_pseudo_likelihood, "op3_toxicity": op3_toxicity, "op10_language": op10_language,
           "op2_token_planes": op2_token_planes, "op4_packing": op4_packing, "op5_simhash_groups": op5_simhash_groups,
           "op6_fingerprints": op6_fingerprints, "op7_byte_bpe": op7_byte_bpe, "op9_embedding_links": op9_embedding_links,
           "op11_warc": op11_warc, "op12_vector_codes": op12_vector_codes, "op13_fill_in_middle": op13_fill_in_middle}
ORACLES: dict[str, str] = {"op11_warc": warc.SQL, "op12_vector_codes": hilbert_blocks.SQL, "op13_fill_in_middle": fill_in_middle.SQL}
