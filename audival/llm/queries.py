"""Registered queries of the text operators: each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from audival.sources.tables import Tables


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from audival.llm.exact_dedup import copy_groups
    return copy_groups(Tables(spark, sf_dir).documents)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from audival.llm.decontaminate import contamination
    t = Tables(spark, sf_dir)
    return contamination(t.documents, t.benchmark)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from audival.llm.bpe import round_trip
    return round_trip(Tables(spark, sf_dir).documents, public_tokenizers.path("word_bpe_49k.json"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from audival.llm.token_files import token_digests, write_tokens
    return token_digests(write_tokens(Tables(spark, sf_dir).documents, public_tokenizers.path("byte_bpe_50k.json")))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from audival.llm.url_filter import judge
    t = Tables(spark, sf_dir)
    return judge(t.pages, t.labels)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from audival.llm.near_dedup import near_duplicates
    return near_duplicates(Tables(spark, sf_dir).documents)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from audival.llm.substring_dedup import repeat_digests
    return repeat_digests(Tables(spark, sf_dir).documents)


def op9_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from audival.llm.hmm import score_texts
    return score_texts(Tables(spark, sf_dir).documents)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from audival.llm.quality import quality_scores
    t = Tables(spark, sf_dir)
    return quality_scores(t.documents, t.labels)


def op8_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from audival.llm.quotes import reply_digests
    return reply_digests(Tables(spark, sf_dir).conversations)


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from audival.llm.pieces import piece_round_trip
    return piece_round_trip(Tables(spark, sf_dir).documents, public_tokenizers.path("piece_bpe_32k.model"), check=True)


def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    from audival.llm.periods import planted, run_digests
    return run_digests(Tables(spark, sf_dir).documents, plant=planted)


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from audival.llm.negatives import hard_negatives
    return hard_negatives(
        Tables(spark, sf_dir).embeddings, anchor=lambda vec_id: vec_id % 100 == 0,
        relabel=lambda vec_id, label: F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op4_exact_dedup": op4_exact_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op10_bpe": op10_bpe,
    "op8_quote_links": op8_quote_links,
    "op2_quality": op2_quality,
    "op9_hmm": op9_hmm,
    "op6_substring_dedup": op6_substring_dedup,
    "op1_near_dedup": op1_near_dedup,
    "op7_url_filter": op7_url_filter,
    "op3_token_files": op3_token_files,
    "op13_pieces": op13_pieces,
    "op11_periods": op11_periods,
    "op12_negatives": op12_negatives,
}
