"""The registered queries of the numbered operators, over the whole documents table."""

from collections.abc import Callable
from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from annualis.llm.common import configure
from annualis.llm.exact_dedup import exact_dedup
from annualis.llm.importance import resample
from annualis.llm.neighbour_quality import fit, score
from annualis.llm.ngram_jaccard import jaccard_components
from annualis.llm.packing import pack_documents
from annualis.llm.phrases import collocations
from annualis.llm.piece_codec import round_trip
from annualis.llm.pii import find_pii, report as pii_report
from annualis.llm.quartile_digest import edited_likeness
from annualis.llm.secrets import report as secret_report, scan_secrets
from annualis.llm.simhash import near_dedup
from annualis.llm.substring_dedup import substring_dedup
from annualis.llm.token_counts import count_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = lambda spark, sf: f(configure(spark), sf)
    return f


def table(spark: SparkSession, sf: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@lru_cache
def tokenizer(name: str) -> bytes:
    """Content of a public tokenizer's file; it travels with the tasks."""
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@query
def op1_exact_dedup(spark, sf):
    return exact_dedup(table(spark, sf)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op2_neighbour_quality(spark, sf):
    docs = table(spark, sf)
    return score(docs, fit(docs, table(spark, sf, "labels")))


@query
def op3_token_counts(spark, sf):
    return count_tokens(table(spark, sf), tokenizer("piece_bpe_32k.model"))


@query
def op4_quartile_digest(spark, sf):
    return edited_likeness(table(spark, sf))


@query
def op5_piece_codec(spark, sf):
    return round_trip(table(spark, sf), tokenizer("piece_bpe_32k.model"))


@query
def op6_packing(spark, sf):
    return pack_documents(table(spark, sf), tokenizer("word_bpe_49k.json"))


@query
def op7_substring_dedup(spark, sf):
    return substring_dedup(table(spark, sf)).drop("kept_text")


@query
def op8_pii(spark, sf):
    return pii_report(find_pii(table(spark, sf)))


@query
def op9_secrets(spark, sf):
    return secret_report(scan_secrets(table(spark, sf)))


@query
def op10_simhash(spark, sf):
    return near_dedup(table(spark, sf))


@query
def op11_phrases(spark, sf):
    return collocations(table(spark, sf))


@query
def op12_resampling(spark, sf):
    return resample(table(spark, sf), table(spark, sf, "benchmark"))


@query
def op13_ngram_jaccard(spark, sf):
    return jaccard_components(table(spark, sf))
