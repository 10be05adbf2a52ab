"""Registered queries of the subpackage: name -> callable, and oracle SQL where SQL can say it."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe as D11
from . import chat_format as D8
from . import decontaminate as D2
from . import divergence as D13
from . import exact_dedup as D7
from . import near_dedup as D1
from . import packing as D4
from . import quality as D3
from . import spelling as D12
from . import token_count as D6
from . import token_files as D9
from . import toxicity as D5
from . import url_rules as D10
from .common import documents


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query's contract sets two words a shingle."""
    return D1.near_dedup(documents(spark, sf_dir), width=2)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D2.decontaminate(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def tokenizer_file(name: str) -> str:
    """Where a vocabulary file lies: in CARTWHEEL_TOKENIZERS, else the installed public set."""
    folder = os.environ.get("CARTWHEEL_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D3.classify(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D4.pack_documents(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D5.detect(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D6.count_tokens(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D7.exact_dedup(documents(spark, sf_dir))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's rows as structs of one layout, and conversation -7 as a JSON record of another."""
    rows = documents(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.struct("role", "text").alias("record"))
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
        F.lit(json.dumps({"messages": [{"role": r, "content": said} for r in ("user", "assistant")]})).alias("record"))
    return D8.conversation_digests(D8.format_records(extra, rows))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D9.encode_to_files(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled urls: those a list rule settles, and pages whose id has a quality or toxicity label."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = documents(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.when(F.coalesce(bad, F.lit(False)), "block").otherwise("allow").alias("label"))
    return D10.judge(documents(spark, sf_dir, "pages").select("page_id", "url"), labels)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN

    tokens = D11.read_ranks(tokenizer_file("byte_bpe_multi_50k.tiktoken"))
    return D11.digests(documents(spark, sf_dir), tokens, PATTERN)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D12.group_variants(D12.count_words(D12.planted_words(documents(spark, sf_dir))))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D13.audit(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_near_dedup, op2_decontaminate, op3_quality, op4_packing, op5_toxicity, op6_token_counts, op7_exact_dedup, op8_chat_format, op9_token_files, op10_url_rules,
    op11_byte_bpe, op12_spelling, op13_source_divergence)}
SQL = {"op2_decontaminate": D2.SQL, "op7_exact_dedup": D7.SQL, "op8_chat_format": D8.SQL,
       "op12_spelling": D12.SQL, "op13_source_divergence": D13.SQL}
