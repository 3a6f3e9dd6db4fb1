"""The registered queries of the package, each over whole tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricelake.llm.common import share_code
from pricelake.session import spread


def _table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    """With ``key``, a table of fewer splits than task slots is spread by it, for work in Python tasks."""
    share_code(spark)
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(table, key) if key else table


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricelake.llm.langid import train_and_predict

    return train_and_predict(_table(spark, sf_dir, "documents", "doc_id"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricelake.llm.exact_dedup import content_sort

    return content_sort(_table(spark, sf_dir, "documents"), keep="largest")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricelake.llm.toxicity import train_and_score

    return train_and_score(_table(spark, sf_dir, "documents", "doc_id"), _table(spark, sf_dir, "labels"))


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricelake.llm.passages import repeated_passages

    return repeated_passages(_table(spark, sf_dir, "documents", "doc_id"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricelake.llm.decontaminate import decontaminate

    found = decontaminate(_table(spark, sf_dir, "documents", "doc_id"), _table(spark, sf_dir, "benchmark"))
    return found.drop("items", "spans")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricelake.llm.ngram_join import similarity_classes

    return similarity_classes(_table(spark, sf_dir, "documents", "doc_id")).drop("key", "root")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricelake.llm.secrets import find_secrets

    return find_secrets(_table(spark, sf_dir, "documents", "doc_id"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricelake.llm.warc import round_trip

    return round_trip(_table(spark, sf_dir, "pages"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricelake.llm.licenses import scan_licenses

    return scan_licenses(_table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from pricelake.llm.bpe import encode_documents

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(_table(spark, sf_dir, "documents", "doc_id"), ranks, public_tokenizers.PATTERN, with_ids=False)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricelake.llm.spelling import spelling_variants

    return spelling_variants(_table(spark, sf_dir, "documents", "doc_id"), drop_every=97)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from pricelake.llm.alignment import align_tokenizers

    files = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_tokenizers(_table(spark, sf_dir, "documents", "doc_id"), *files)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from pricelake.llm.token_files import token_file_round_trip

    return token_file_round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_passages": op4_passages,
    "op5_decontaminate": op5_decontaminate,
    "op6_ngram_join": op6_ngram_join,
    "op7_secrets": op7_secrets,
    "op8_warc": op8_warc,
    "op9_licenses": op9_licenses,
    "op10_bpe": op10_bpe,
    "op11_spelling": op11_spelling,
    "op12_alignment": op12_alignment,
    "op13_token_files": op13_token_files,
}

ORACLE: dict[str, str] = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
}
