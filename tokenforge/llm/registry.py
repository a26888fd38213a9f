"""Queries of the llm operators and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontamination import OP3_SQL, op3_decontamination
from .embedding_dedup import OP8_SQL, op8_embedding_dedup
from .mixing import op2_mixing
from .ngram_join import OP4_FIVE_SQL, OP4_SQL, ngram_components_of_five, op4_ngram_join
from .quality import op5_quality
from .secret_scans import SECRET_COUNTS_SQL, op10_secret_scans, secret_base_counts
from .substring_dedup import OP1_SQL, op1_substring_dedup
from .token_counts import TOKEN_BYTES_SQL, op6_token_counts, token_count_bytes
from .url_filters import OP9_SQL, URL_LINKS_SQL, op9_url_filters, url_filters_over_links
from .warc import OP7_SQL, op7_warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_mixing": op2_mixing,
        "op3_decontamination": op3_decontamination,
        "op4_ngram_join": op4_ngram_join,
        "op5_quality": op5_quality,
        "op6_token_counts": op6_token_counts,
        "op7_warc": op7_warc,
        "op8_embedding_dedup": op8_embedding_dedup,
        "op9_url_filters": op9_url_filters,
        "op10_secret_scans": op10_secret_scans,
        "url_filters_over_links": url_filters_over_links,
        "token_count_bytes": token_count_bytes,
        "secret_base_counts": secret_base_counts,
        "ngram_components_of_five": ngram_components_of_five,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": OP1_SQL,
        "op3_decontamination": OP3_SQL,
        "op4_ngram_join": OP4_SQL,
        "op7_warc": OP7_SQL,
        "op8_embedding_dedup": OP8_SQL,
        "op9_url_filters": OP9_SQL,
        "url_filters_over_links": URL_LINKS_SQL,
        "token_count_bytes": TOKEN_BYTES_SQL,
        "secret_base_counts": SECRET_COUNTS_SQL,
        "ngram_components_of_five": OP4_FIVE_SQL,
    }
