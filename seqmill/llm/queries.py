"""Queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, interactions, neardup, topk, urlrules
from .bpe import op8_bpe
from .chat import op9_chat_format
from .fsttok import op10_token_counts
from .interactions import op12_filter_audit
from .langid import op1_language_id
from .mpegaudio import op6_media
from .neardup import op3_near_duplicates
from .packing import op5_packing
from .quality import op4_quality
from .simple8b import op11_token_files
from .topk import op7_topk
from .urlrules import op2_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_url_filter": op2_url_filter,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_quality": op4_quality,
    "op5_packing": op5_packing,
    "op6_media": op6_media,
    "op7_topk": op7_topk,
    "op8_bpe": op8_bpe,
    "op9_chat_format": op9_chat_format,
    "op10_token_counts": op10_token_counts,
    "op11_token_files": op11_token_files,
    "op12_filter_audit": op12_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": urlrules.SQL,
    "op3_near_duplicates": neardup.SQL,
    "op7_topk": topk.SQL,
    "op9_chat_format": chat.SQL,
    "op12_filter_audit": interactions.SQL,
}
