"""The queries of the training-data operators and their SQL, where SQL can express them."""

from __future__ import annotations

from . import bpe, exact_dedup, html_text, jaccard_join, language_model, merkle, packing, passage_dedup, quality, token_counts, topk_search, url_filter, vector_codes
from .common import table


def queries():
    docs = lambda s, d: table(s, d, "documents")
    return {
        "op1_token_counts": lambda s, d: token_counts.token_counts(docs(s, d)),
        "op2_packing": lambda s, d: packing.pack(docs(s, d), with_ids=False),
        "op3_html_text": lambda s, d: html_text.extract(table(s, d, "pages")),
        "op4_language_model": lambda s, d: language_model.score_corpus(docs(s, d)),
        "op5_jaccard_join": lambda s, d: jaccard_join.near_duplicates(docs(s, d)),
        "op6_exact_dedup": lambda s, d: exact_dedup.exact_digest(docs(s, d)),
        "op7_bpe": lambda s, d: bpe.bpe_digests(docs(s, d)),
        "op8_topk_search": lambda s, d: topk_search.top_five(table(s, d, "embeddings")),
        "op9_passage_dedup": lambda s, d: passage_dedup.passage_digest(docs(s, d)),
        "op10_quality": lambda s, d: quality.quality_scores(docs(s, d), table(s, d, "labels")),
        "op11_url_filter": lambda s, d: url_filter.judge(table(s, d, "pages")),
        "op12_merkle_manifest": lambda s, d: merkle.document_manifest(docs(s, d)),
        "op13_vector_codes": lambda s, d: vector_codes.vector_codes(table(s, d, "embeddings")),
    }


def oracle_sql():
    return {"op6_exact_dedup": exact_dedup.ORACLE, "op8_topk_search": topk_search.ORACLE, "op11_url_filter": url_filter.oracle(), "op12_merkle_manifest": merkle.ORACLE, "op13_vector_codes": vector_codes.oracle()}
