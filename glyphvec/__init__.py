"""Text embedding and vector search on Spark DataFrames."""

from glyphvec.functions.text import clean_text
from glyphvec.operators.categories import category_combos, category_stats
from glyphvec.operators.embed import HashingProvider, RetryingProvider, embed
from glyphvec.operators.ivf import build_index, query_index
from glyphvec.operators.knn import knn_join
from glyphvec.operators.lookup import attach_metadata, vector_at, vectors_at
from glyphvec.operators.ordinals import assign_index_id
from glyphvec.plans.embedding import embed_texts
from glyphvec.plans.prepare import merge_texts, write_category_paths
from glyphvec.plans.search import sample_index, search_index
from glyphvec.sinks.tables import write_embeddings, write_results
from glyphvec.sources.categories import read_categories
from glyphvec.sources.texts import count_records, read_tabular, read_text_folder, read_texts
from glyphvec.sources.vectors import query_vector, read_vectors

__all__ = [
    "HashingProvider",
    "RetryingProvider",
    "assign_index_id",
    "attach_metadata",
    "build_index",
    "category_combos",
    "category_stats",
    "clean_text",
    "count_records",
    "embed",
    "embed_texts",
    "knn_join",
    "merge_texts",
    "query_index",
    "query_vector",
    "read_categories",
    "read_tabular",
    "read_text_folder",
    "read_texts",
    "read_vectors",
    "sample_index",
    "search_index",
    "vector_at",
    "vectors_at",
    "write_category_paths",
    "write_embeddings",
    "write_results",
]
