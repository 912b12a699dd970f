from .evaluation import (
    average_precision,
    best_parameters,
    evaluate_queries,
    mean_average_precision,
    parameter_starts,
    parameter_sweep,
    random_parameters,
    sweep_candidates,
)
from .graph import (
    edge_vertices,
    link_edges,
    link_graph,
    link_vertices,
    pagerank,
    partition_graph,
    sort_ranks,
)
from .hybrid import (
    Indexes,
    fusion_features,
    membership_bonus,
    prior_boost,
    reciprocal_rank_score,
    search,
)
from .indexing import (
    Index,
    add_documents,
    anchor_documents,
    avg_doc_length,
    build_index,
    collection_frequency,
    doc_length,
    doc_norm,
    document_frequency,
    explode_anchors,
    index_from_tokens,
    lookup_postings,
    partition_postings,
    posting_lists,
    project_titles,
    prune_rare_terms,
    raw_doc_length,
    scan_postings,
    term_frequencies,
    title_lookup,
)
from .queries import query_nonempty, query_term_counts, query_weights, tokenize_query
from .retrieval import (
    get_pagerank,
    get_pageview,
    matching_documents,
    search_anchor,
    search_bm25,
    search_body,
    search_title,
)

__all__ = [name for name in dir() if not name.startswith("_")]
