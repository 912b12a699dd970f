from .arrow import in_arrow
from .layout import cluster_by_bucket
from .ranking import doc_cuts, rank_all_per_query, top_k_per_query
from .runtime import checkpoint_dir, clear_scratch, own_scratch, scratch_path, scratch_scope
from .skew import salted_join
from .sizing import QueryBatch, broadcast_if_bounded

__all__ = [
    "in_arrow", "cluster_by_bucket", "doc_cuts", "rank_all_per_query", "top_k_per_query",
    "salted_join", "checkpoint_dir", "scratch_path", "scratch_scope", "own_scratch", "clear_scratch",
    "QueryBatch", "broadcast_if_bounded",
]
