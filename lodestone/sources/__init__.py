from .corpus import corpus_count, project_field, read_corpus
from .index_store import (
    append_index,
    compact_index,
    delete_index,
    index_documents,
    read_index,
    save_global_stats,
    write_bounds,
    write_index,
)
from .pageviews import (
    pageviews_by_article,
    parse_pageview_line,
    read_pageview_dump,
    read_pageviews,
    write_pageviews,
)
from .qrels import read_qrels, write_qrels
from .ranks import read_rank_csv, show_top_ranks, write_rank_csv

__all__ = [
    "corpus_count", "project_field", "read_corpus",
    "append_index", "compact_index", "delete_index", "index_documents", "read_index",
    "save_global_stats", "write_bounds", "write_index",
    "pageviews_by_article", "parse_pageview_line", "read_pageview_dump",
    "read_pageviews", "write_pageviews",
    "read_qrels", "write_qrels",
    "read_rank_csv", "show_top_ranks", "write_rank_csv",
]
