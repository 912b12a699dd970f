"""The same queries as SQL for DuckDB, assembled from named common table expressions."""

from ..functions.scoring import BM25_B, BM25_K1, BM25_K2, DEFAULT_WEIGHTS
from ..functions.stopwords import index_stopwords, query_stopwords
from ..functions.text import QUESTION_WORDS, TOKEN_PATTERN
from ..operators.evaluation import END_POINTS, RANGES, STARTS
from .fixtures import (
    ANCHOR_PATTERN,
    BODY_MIN_DF,
    EDGE_QUERIES,
    LOOKED_UP,
    TITLE_MIN_DF,
    TUNED,
)

W = DEFAULT_WEIGHTS


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(stopwords) -> str:
    return "(" + ", ".join(quote(w) for w in stopwords) + ")"


def tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), {quote(TOKEN_PATTERN)})"


def hashed(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 10) AS BIGINT)"


def _occurrences(source: str) -> str:
    return f"""SELECT term, doc_id, count(*) AS tf FROM (
        SELECT doc_id, unnest({tokens('text')}) AS term FROM ({source}))
      WHERE term NOT IN {words(index_stopwords())} GROUP BY term, doc_id"""


def _bm25(k1: float, b: float, k2: float) -> str:
    return f"""SELECT query_id, doc_id, min(pos) AS pos,
        sum(qtf * (ln(1 + ((SELECT count(*) FROM documents) - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))
          * tf * {k1 + 1}::DOUBLE
          / (tf + {k1}::DOUBLE * (1 - {b}::DOUBLE + {b}::DOUBLE * dl / (SELECT avgdl FROM avgdl))))
          * ({k2 + 1}::DOUBLE * tf / ({k2}::DOUBLE + tf))) AS score
      FROM query_terms JOIN body_terms USING (term) JOIN body USING (term) JOIN body_docs USING (doc_id)
      GROUP BY query_id, doc_id"""


# name -> (names it reads, body)
CTES: dict[str, tuple[tuple, str]] = {
    "titles": ((), "SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents"),
    "anchors": ((), f"""SELECT d.doc_id AS src,
        {hashed('l.href')} % (SELECT count(*) FROM documents) AS dst, l.text
      FROM documents d JOIN (
        SELECT page_id,
          unnest(regexp_extract_all(html, {quote(ANCHOR_PATTERN)}, 1)) AS href,
          unnest(regexp_extract_all(html, {quote(ANCHOR_PATTERN)}, 2)) AS text FROM pages) l
      ON l.page_id = d.doc_id"""),
    "body_all": ((), _occurrences("SELECT doc_id, text FROM documents")),
    "title_all": (("titles",), _occurrences("SELECT doc_id, title AS text FROM titles")),
    "anchor_all": (("anchors",), _occurrences("SELECT dst AS doc_id, text FROM anchors")),
    "queries": ((), "SELECT item_id AS query_id, CASE WHEN item_id % 3 = 0 THEN text || '?' "
                "ELSE text END AS query FROM benchmark UNION ALL VALUES "
                + ", ".join(f"({i}, {quote(q)})" for i, q in EDGE_QUERIES)),
    "query_tokens": (("queries",), f"""SELECT query_id, t.token,
        row_number() OVER (PARTITION BY query_id ORDER BY t.place) - 1 AS place FROM (
        SELECT query_id, unnest({tokens('query')}) AS token,
          generate_subscripts({tokens('query')}, 1) AS place FROM queries) t
      WHERE t.token NOT IN {words(query_stopwords())}"""),
    "query_terms": (("query_tokens",), """SELECT query_id, token AS term, count(*) AS qtf,
        min(place) AS pos FROM query_tokens GROUP BY query_id, token"""),
    "avgdl": (("body_docs", "title_docs", "anchor_docs"), """SELECT
        sum(greatest(b.dl, coalesce(t.dl, 0), coalesce(a.dl, 0)))
          / (SELECT count(*) FROM documents)::DOUBLE AS avgdl
      FROM body_docs b LEFT JOIN title_docs t USING (doc_id) LEFT JOIN anchor_docs a USING (doc_id)"""),
    "bm25_scores": (("query_terms", "body_terms", "body", "body_docs", "avgdl"),
                    _bm25(BM25_K1, BM25_B, BM25_K2)),
    "tuned_scores": (("query_terms", "body_terms", "body", "body_docs", "avgdl"), _bm25(**TUNED)),
    "tuned": (("tuned_scores",), """SELECT * FROM (SELECT query_id, doc_id, score, row_number() OVER (
        PARTITION BY query_id ORDER BY round(score, 9) DESC, pos, doc_id) AS rank FROM tuned_scores)
      WHERE rank <= 20"""),
    "body_hits": (("query_terms", "body"), """SELECT query_id, doc_id, count(*) AS score,
        min(term) AS first_word FROM query_terms JOIN body USING (term) GROUP BY query_id, doc_id"""),
    "tokens_all": ((), """SELECT term, doc_id, count(*) AS tf FROM (
        SELECT doc_id, unnest(string_split_regex(trim(lower(text)), '\\s+')) AS term FROM documents)
      GROUP BY term, doc_id"""),
    "worded": (("queries",), """SELECT query_id * 4 + n AS query_id, start || query AS query FROM queries,
        (VALUES (0, ''), (1, 'Who '), (2, 'Whoever '), (3, 'who ')) t(n, start)"""),
    "bm25": (("bm25_scores",), """SELECT * FROM (SELECT query_id, doc_id, score, row_number() OVER (
        PARTITION BY query_id ORDER BY round(score, 9) DESC, pos, doc_id) AS rank FROM bm25_scores)
      WHERE rank <= 100"""),
    "body_scores": (("query_terms", "body_terms", "body", "body_docs"), """SELECT
        query_id, doc_id, min(pos) AS pos,
        sum(tf::DOUBLE / dl * log2((SELECT count(*) FROM body_docs)::DOUBLE / df) * qtf * qtf)
          / any_value(qn) / sqrt(any_value(nf)) AS score
      FROM query_terms JOIN (SELECT query_id, sqrt(sum(qtf * qtf)) AS qn FROM query_terms
        GROUP BY query_id) USING (query_id)
      JOIN body_terms USING (term) JOIN body USING (term) JOIN body_docs USING (doc_id)
      GROUP BY query_id, doc_id"""),
    "title_hits": (("query_terms", "title"), """SELECT query_id, doc_id, count(*) AS score,
        min(term) AS first_word FROM query_terms JOIN title USING (term) GROUP BY query_id, doc_id"""),
    "anchor_hits": (("query_terms", "anchor", "titles"), """SELECT query_id, doc_id,
        count(*) AS score, min(term) AS first_word
      FROM query_terms JOIN anchor USING (term) JOIN titles USING (doc_id)
      GROUP BY query_id, doc_id"""),
    "edges": (("anchors",), "SELECT DISTINCT src, dst FROM anchors"),
    "vertices": (("edges",), "SELECT doc_id AS id FROM documents UNION SELECT dst FROM edges"),
    "purchases": ((), """SELECT DISTINCT o_custkey AS src, l_partkey + 1000000000 AS dst
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "purchase_vertices": (("purchases",), "SELECT src AS id FROM purchases UNION SELECT dst FROM purchases"),
    "dump_lines": ((), """SELECT concat_ws(' ',
        CASE event_type WHEN 'click' THEN 'fr.wikipedia' WHEN 'signup' THEN 'enXwikipedia'
          ELSE 'en.wikipedia' END, event_type,
        CASE WHEN event_type = 'error' THEN 'null'
          ELSE (event_id % (SELECT count(*) FROM documents))::VARCHAR END,
        'desktop', (event_id % 1000)::VARCHAR, event_type) AS line FROM events"""),
    "parsed_lines": (("dump_lines",), r"""SELECT TRY_CAST(doc_id AS BIGINT) AS doc_id,
        TRY_CAST(views AS BIGINT) AS views FROM (
        SELECT split_part(line, ' ', 3) AS doc_id, split_part(line, ' ', 5) AS views
        FROM dump_lines WHERE regexp_matches(line, '^en\.wikipedia'))
      WHERE regexp_full_match(doc_id, '[0-9]+') AND regexp_full_match(views, '[0-9]+')
        AND TRY_CAST(doc_id AS BIGINT) IS NOT NULL AND TRY_CAST(views AS BIGINT) IS NOT NULL"""),
    "pageviews": (("parsed_lines",), "SELECT doc_id, sum(views)::BIGINT AS views FROM parsed_lines GROUP BY doc_id"),
    "requests": (("anchors",), """SELECT src AS request_id, pos, id AS doc_id FROM (
        SELECT src, unnest(ids) AS id, generate_subscripts(ids, 1) - 1 AS pos FROM (
          SELECT d.doc_id AS src, list_concat(coalesce(l.ids, []), [-1, d.doc_id, d.doc_id]) AS ids
          FROM documents d LEFT JOIN link_lists l ON l.src = d.doc_id))"""),
    "link_lists": ((), f"""SELECT page_id AS src, list_transform(
        regexp_extract_all(html, {quote(ANCHOR_PATTERN)}, 1),
        lambda h: {hashed('h')} % n) AS ids
      FROM pages, (SELECT count(*) AS n FROM documents)"""),
    "features": (("bm25", "title_hits", "anchor_hits", "link_pagerank", "pageviews", "titles"), """SELECT
        query_id, doc_id, bm25_rank, title_words, title_first, anchor_words, anchor_first,
        CASE WHEN pagerank IS NULL THEN 1.0 WHEN pagerank > 1 THEN trunc(log10(pagerank))
          ELSE pagerank END AS pr,
        CASE WHEN coalesce(views, 0) > 1 THEN trunc(log2(views)) WHEN coalesce(views, 0) < 1 THEN 2.0
          ELSE 1.0 END AS pv
      FROM (SELECT query_id, doc_id, max(bm25_rank) AS bm25_rank, max(title_words) AS title_words,
          max(title_first) AS title_first, max(anchor_words) AS anchor_words,
          max(anchor_first) AS anchor_first FROM (
          SELECT query_id, doc_id, rank AS bm25_rank, 0 AS title_words, NULL AS title_first,
            0 AS anchor_words, NULL AS anchor_first FROM bm25
          UNION ALL SELECT query_id, doc_id, NULL, score, first_word, 0, NULL FROM title_hits
          UNION ALL SELECT query_id, doc_id, NULL, 0, NULL, score, first_word FROM anchor_hits)
        GROUP BY query_id, doc_id)
      JOIN titles USING (doc_id) LEFT JOIN link_pagerank ON id = doc_id
      LEFT JOIN pageviews USING (doc_id)"""),
    "hybrid": (("features", "queries"), f"""SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY query_id ORDER BY round(score, 9) DESC, bm25_rank NULLS LAST,
          title_words DESC, title_first NULLS LAST,
          CASE WHEN title_words > 0 THEN doc_id END NULLS LAST,
          anchor_words DESC, anchor_first NULLS LAST, doc_id) AS rank FROM (
        SELECT f.*, (coalesce(x / bm25_rank, 0) + CASE WHEN title_words > 0 THEN y ELSE 0 END
          + CASE WHEN anchor_words > 0 THEN {W.anchor_bonus}::DOUBLE ELSE 0 END)
          * {W.pagerank_scale}::DOUBLE * pr * {W.pageview_scale}::DOUBLE * pv AS score
        FROM features f JOIN query_weights USING (query_id)))
      WHERE rank <= 100"""),
    "query_weights": (("queries",), f"""SELECT query_id,
        CASE WHEN query LIKE '%?' THEN {W.rank_decay_question}::DOUBLE
          ELSE {W.rank_decay}::DOUBLE END AS x,
        CASE WHEN length(query) < 4 AND query NOT LIKE '%?' THEN {W.title_bonus_short}::DOUBLE
          ELSE {W.title_bonus}::DOUBLE END AS y FROM queries"""),
    "qrels": (("query_terms", "body_all"), """SELECT query_id, doc_id FROM query_terms
      JOIN body_all USING (term) WHERE pos = 0
        AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)"""),
    "ap": (("hybrid", "qrels", "queries"), """SELECT q.query_id, coalesce(ap, 0) AS ap
      FROM queries q LEFT JOIN (
        SELECT query_id, round(avg(hits / rank), 3) AS ap FROM (
          SELECT query_id, rank, row_number() OVER (PARTITION BY query_id ORDER BY rank)::DOUBLE AS hits
          FROM hybrid JOIN qrels USING (query_id, doc_id) WHERE rank <= 40)
        GROUP BY query_id) USING (query_id)"""),
}
CTES["hybrid"] = (("features", "query_weights"), CTES["hybrid"][1])
CTES["requests"] = (("link_lists",), CTES["requests"][1])

for _field, _min_df in (("body", BODY_MIN_DF), ("title", TITLE_MIN_DF), ("anchor", 0),
                        ("tokens", TITLE_MIN_DF)):
    CTES[f"{_field}_terms"] = (
        (f"{_field}_all",),
        f"SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM {_field}_all "
        f"GROUP BY term HAVING count(*) > {_min_df}",
    )
    CTES[_field] = (
        (f"{_field}_all", f"{_field}_terms"),
        f"SELECT term, doc_id, tf FROM {_field}_all WHERE term IN (SELECT term FROM {_field}_terms)",
    )
    CTES[f"{_field}_docs"] = (
        (_field,),
        f"SELECT doc_id, sum(tf)::BIGINT AS dl, sum(tf * tf)::BIGINT AS nf FROM {_field} GROUP BY doc_id",
    )


def _pagerank(name: str, edges: str, vertices: str, iters: int) -> None:
    """Adds ``iters`` unrolled rounds and the final scaling."""
    CTES[f"{name}_r0"] = ((edges, vertices), f"SELECT id, 1.0::DOUBLE AS rank FROM {vertices}")
    CTES[f"{name}_out"] = ((edges,), f"SELECT src, count(*) AS degree FROM {edges} GROUP BY src")
    for i in range(1, iters + 1):
        CTES[f"{name}_r{i}"] = (
            (f"{name}_r{i-1}", f"{name}_out"),
            f"""SELECT v.id, 0.15::DOUBLE + 0.85::DOUBLE * coalesce(s.got, 0) AS rank
            FROM {vertices} v LEFT JOIN (
              SELECT e.dst, sum(r.rank / o.degree) AS got FROM {edges} e
              JOIN {name}_r{i-1} r ON r.id = e.src JOIN {name}_out o ON o.src = e.src
              GROUP BY e.dst) s ON s.dst = v.id""",
        )
    CTES[name] = (
        (f"{name}_r{iters}",),
        f"""SELECT id, rank * (SELECT count(*) FROM {vertices})
          / (SELECT sum(rank) FROM {name}_r{iters}) AS pagerank FROM {name}_r{iters}""",
    )


_pagerank("link_pagerank", "edges", "vertices", 6)
_pagerank("link_pagerank_long", "edges", "vertices", 10)
_pagerank("purchase_pagerank", "purchases", "purchase_vertices", 6)

NAMES = ["b", "k1", "k3", "k4", "k5", "pr", "pv"]


def _drawn(n: int, seed: int, ranges, end_points: bool) -> str:
    columns = []
    for name in NAMES:
        low, high = ranges[name]
        key = f"'{seed}:{name}:' || param_id::VARCHAR"
        unit = f"({hashed(key)}::DOUBLE / {float(2**40)}::DOUBLE)"
        columns.append(
            f"CASE WHEN {unit} < 0.5 THEN {low}::DOUBLE ELSE {high}::DOUBLE END AS {name}"
            if end_points else f"{low}::DOUBLE + {high - low}::DOUBLE * {unit} AS {name}"
        )
    return f"SELECT param_id, {', '.join(columns)} FROM range({n}) t(param_id)"


def _sweep(name: str, params: str) -> None:
    CTES[f"{name}_params"] = ((), params)
    CTES[name] = (
        (f"{name}_params", "features", "queries", "qrels"),
        f"""SELECT param_id, coalesce(total_ap, 0) AS total_ap FROM {name}_params LEFT JOIN (
          SELECT param_id, sum(ap) AS total_ap FROM (
            SELECT param_id, query_id, round(avg(hits / rank), 3) AS ap FROM (
              SELECT param_id, query_id, rank, row_number() OVER (
                PARTITION BY param_id, query_id ORDER BY rank)::DOUBLE AS hits
              FROM (SELECT *, row_number() OVER (
                  PARTITION BY param_id, query_id ORDER BY round(score, 9) DESC, bm25_rank NULLS LAST,
                    title_words DESC, title_first NULLS LAST,
                    CASE WHEN title_words > 0 THEN doc_id END NULLS LAST,
                    anchor_words DESC, anchor_first NULLS LAST, doc_id) AS rank
                FROM (SELECT f.*, p.param_id,
                    (coalesce(CASE WHEN query LIKE '%?' THEN k1 ELSE b END / bm25_rank, 0)
                    + CASE WHEN title_words > 0 THEN CASE WHEN length(query) < 4
                        AND query NOT LIKE '%?' THEN k5 ELSE k3 END ELSE 0 END
                    + CASE WHEN anchor_words > 0 THEN k4 ELSE 0 END)
                    * p.pr * f.pr * p.pv * f.pv AS score
                  FROM features f JOIN queries q USING (query_id), {name}_params p))
              JOIN qrels USING (query_id, doc_id) WHERE rank <= 40)
            GROUP BY param_id, query_id)
          GROUP BY param_id) USING (param_id)""",
    )


_sweep("sweep", _drawn(100, 7, END_POINTS, True))
_sweep("sweep_uniform", _drawn(20, 7, RANGES, False))
_sweep("sweep_starts", "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, " + ", ".join(f"{v}::DOUBLE" for v in (*point, 1.5, 0.75)) + ")"
    for i, point in enumerate(STARTS)) + f") t(param_id, {', '.join(NAMES)})")


def with_ctes(select: str, *names: str) -> str:
    """``select`` behind the named expressions and all that they read."""
    ordered: list[str] = []

    def visit(name):
        if name in ordered:
            return
        for needed in CTES[name][0]:
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return select
    bodies = ",\n".join(f"{n} AS MATERIALIZED (\n      {CTES[n][1]})" for n in ordered)
    return f"WITH {bodies}\n{select}"


def _result(source: str, where: str = "") -> str:
    return (f"SELECT query_id, rank::INTEGER AS rank, doc_id, title, round(score, 6) AS score "
            f"FROM {source} JOIN titles USING (doc_id) {where}")


def _ranked(hits: str) -> str:
    return (f"SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, "
            f"first_word, doc_id)) AS rank, doc_id, title, score "
            f"FROM {hits} JOIN titles USING (doc_id)")


def _blocks(postings: str, span: int) -> str:
    return (f"SELECT term, doc_id // {span} AS block, string_agg(doc_id::VARCHAR || ':' || "
            f"tf::VARCHAR, ' ' ORDER BY doc_id) AS postings FROM {postings} GROUP BY 1, 2")


def _stat_rows(prefix: str) -> str:
    return (f"SELECT 'term' AS kind, term AS name, df AS first, cf AS second FROM {prefix}_terms "
            f"UNION ALL SELECT 'doc', doc_id::VARCHAR, dl, nf FROM {prefix}_docs")


def _index_rows(prefix: str) -> str:
    return (f"SELECT 'posting' AS kind, term AS name, doc_id, tf AS first, NULL::BIGINT AS second FROM {prefix} "
            f"UNION ALL SELECT 'term', term, NULL, df, cf FROM {prefix}_terms "
            f"UNION ALL SELECT 'doc', NULL, doc_id, dl, nf FROM {prefix}_docs")


SPAN = 256


def oracle_sql() -> dict[str, str]:
    c = with_ctes
    body_rows = "SELECT term, doc_id, tf FROM body"
    top_body = (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id "
                f"ORDER BY round(score, 9) DESC, pos, doc_id) AS rank FROM body_scores) "
                f"WHERE rank <= 100")
    return {
        # scans, sources, sinks
        "read_corpus": c(f"""SELECT d.doc_id AS id, title, text,
            coalesce(array_to_string(list_transform(l.ids, lambda i: i::VARCHAR), ' '), '') AS targets
            FROM documents d JOIN titles USING (doc_id) LEFT JOIN link_lists l ON l.src = d.doc_id""",
                         "titles", "link_lists"),
        "read_corpus_glob": c(f"""SELECT d.doc_id AS id, title, text,
            coalesce(array_to_string(list_transform(l.ids, lambda i: i::VARCHAR), ' '), '') AS targets
            FROM documents d JOIN titles USING (doc_id) LEFT JOIN link_lists l ON l.src = d.doc_id""",
                         "titles", "link_lists"),
        "corpus_count": "SELECT count(*) AS n FROM documents",
        "project_field": c("SELECT doc_id, title FROM titles", "titles"),
        "read_pageview_dump": c("SELECT line AS value, count(*) AS n FROM dump_lines GROUP BY line", "dump_lines"),
        "write_rank_csv": c("SELECT id AS doc_id, round(pagerank, 6) AS pagerank FROM link_pagerank", "link_pagerank"),
        "read_rank_csv": c("SELECT count(*) AS n, round(sum(pagerank), 4) AS total, "
                           "count(*) FILTER (pagerank > 1) AS above FROM link_pagerank", "link_pagerank"),
        "read_pageviews": c("SELECT count(*) AS articles, sum(views)::BIGINT AS views FROM pageviews", "pageviews"),
        "read_index": c(_index_rows("title"), "title", "title_terms", "title_docs"),
        "is_short_query": c("SELECT query_id, query FROM queries WHERE length(query) < 4 AND "
                            "query NOT LIKE '%?'", "queries"),
        "write_pageviews": c("SELECT doc_id, views FROM pageviews", "pageviews"),
        "read_qrels": c("SELECT DISTINCT query, doc_id FROM qrels JOIN queries USING (query_id)", "qrels", "queries"),
        "write_index": c(body_rows, "body"),
        "save_global_stats": c(_stat_rows("body"), "body_terms", "body_docs"),
        "delete_index": c("SELECT count(*) AS postings, 0::BIGINT AS left_over FROM title", "title"),
        "scan_postings": c(_blocks("body", SPAN), "body"),
        "lookup_postings": c("SELECT term, doc_id, tf FROM body WHERE term IN "
                             "(SELECT term FROM query_terms)", "body", "query_terms"),
        "lookup_postings_list": c(f"SELECT term, doc_id, tf FROM body WHERE term IN {words(LOOKED_UP)}", "body"),
        "show_top_ranks": c("SELECT id AS doc_id, round(pagerank, 6) AS pagerank FROM link_pagerank "
                            "ORDER BY round(pagerank, 9) DESC, id LIMIT 20", "link_pagerank"),
        # text and queries
        "tokenize": f"""SELECT term, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (
            SELECT doc_id, unnest({tokens('text')}) AS term FROM documents) GROUP BY term""",
        "index_stopwords": f"""SELECT term, count(*) AS n FROM (
            SELECT unnest({tokens('text')}) AS term FROM documents)
            WHERE term IN {words(index_stopwords())} GROUP BY term""",
        "query_stopwords": f"""SELECT term, count(*) AS n FROM (
            SELECT unnest({tokens('text')}) AS term FROM documents)
            WHERE term IN {words(query_stopwords())} GROUP BY term""",
        "remove_stopwords": f"""SELECT doc_id, len(list_filter(ts, lambda t: t NOT IN
            {words(index_stopwords())}))::INTEGER AS kept, len(ts)::INTEGER AS total FROM (
            SELECT doc_id, {tokens('text')} AS ts FROM documents)""",
        "tokenize_query": c("SELECT query_id, place::INTEGER AS pos, token FROM query_tokens", "query_tokens"),
        "query_term_counts": c("SELECT query_id, term, qtf, pos::INTEGER AS pos FROM query_terms", "query_terms"),
        "term_bucket": c(f"SELECT term, {hashed('term')} % 124 AS bucket FROM "
                         "(SELECT DISTINCT term FROM body_all)", "body_all"),
        "parse_pageview_line": c("SELECT doc_id, views FROM parsed_lines", "parsed_lines"),
        "is_question": c("SELECT query_id, query LIKE '%?' AS question, length(query) < 4 AND "
                         "query NOT LIKE '%?' AS short FROM queries", "queries"),
        "is_question_words": c(f"""SELECT query_id, question,
            CASE WHEN question THEN {W.rank_decay_question}::DOUBLE ELSE {W.rank_decay}::DOUBLE END AS x,
            CASE WHEN length(query) < 4 AND query NOT LIKE '%?' THEN {W.title_bonus_short}::DOUBLE
              ELSE {W.title_bonus}::DOUBLE END AS y
            FROM (SELECT *, query LIKE '%?' OR split_part(query, ' ', 1) IN {words(QUESTION_WORDS)} AS question
              FROM worded)""", "worded"),
        "query_nonempty": c("SELECT query_id, query FROM queries WHERE query_id IN "
                            "(SELECT query_id FROM query_terms)", "queries", "query_terms"),
        # index construction
        "term_frequencies": c("SELECT term, doc_id, tf FROM body_all", "body_all"),
        "posting_lists": c(_blocks("body_all", SPAN), "body_all"),
        "prune_rare_terms": c(body_rows, "body"),
        "document_frequency": c("SELECT term, count(*) AS df FROM body_all GROUP BY term", "body_all"),
        "partition_postings": c(f"SELECT {hashed('term')} % 124 AS bucket, term, doc_id, tf FROM body", "body"),
        "doc_length": c("SELECT doc_id, dl FROM body_docs", "body_docs"),
        "doc_norm": c("SELECT doc_id, nf FROM body_docs", "body_docs"),
        "collection_frequency": c("SELECT term, sum(tf)::BIGINT AS cf FROM body_all GROUP BY term", "body_all"),
        "raw_doc_length": f"SELECT doc_id, len({tokens('text')}) AS dl FROM documents",
        "index_from_tokens": c(_index_rows("tokens"), "tokens", "tokens_terms", "tokens_docs"),
        "append_index": c(_index_rows("body"), "body", "body_terms", "body_docs"),
        "compact_index": c(_index_rows("body"), "body", "body_terms", "body_docs"),
        "add_documents": c(_stat_rows("body"), "body_terms", "body_docs"),
        "avg_doc_length": c("SELECT round(avgdl, 6) AS avgdl FROM avgdl", "avgdl"),
        "title_lookup": c("SELECT doc_id, dl, title FROM body_docs JOIN titles USING (doc_id)", "body_docs", "titles"),
        "explode_anchors": c("SELECT src, dst, text FROM anchors", "anchors"),
        "anchor_documents": c("SELECT term, doc_id, tf FROM anchor_all", "anchor_all"),
        # ranking and lookup
        "search_bm25": c(_result("bm25"), "bm25", "titles"),
        "search_bm25_blocks": c(_result("bm25"), "bm25", "titles"),
        "search_bm25_tuned": c(_result("tuned"), "tuned", "titles"),
        "search_body": c(_result(f"({top_body})"), "body_scores", "titles"),
        "search_title": c(_ranked("title_hits"), "title_hits", "titles"),
        "search_anchor": c(_ranked("anchor_hits"), "anchor_hits", "titles"),
        "search": c(_result("hybrid"), "hybrid", "titles"),
        "query_weights": c("SELECT query_id, x, y FROM query_weights", "query_weights"),
        "prior_boost": c("""SELECT id AS doc_id, round(CASE WHEN pagerank > 1 THEN trunc(log10(pagerank))
            ELSE pagerank END, 6) AS pr, CASE WHEN coalesce(views, 0) > 1 THEN trunc(log2(views))
            WHEN coalesce(views, 0) < 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS pv
            FROM link_pagerank LEFT JOIN pageviews ON doc_id = id""", "link_pagerank", "pageviews"),
        "top_k_per_query": c("""SELECT query_id, doc_id, rank::INTEGER AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first_word, doc_id)
              AS rank FROM title_hits) WHERE rank <= 10""", "title_hits"),
        "top_k_per_query_5000": c("""SELECT query_id, doc_id, rank::INTEGER AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first_word, doc_id)
              AS rank FROM body_hits) WHERE rank <= 5000""", "body_hits"),
        "reciprocal_rank_score": c("SELECT query_id, doc_id, round(x / rank, 6) AS score FROM bm25 "
                                   "JOIN query_weights USING (query_id)", "bm25", "query_weights"),
        "membership_bonus": c("SELECT query_id, doc_id, y AS score FROM title_hits "
                              "JOIN query_weights USING (query_id)", "title_hits", "query_weights"),
        "get_pagerank": c("SELECT request_id, pos::INTEGER AS pos, doc_id, round(pagerank, 6) AS pagerank "
                          "FROM requests JOIN link_pagerank ON id = doc_id", "requests", "link_pagerank"),
        "get_pageview": c("SELECT request_id, pos::INTEGER AS pos, doc_id, coalesce(views, 0)::BIGINT AS views "
                          "FROM requests LEFT JOIN pageviews USING (doc_id)", "requests", "pageviews"),
        "matching_documents": c("SELECT DISTINCT query_id, doc_id FROM query_terms JOIN body USING (term)",
                                "query_terms", "body"),
        # link graph and page views
        "link_edges": c("SELECT src, dst FROM edges", "edges"),
        "link_vertices": c("SELECT id FROM vertices", "vertices"),
        "link_graph": c("""SELECT 'edge' AS kind, src, dst FROM edges UNION ALL
            SELECT 'vertex', id, NULL FROM vertices""", "edges", "vertices"),
        "pagerank": c("SELECT id, round(pagerank, 6) AS pagerank FROM link_pagerank", "link_pagerank"),
        "pagerank_10": c("SELECT id, round(pagerank, 6) AS pagerank FROM link_pagerank_long", "link_pagerank_long"),
        "pagerank_purchases": c("SELECT id, round(pagerank, 6) AS pagerank FROM purchase_pagerank", "purchase_pagerank"),
        "partition_graph": c("SELECT src, dst FROM purchases", "purchases"),
        "sort_ranks": c("SELECT id, round(pagerank, 6) AS pagerank FROM link_pagerank", "link_pagerank"),
        "pageviews_by_article": c("SELECT doc_id, views FROM pageviews", "pageviews"),
        # evaluation
        "average_precision": c("SELECT query_id, ap FROM ap", "ap"),
        "mean_average_precision": c("SELECT round(sum(ap) / count(*), 6) AS map FROM ap", "ap"),
        "evaluate_queries": c("SELECT query_id, query, ap FROM ap JOIN queries USING (query_id)", "ap", "queries"),
        "parameter_sweep": c("SELECT param_id, round(total_ap, 6) AS total_ap FROM sweep", "sweep"),
        "random_parameters": c("SELECT param_id, round(total_ap, 6) AS total_ap, "
                               + ", ".join(f"round({n}, 6) AS {n}" for n in NAMES)
                               + " FROM sweep_uniform JOIN sweep_uniform_params USING (param_id)",
                               "sweep_uniform", "sweep_uniform_params"),
        "parameter_starts": c("SELECT param_id::BIGINT AS param_id, round(total_ap, 6) AS total_ap FROM sweep_starts", "sweep_starts"),
        "best_parameters": c("SELECT param_id, round(total_ap, 6) AS total_ap FROM sweep WHERE total_ap > 0 "
                             "ORDER BY round(total_ap, 6) DESC, param_id LIMIT 1", "sweep"),
    }
