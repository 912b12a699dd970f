"""Building inverted indexes.

Postings are kept as a long table (term, doc_id, tf). No step gathers a term's
whole list in one row or task.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stopwords import index_stopwords
from ..functions.text import bucket_of, term_bucket, tokenize
from ..plans.layout import cluster_by_bucket
from ..plans.runtime import stored_table
from ..plans.sizing import MAX_BROADCAST_ROWS, broadcast_if_bounded
from ..plans.skew import salted_join


@dataclass(frozen=True)
class Index:
    """One field's index.

    ``postings`` holds every term. The document-frequency threshold is applied
    through ``term_stats``, which every query joins anyway. ``n_buckets`` is set
    if ``postings`` has the bucket column of a stored index, ``documents`` (doc_id)
    if the index keeps the ids it holds, and ``cuts`` if it keeps the ids that
    split its documents into blocks (``doc_cuts``). ``increments`` is set if
    ``term_stats`` is the sum of increments (term, df, cf) of several segments.
    ``bounds`` is set if block bounds are stored, for blocks of 2^``block_bits`` ids.
    """

    postings: DataFrame
    term_stats: DataFrame
    doc_stats: DataFrame
    min_df: int = 0
    n_buckets: int | None = None
    documents: DataFrame | None = None
    cuts: list | None = None
    increments: DataFrame | None = None
    bounds: DataFrame | None = None
    block_bits: int | None = None

    @property
    def doc_ids(self) -> DataFrame:
        """Ids of all documents with a posting."""
        if self.documents is not None:
            return self.documents
        return self.postings.select("doc_id").distinct()

    @classmethod
    def from_postings(cls, postings: DataFrame, min_df: int = 0) -> "Index":
        stats = term_statistics(postings)
        documents = document_statistics(retained_postings(postings, stats, min_df))
        return cls(postings, stats, documents, min_df)

    @property
    def terms(self) -> DataFrame:
        """Statistics of the terms above the threshold."""
        return self.term_stats.where(F.col("df") > self.min_df)

    def statistics_of(self, wanted: DataFrame) -> DataFrame:
        """(term, df, cf) of the terms in ``wanted``, however frequent.

        Increments are picked before they are summed, so a few terms do not shuffle the
        whole vocabulary.
        """
        if self.increments is None:
            return self.term_stats.join(wanted, "term", "left_semi")
        return summed(self.increments.join(wanted, "term", "left_semi"), "term", "df", "cf")

    @property
    def retained(self) -> DataFrame:
        """Postings of the terms above the threshold."""
        return retained_postings(
            self.postings, self.term_stats, self.min_df, self.n_buckets is not None)


def summed(increments: DataFrame, key: str, *columns: str) -> DataFrame:
    """The increments of each key added up."""
    return increments.groupBy(key).agg(*[F.sum(c).alias(c) for c in columns])


def term_occurrences(docs: DataFrame, stopwords=None) -> DataFrame:
    """One row (term, doc_id) per token of (doc_id, text) that is not a stopword."""
    words = index_stopwords() if stopwords is None else list(stopwords)
    return docs.select(F.explode(tokenize("text")).alias("term"), "doc_id").where(
        ~F.col("term").isin(words)
    )


def count_tokens(docs: DataFrame, marked: bool = False) -> DataFrame:
    """(term, doc_id, tf) of (doc_id, tokens), counted inside each row.

    Tokens are sorted and runs of equal ones measured, so counting needs no
    shuffle. A doc_id is expected on one row only (``require_unique``). If ``marked``,
    the first posting of each row carries the row's length and norm in a column ``head``,
    which is null on all others.
    """
    words = docs.select(
        "doc_id",
        F.sort_array(F.coalesce("tokens", F.array().cast("array<string>"))).alias("words"),
    )
    word, size = F.col("words"), F.size("words").cast("bigint")
    starts = F.array_compact(F.transform(
        word, lambda this, i: F.when((i == 0) | (this != word[i - 1]), i)))
    runs = words.select("doc_id", "words", starts.alias("starts"))
    ends = F.slice(F.concat("starts", F.array(F.size("words"))), 2, F.size("starts"))
    carried = [F.lit(None).alias("head")]
    if marked:
        squares = F.aggregate(F.zip_with("starts", ends, lambda start, end: (end - start).cast("bigint")),
                              F.lit(0).cast("bigint"), lambda total, tf: total + tf * tf)
        carried = [F.struct(size.alias("dl"), squares.alias("nf")).alias("head")]
    # Behind the explode stand plain expressions only, which Spark compiles: no array is copied along with a posting.
    rows = runs.select("doc_id", "words", "starts", ends.alias("ends"), *carried).select(
        "doc_id", "words", "head", F.explode(F.arrays_zip("starts", "ends")).alias("run"))
    start = F.col("run.starts")
    return rows.select(
        word[start].alias("term"), "doc_id", (F.col("run.ends") - start).cast("bigint").alias("tf"),
        *([F.when(start == 0, F.col("head")).alias("head")] if marked else []))


def term_frequencies(docs: DataFrame, stopwords=None) -> DataFrame:
    """Postings (term, doc_id, tf) of (doc_id, text), one row per document, without a shuffle."""
    words = index_stopwords() if stopwords is None else list(stopwords)
    return count_tokens(docs.select("doc_id", tokenize("text").alias("tokens"))).where(
        ~F.col("term").isin(words))


def require_unique(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``docs`` itself, after a check that no doc_id stands on two rows or is in ``known``.

    Only ids are read and shuffled. A second posting of one term and document would
    count that document twice. Builds that store their postings (``index_documents``,
    ``append_index``) test this within the aggregate that they need anyway.
    """
    refuse(docs.groupBy("doc_id").count().where("count > 1"))
    if known is not None:
        refuse(docs.join(known.select("doc_id"), "doc_id", "left_semi"))
    return docs


def refuse(documents: DataFrame) -> None:
    """Raise an error that names some of the documents, if there are any."""
    bad = [row["doc_id"] for row in documents.select("doc_id").limit(5).collect()]
    if bad:
        raise ValueError(f"documents that are there already or come twice: {bad}")


def document_frequency(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(F.count("*").alias("df"))


def collection_frequency(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(F.sum("tf").alias("cf"))


def term_statistics(postings: DataFrame) -> DataFrame:
    """Document and collection frequency in one pass."""
    return postings.groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf")
    )


def doc_length(postings: DataFrame) -> DataFrame:
    return postings.groupBy("doc_id").agg(F.sum("tf").alias("dl"))


def doc_norm(postings: DataFrame) -> DataFrame:
    """Sum of squared term frequencies per document."""
    return postings.groupBy("doc_id").agg(F.sum(F.col("tf") * F.col("tf")).alias("nf"))


def document_statistics(postings: DataFrame) -> DataFrame:
    """Length and norm in one pass."""
    return postings.groupBy("doc_id").agg(
        F.sum("tf").alias("dl"), F.sum(F.col("tf") * F.col("tf")).alias("nf")
    )


def document_facts(postings: DataFrame, term_stats: DataFrame, min_df: int) -> DataFrame:
    """(doc_id, dl, nf, rows) of all documents with a posting, in one aggregate.

    Lengths and norms count the terms above the threshold only, and are 0 for documents
    without any. ``term_stats`` is a stored table. Marked postings (``count_tokens``) bring
    each document's whole length and norm along, from which the rare terms are subtracted:
    only one posting a document and those of rare terms are shuffled, and ``rows`` tells on
    how many rows a document came. Other postings are all shuffled, and ``rows`` is 1.
    """
    tf, frequent = F.col("tf"), F.lit(True)
    if min_df > 0:
        known = term_stats.where(F.col("df") > min_df).select("term", F.lit(True).alias("frequent"))
        postings = postings.join(broadcast_if_bounded(known, known.count()), "term", "left")
        frequent = F.col("frequent").isNotNull()
    if "head" not in postings.columns:
        dl, nf, rows = F.when(frequent, tf), F.when(frequent, tf * tf), F.lit(1)
    else:
        postings = postings.where(F.col("head").isNotNull() | ~frequent)
        dl, nf = (F.coalesce(F.col("head")[name], F.lit(0)) - F.when(frequent, 0).otherwise(rare)
                  for name, rare in (("dl", tf), ("nf", tf * tf)))
        rows = F.count("head")
    return postings.groupBy("doc_id").agg(
        F.coalesce(F.sum(dl), F.lit(0)).alias("dl"), F.coalesce(F.sum(nf), F.lit(0)).alias("nf"),
        rows.cast("bigint").alias("rows"))


def raw_doc_length(docs: DataFrame) -> DataFrame:
    """Number of tokens of (doc_id, tokens), before any pruning."""
    return docs.groupBy("doc_id").agg(
        F.coalesce(F.sum(F.size("tokens")), F.lit(0)).alias("dl")
    )


def retained_postings(postings: DataFrame, term_stats: DataFrame, min_df: int,
                      stored: bool = False) -> DataFrame:
    """Postings of terms in more than ``min_df`` documents.

    ``stored`` says that ``term_stats`` is a table on disk: Spark broadcasts it if
    its size allows, and otherwise splits skewed partitions of a plain join.
    Statistics derived in the same plan are joined with salted terms.
    """
    if min_df <= 0:
        return postings
    frequent = term_stats.where(F.col("df") > min_df).select("term")
    if stored:
        return postings.join(frequent, "term", "left_semi")
    return salted_join(postings, frequent, ["term"], "doc_id", "left_semi")


def prune_rare_terms(postings: DataFrame, min_df: int = 50) -> DataFrame:
    """Keep terms whose document frequency is strictly above ``min_df``.

    Postings are stored once, in the scratch folder, and both the frequencies and the
    result read that table: their documents are not tokenised twice.
    """
    postings = stored_table(postings, "postings")
    frequent = stored_table(
        document_frequency(postings).where(F.col("df") > min_df).select("term"), "frequent")
    return with_terms(postings, frequent)


def with_terms(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of the terms in a stored table: few are broadcast, many meet salted keys."""
    if terms.count() <= MAX_BROADCAST_ROWS:
        return postings.join(F.broadcast(terms), "term", "left_semi")
    return salted_join(postings, terms, ["term"], "doc_id", "left_semi")


def partition_postings(postings: DataFrame, n: int = 124) -> DataFrame:
    """Postings with their bucket, gathered by bucket and sorted inside tasks."""
    return cluster_by_bucket(postings, n).select("bucket", "term", "doc_id", "tf")


def posting_lists(postings: DataFrame, span: int = 65536) -> DataFrame:
    """Sorted posting lists, cut into blocks of document ids.

    A block covers ``span`` ids and so never holds more than ``span`` entries,
    however frequent the term. A term's blocks in order are its whole list.
    """
    block = F.floor(F.col("doc_id") / span).alias("block")
    return postings.groupBy("term", block).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")
    )


def scan_postings(index: Index, span: int = 65536) -> DataFrame:
    """All posting lists of the index, as :func:`posting_lists`."""
    return posting_lists(index.retained, span)


def lookup_postings(index: Index, terms) -> DataFrame:
    """Postings of some terms only.

    With a Python list, bucket and term become literals: Spark prunes bucket
    folders while planning and row groups by the term's range. With a table
    (column term), the bucket joins too: the terms are counted and, if few
    enough, broadcast, which prunes folders at run time and leaves postings where
    they are. More terms meet the postings with salted keys.
    """
    if not isinstance(terms, DataFrame):
        terms = sorted(set(terms))
        found = index.retained.where(F.col("term").isin(terms))
        if index.n_buckets:
            buckets = sorted({bucket_of(t, index.n_buckets) for t in terms})
            found = found.where(F.col("bucket").isin(buckets))
        return found.select("term", "doc_id", "tf")
    wanted = terms.select("term").distinct().join(index.terms.select("term"), "term", "left_semi")
    keys = ["term"]
    if index.n_buckets:
        wanted = wanted.withColumn("bucket", term_bucket("term", index.n_buckets))
        keys = ["bucket", "term"]
    wanted = stored_table(wanted, "wanted")
    if wanted.count() <= MAX_BROADCAST_ROWS:
        # Spark prunes folders at run time only by a side with a filter of its own.
        few = wanted.where("bucket >= 0") if index.n_buckets else wanted
        found = index.postings.join(F.broadcast(few), keys, "left_semi")
    else:
        found = salted_join(index.postings, wanted, keys, "doc_id", "left_semi")
    return found.select("term", "doc_id", "tf")


def build_index(docs: DataFrame, min_df: int = 50, stopwords=None) -> Index:
    """Index of (doc_id, text), one row per document."""
    return Index.from_postings(term_frequencies(require_unique(docs), stopwords), min_df)


def index_from_tokens(docs: DataFrame, min_df: int = 0) -> Index:
    """Index of (doc_id, tokens), one row per document."""
    return Index.from_postings(count_tokens(require_unique(docs)), min_df)


def add_documents(index: Index, docs: DataFrame) -> Index:
    """The index with a batch of new (doc_id, tokens) added, as a plan.

    Term statistics are summed with those of the batch, without reading the old
    postings again. The batch's postings and the sums are stored once, in the scratch
    folder, so that texts are tokenised once. Document statistics are retaken, as a term that crosses the
    threshold also changes old documents; ``append_index`` adds to a stored index
    without that. Ids that are in the index or come twice are refused.
    """
    new = stored_table(count_tokens(require_unique(docs, index.doc_ids)), "new")
    postings = index.postings.select("term", "doc_id", "tf").unionByName(new)
    stats = stored_table(
        summed(index.term_stats.unionByName(term_statistics(new)), "term", "df", "cf"), "totals")
    retained = postings
    if index.min_df > 0:
        retained = with_terms(postings, stats.where(F.col("df") > index.min_df).select("term"))
    documents = document_statistics(retained)
    return Index(postings, stats, documents, index.min_df)


def avg_doc_length(body: Index, title: Index, anchor: Index, n) -> DataFrame:
    """Mean over the corpus of the longest field of each body-indexed document."""
    lengths = body.doc_stats.select("doc_id", "dl")
    for name, index in (("title_dl", title), ("anchor_dl", anchor)):
        lengths = lengths.join(
            index.doc_stats.select("doc_id", F.col("dl").alias(name)), "doc_id", "left"
        )
    longest = F.greatest("dl", F.coalesce("title_dl", F.lit(0)), F.coalesce("anchor_dl", F.lit(0)))
    return lengths.agg(F.sum(longest).alias("total")).select(
        (F.col("total") / n).alias("avgdl")
    )


def project_titles(corpus: DataFrame) -> DataFrame:
    """(doc_id, title) of every article."""
    return corpus.select(F.col("id").alias("doc_id"), "title")


def title_lookup(df: DataFrame, titles: DataFrame) -> DataFrame:
    """Add the title of each doc_id; ids without a title drop out."""
    return df.join(titles.select("doc_id", "title"), "doc_id")


def explode_anchors(corpus: DataFrame) -> DataFrame:
    """Every outgoing link as (src, dst, text)."""
    return corpus.select(
        F.col("id").alias("src"), F.explode("anchor_text").alias("link")
    ).select("src", F.col("link.id").alias("dst"), F.col("link.text").alias("text"))


def anchor_documents(corpus: DataFrame, stopwords=None) -> DataFrame:
    """Postings of the text of all links that point at a document.

    Each link is tokenised by itself and counts are summed before and after the
    shuffle, so a page that draws a third of all links needs no joined text.
    """
    links = explode_anchors(corpus).select(F.col("dst").alias("doc_id"), "text")
    return (
        term_occurrences(links, stopwords)
        .groupBy("term", "doc_id").agg(F.count("*").alias("tf"))
    )
