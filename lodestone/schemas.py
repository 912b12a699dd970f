"""Column types of every table the library reads or writes."""

from pyspark.sql import types as T

CORPUS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("anchor_text", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
    ]))),
])

POSTINGS = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("tf", T.LongType()),
    T.StructField("bucket", T.LongType()),
])

# As stored: every segment of an index has a number, the batch that it was written by, and one
# posting of each document carries the document's whole length and norm.
HEAD = T.StructField("head", T.StructType([
    T.StructField("dl", T.LongType()),
    T.StructField("nf", T.LongType()),
]))
MARKED_POSTINGS = T.StructType([*POSTINGS.fields, HEAD])
STORED_POSTINGS = T.StructType([*MARKED_POSTINGS.fields, T.StructField("batch", T.LongType())])

TERM_STATS = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("df", T.LongType()),
    T.StructField("cf", T.LongType()),
])

DOC_STATS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("dl", T.LongType()),
    T.StructField("nf", T.LongType()),
])

# Of each term and block of documents: postings, and the frequencies and lengths that may score highest.
BOUNDS = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("shapes", T.ArrayType(T.StructType([
        T.StructField("tf", T.LongType()),
        T.StructField("dl", T.LongType()),
    ]))),
    T.StructField("bits", T.IntegerType()),
    T.StructField("bucket", T.LongType()),
])

PAGERANK = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("pagerank", T.DoubleType()),
])

PAGEVIEWS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("views", T.LongType()),
])

PARAMETERS = T.StructType(
    [T.StructField("param_id", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in ("b", "k1", "k3", "k4", "k5", "pr", "pv")]
)
