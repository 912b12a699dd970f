"""Stopword lists.

Indexing and querying use different lists on purpose: a query word such as
"history" passes the query list but is never indexed, so it matches nothing.
"""

# The customary 179-word English list, in its published order.
ENGLISH = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Corpus words dropped when indexing.
INDEX_EXTRA = """
category references also external links may first see history people one two
part thumb including second following many however would became
""".split()

# Corpus words dropped from queries ("extenal" is spelled so).
QUERY_EXTRA = "category references also links extenal see thumb".split()


def _union(english, extra):
    return sorted(set(ENGLISH if english is None else english) | set(extra))


def index_stopwords(english=None):
    """Words never indexed; ``english`` replaces the English part."""
    return _union(english, INDEX_EXTRA)


def query_stopwords(english=None):
    """Words dropped from queries; ``english`` replaces the English part."""
    return _union(english, QUERY_EXTRA)
