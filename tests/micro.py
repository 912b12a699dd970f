"""A small corpus and a plain Python search over it, written from the formulas."""

import math
import re
from collections import Counter, defaultdict

from lodestone.functions import index_stopwords, query_stopwords
from lodestone.schemas import CORPUS

ARTICLES = [
    (1, "Red apple", "apple apple banana cherry apple", [(2, "banana tree"), (3, "cherry pie"), (2, "banana")]),
    (2, "Banana tree", "banana banana tree green tree", [(1, "red apple"), (9, "lost apple page")]),
    (3, "Cherry pie", "cherry pie apple pie dessert", [(1, "apple"), (1, "apple"), (3, "self cherry")]),
    (4, "Green tea", "green tea green leaf leaf leaf leaf", [(2, "green banana")]),
    (5, "Apple pie", "apple pie recipe dessert sugar", []),
    (6, "Banana tree", "banana banana tree green tree", [(4, "tea tea tea")]),
    (7, "History", "history of the", [(5, "history")]),
]
QUERIES = [
    (1, "apple pie"), (2, "banana banana tree?"), (3, "tea"), (4, ""), (5, "the of"),
    (6, "history apple"), (7, "green GREEN leaf dessert"), (8, "cherry unknownword"),
]
PAGERANK = [(1, 0.4), (2, 15.0), (3, 5.0), (4, 1.0), (5, 0.9), (7, 120.0)]
PAGEVIEWS = [(1, 1), (2, 9), (3, 64), (5, 0)]
WORD = re.compile(r"[#@\w](?:['\-]?\w){2,24}", re.UNICODE)


def words(text, stop):
    return [t for t in WORD.findall(text.lower()) if t not in stop]


def corpus(spark):
    return spark.createDataFrame(ARTICLES, CORPUS)


class Field:
    def __init__(self, docs, min_df=0):
        stop = set(index_stopwords())
        lists = defaultdict(Counter)
        for doc, text in docs:
            for t in words(text, stop):
                lists[t][doc] += 1
        self.lists = {t: dict(sorted(c.items())) for t, c in lists.items() if len(c) > min_df}
        self.dl, self.nf = Counter(), Counter()
        for c in self.lists.values():
            for d, f in c.items():
                self.dl[d] += f
                self.nf[d] += f * f


class Engine:
    """One query at a time, in dictionaries, with stable sorts over insertion order."""

    def __init__(self, min_df=0):
        self.titles = {a[0]: a[1] for a in ARTICLES}
        self.n = len(ARTICLES)
        self.body = Field([(a[0], a[2]) for a in ARTICLES], min_df)
        self.title = Field([(a[0], a[1]) for a in ARTICLES])
        self.anchor = Field([(d, t) for a in ARTICLES for d, t in a[3]])
        self.avgdl = sum(
            max(v, self.title.dl.get(d, 0), self.anchor.dl.get(d, 0))
            for d, v in self.body.dl.items()) / self.n
        self.pr, self.pv = dict(PAGERANK), dict(PAGEVIEWS)
        self.stop = set(query_stopwords())

    def bm25(self, query):
        scores = {}
        for t in words(query, self.stop):
            posting = self.body.lists.get(t, {})
            df = len(posting)
            for d, f in posting.items():
                idf = math.log(1 + (self.n - df + 0.5) / (df + 0.5))
                s = idf * f * 2.0 / (f + (0.1 + 0.9 * self.body.dl[d] / self.avgdl))
                scores[d] = scores.get(d, 0) + s * (11.0 * f / (10.0 + f))
        return self._top(scores)[:100]

    def cosine(self, query):
        tokens = words(query, self.stop)
        counts, scores = Counter(tokens), {}
        for t in tokens:
            posting = self.body.lists.get(t, {})
            for d, f in posting.items():
                w = f / self.body.dl[d] * math.log2(len(self.body.dl) / len(posting))
                scores[d] = scores.get(d, 0) + w * counts[t]
        norm = math.sqrt(sum(c * c for c in counts.values()))
        return self._top({d: s / norm / math.sqrt(self.body.nf[d]) for d, s in scores.items()})[:100]

    def matches(self, query, field, titled=False):
        counts = {}
        for t in sorted(set(words(query, self.stop))):
            for d in field.lists.get(t, {}):
                counts[d] = counts.get(d, 0) + 1
        return [(d, c) for d, c in self._top(counts) if not titled or d in self.titles]

    def hybrid(self, query):
        x = 1304.4103830767667 if query.endswith("?") else 149.15920831630416
        short = len(query) < 4 and not query.endswith("?")
        y = 59.41622193605568 if short else 5.193904691848007
        scores = {}
        for i, (d, _) in enumerate(self.bm25(query)):
            scores[d] = scores.get(d, 0) + x / (i + 1)
        for d, _ in self.matches(query, self.title):
            scores[d] = scores.get(d, 0) + y
        for d, _ in self.matches(query, self.anchor, titled=True):
            scores[d] = scores.get(d, 0) + 4.548782213371328
        for d in scores:
            pr = self.pr.get(d, 1.0)
            pr = int(math.log10(pr)) if pr > 1 else pr
            pv = self.pv.get(d, 0)
            pv = int(math.log2(pv)) if pv > 1 else 2.0 if pv < 1 else pv
            scores[d] = scores[d] * 1.5 * pr * 0.75 * pv
        return self._top(scores)[:100]

    @staticmethod
    def _top(scores):
        return sorted(scores.items(), key=lambda e: round(e[1], 9), reverse=True)
