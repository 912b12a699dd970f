"""URL filters: host and path rules first, a weighted vocabulary for the rest.

The longest fitting rule decides. Where none fits, an Aho-Corasick automaton streams over the
URL behind its scheme and finds every place of every term. A place counts if the term stands
by itself: no letter or digit touches its start nor, unless the term is open, its end. Each
distinct term found adds its weight once. A strict term has the whole limit as its weight, so
one rejects; soft terms have less, so it takes several distinct ones.

URLs are judged row by row, with A to Z lower-cased and every percent escape read as a blank.
Characters beyond ASCII count as letters. A null URL, or one without ``://``, has an empty host
and path and no rule fits it; a null or empty one has no hits either and is allowed. Repeated
rows are judged each by themselves, a null page_id stays null, other columns are not read, and
an empty table gives an empty result. Memory follows the longest single URL.
"""

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import in_arrow
from .words import slices

# The rules of the contract (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

# Terms that reject by themselves. An open term may go on ("casinos").
STRICT = ("casino*", "porn*", "viagra", "cialis", "hentai", "xxx", "sexcam*", "camgirl*", "escort", "escorts",
          "jackpot*", "warez", "keygen*", "malware", "spam*")
# Soft terms of weight 2 and of weight 1.
SOFT = ("pills", "pharmacy", "bets", "betting", "poker", "slots", "gambling", "lottery", "adult", "nude", "sexy",
        "dating", "payday", "loans", "torrent*", "crack", "ads", "adserver*", "popunder*", "clickbait", "replica*",
        "steroid*", "crypto")
FAINT = ("free", "cheap", "win", "winner*", "bonus", "track", "tracker*", "tracking", "promo*", "deal", "deals",
         "discount*", "buy", "cash", "hot", "download*", "click")

NAMED = "[a-z0-9]|[^\\x00-\\x7F]"


@dataclass(frozen=True)
class Term:
    text: str
    strict: bool
    weight: int
    open: bool = False


@dataclass(frozen=True)
class UrlFilter:
    """Rules and vocabulary. ``limit`` is the weight that rejects; strict terms reject at any weight."""

    rules: tuple = RULES
    terms: tuple = ()
    limit: int = 3

    @cached_property
    def automaton(self):
        found = ahocorasick.Automaton()
        for k, term in enumerate(self.terms):
            found.add_word(term.text, k)
        found.make_automaton()
        return found

    @cached_property
    def paths(self) -> dict:
        """{host: [(path, verdict)]}, block before allow where a rule is given twice."""
        by_host: dict = {}
        for host, path, verdict in sorted(self.rules, key=lambda r: r[2] != "block"):
            by_host.setdefault(host, []).append((path, verdict))
        return by_host

    def rule(self, host: str, path: str):
        """(rule, verdict) of the longest rule that fits, the longer host among equally long ones."""
        best, size, at = (None, None), -1, 0
        while True:
            part = host[at:]
            for start, verdict in self.paths.get(part, ()):
                if len(part) + len(start) > size and path.startswith(start):
                    best, size = (part + start, verdict), len(part) + len(start)
            at = host.find(".", at) + 1
            if not at:
                return best

    def hits(self, text: str) -> tuple[set, int]:
        """The distinct terms that stand in ``text`` and the number of all their places."""
        found, places = set(), 0
        if not len(self.automaton):
            return found, places
        for end, k in self.automaton.iter(text):
            term = self.terms[k]
            before = end - len(term.text)
            if before >= 0 and _named(text[before]):
                continue
            if not term.open and end + 1 < len(text) and _named(text[end + 1]):
                continue
            found.add(k)
            places += 1
        return found, places


def _named(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9" or c > "\x7f"


def vocabulary(limit: int = 3) -> tuple:
    """The terms of this module with their weights."""
    groups = ((STRICT, True, limit), (SOFT, False, 2), (FAINT, False, 1))
    return tuple(Term(t.rstrip("*"), strict, weight, t.endswith("*")) for terms, strict, weight in groups for t in terms)


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def behind_scheme(url: Column) -> Column:
    """What follows the first ``://``, null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def url_host(url: Column) -> Column:
    """What stands between the scheme and the path, A to Z lower-cased; empty without a scheme."""
    return F.coalesce(lower_ascii(F.regexp_extract(behind_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to a query or fragment, as written; empty without a scheme."""
    return F.coalesce(F.regexp_extract(behind_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def searched_text(url: Column) -> Column:
    """The text that the vocabulary is looked up in."""
    text = lower_ascii(F.coalesce(behind_scheme(url), url, F.lit("")))
    return F.regexp_replace(text, "%[0-9a-f]{2}", " ")


VERDICTS = ("page_id long, host string, path string, rule string, verdict string, n_strict long, n_soft long, "
            "weight long, n_hits long, terms string")


def filter_urls(pages: DataFrame, how: UrlFilter | None = None) -> DataFrame:
    """A verdict per row of (page_id, url), with the rule or the terms behind it.

    ``n_strict`` and ``n_soft`` count distinct terms, ``weight`` adds their weights, ``n_hits``
    counts all places, ``terms`` lists the distinct terms in order. They are told for every
    URL, also where a rule decides. One pass without a shuffle.
    """
    how = UrlFilter(terms=vocabulary()) if how is None else how
    types = pa.schema([(name, pa.int64() if kind == "long" else pa.string())
                       for name, kind in (field.split() for field in VERDICTS.split(", "))])

    def judge(batches):
        for batch in batches:
            for part in slices(batch, "searched"):
                ids, hosts, paths, texts = (part.column(name) for name in ("page_id", "host", "path", "searched"))
                rows = []
                for host, path, text in zip(hosts.to_pylist(), paths.to_pylist(), texts.to_pylist()):
                    rule, verdict = how.rule(host, path)
                    found, places = how.hits(text)
                    terms = [how.terms[k] for k in found]
                    strict, weight = sum(t.strict for t in terms), sum(t.weight for t in terms)
                    if verdict is None:
                        verdict = "block" if strict or weight >= how.limit else "allow"
                    names = ",".join(sorted(t.text for t in terms))
                    rows.append((rule, verdict, strict, len(terms) - strict, weight, places, names))
                made = zip(*rows) if rows else [()] * 7
                columns = [ids, hosts, paths, *(list(c) for c in made)]
                yield pa.record_batch([pa.array(c, t.type) if isinstance(c, list) else c.cast(t.type)
                                       for c, t in zip(columns, types)], schema=types)

    url = F.col("url")
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), url_host(url).alias("host"),
                          url_path(url).alias("path"), searched_text(url).alias("searched"))
    return in_arrow(narrow, judge, VERDICTS)


def kept_pages(pages: DataFrame, how: UrlFilter | None = None) -> DataFrame:
    """The pages whose URL is allowed, by page_id, with all their columns.

    Pages that share an id stay if all of their URLs are allowed; pages without an id are left out.
    """
    blocked = filter_urls(pages, how).where("verdict = 'block'").select("page_id").distinct()
    return pages.where("page_id is not null").join(blocked, "page_id", "left_anti")


def rule_and_term_sql(how: UrlFilter | None = None) -> str:
    """DuckDB's form of :func:`filter_urls` over a table ``pages``."""
    how = UrlFilter(terms=vocabulary()) if how is None else how
    rules = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in how.rules)
    terms = ", ".join(f"('{t.text}', {t.strict}, {t.weight}, {t.open})" for t in how.terms)
    return rf"""
WITH rules(rule_host, rule_path, says) AS (VALUES {rules}),
vocabulary(term, strict, weight, open) AS (VALUES {terms}),
parted AS (
  SELECT row_number() OVER () AS uid, page_id, url,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
urls AS (
  SELECT uid, page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    ' ' || regexp_replace(translate(coalesce(rest, url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '%[0-9a-f]{{2}}', ' ', 'g') || ' ' AS searched
  FROM parted),
fitting AS (
  SELECT uid, arg_max(rule_host || rule_path, size) AS rule, arg_max(says, size) AS says
  FROM (SELECT uid, rule_host, rule_path, says, length(rule_host || rule_path) AS size
        FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
          AND starts_with(path, rule_path)) GROUP BY uid),
places AS (
  SELECT uid, term, strict, weight
  FROM urls JOIN vocabulary ON contains(searched, term), LATERAL (SELECT unnest(range(1, length(searched))) AS i)
  WHERE substr(searched, i + 1, length(term)) = term
    AND NOT regexp_matches(substr(searched, i, 1), '{NAMED}')
    AND (open OR NOT regexp_matches(substr(searched, i + 1 + length(term), 1), '{NAMED}'))),
terms AS (SELECT uid, term, strict, weight, count(*) AS n FROM places GROUP BY uid, term, strict, weight),
found AS (
  SELECT uid, count(*) FILTER (strict) AS n_strict, count(*) FILTER (NOT strict) AS n_soft,
    sum(weight)::BIGINT AS weight, sum(n)::BIGINT AS n_hits, string_agg(term, ',' ORDER BY term) AS terms
  FROM terms GROUP BY uid)
SELECT page_id, host, path, rule,
  coalesce(says, CASE WHEN n_strict > 0 OR weight >= {how.limit} THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(n_strict, 0)::BIGINT AS n_strict, coalesce(n_soft, 0)::BIGINT AS n_soft,
  coalesce(weight, 0)::BIGINT AS weight, coalesce(n_hits, 0)::BIGINT AS n_hits, coalesce(terms, '') AS terms
FROM urls LEFT JOIN fitting USING (uid) LEFT JOIN found USING (uid)
"""
