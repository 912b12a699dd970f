"""URL filters, prefix tries and whitening, against plain versions on small awkward tables."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from lodestone.llm.prefix_trie import TRIE_SQL, Fragment, PrefixTrie, grown, merged, middle_first, prefix_trie
from lodestone.llm.url_filters import Term, UrlFilter, filter_urls, kept_pages, rule_and_term_sql
from lodestone.llm.whitening import Whitening, whiten

# ---- URL filters

PAGES = "page_id long, url string, html string, host int, verdict boolean, terms long"
URLS = [
    (1, "http://a.net/x"), (2, "http://net/"), (3, "http://a.net"), (4, "http://WWW.Example.NET/en/"),
    (5, "http://example.net/EN/"), (6, "https://m.example.com/de/casino"), (7, "http://x.org/fr/casino-win"),
    (8, "http://x.org/casino"), (9, "http://x.org/occasino"), (10, "http://x.org/Casinos?free"), (11, "http://x.org/escorted"),
    (12, "http://cheap-pills.org/"), (13, "http://cheap-free.org/"), (14, "http://x.org/a?q=free+win%20cheap"),
    (15, "http://x.org/pills/pills.pills"), (16, None), (17, ""), (18, "casino"), (19, "://"), (20, "http://é-casino.org/écasino"),
    (21, "http://x.org/%63asino"), (22, "http://x.org/p%2Fcasino%2F"), (23, "a://b://c.net/y"), (24, "http://notnet/fr/"),
    (25, "http://.net/"), (26, "http://x.org/fr/"), (27, "http://u@y.net:80/z#k"), (28, "http://x.org/" + "bets-" * 20_000),
    (28, "http://x.org/"), (None, "http://free-bets.org/"), (30, "http://x.org/fr#/fr/"), (31, "http://x.org\n/fr/"),
]


def pages(spark, rows=URLS):
    return spark.createDataFrame([(i, u, "<p>", 3, True, 4) for i, u in rows], PAGES)


def test_urls_equal_their_sql(spark):
    con = duckdb.connect()
    con.sql("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, 'h')", URLS)
    found = filter_urls(pages(spark))
    wanted = con.sql(f"SELECT {', '.join(found.columns)} FROM ({rule_and_term_sql()})").fetchall()
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)


def test_url_rules_and_terms(spark):
    rows = {r["page_id"]: r for r in filter_urls(pages(spark)).collect()}
    assert [rows[i]["rule"] for i in (1, 2, 3, 4, 5, 6, 7, 24, 26, 30)] == [
        "net/", "net/", None, "example.net/en/", "net/", "example.com/de/", "org/fr/", None, "org/fr/", None]
    assert rows[7]["verdict"] == "allow" and rows[7]["n_strict"] == 1
    for page, verdict in ((8, "block"), (9, "allow"), (10, "block"), (11, "allow"), (12, "block"), (13, "allow"),
                          (14, "block"), (15, "allow"), (16, "allow"), (18, "block"), (20, "block"), (22, "block")):
        assert rows[page]["verdict"] == verdict, page
    assert (rows[15]["n_soft"], rows[15]["n_hits"], rows[20]["n_hits"]) == (1, 3, 1)
    assert (rows[4]["host"], rows[4]["path"], rows[16]["host"], rows[27]["host"]) == ("www.example.net", "/en/", "", "u@y.net:80")
    assert filter_urls(pages(spark, [])).count() == 0
    kept = kept_pages(pages(spark))
    assert kept.columns == pages(spark).columns
    assert {r["page_id"] for r in kept.collect()} == {i for i, r in rows.items() if i is not None and r["verdict"] == "allow"}


def test_longest_rule_wins_among_many():
    how = UrlFilter(rules=(("b.c", "/", "block"), ("c", "/xyz", "allow"), ("a.b.c", "/", "allow"), ("b.c", "/", "allow")),
                    terms=(Term("ad", False, 2), Term("ad-free", False, 2), Term("free", False, 1)))
    assert how.rule("a.b.c", "/xyz") == ("a.b.c/", "allow")
    assert how.rule("z.b.c", "/") == ("b.c/", "block")
    assert how.rule("z.b.c", "/xyz") == ("c/xyz", "allow")
    assert how.rule("bb.c", "/") == (None, None)
    found, places = how.hits("ad-free, ad")
    assert {how.terms[k].text for k in found} == {"ad", "ad-free", "free"} and places == 4
    assert UrlFilter().hits("casino") == (set(), 0)


# ---- prefix tries

CHATS = "conv_id long, turn int, role string, text string, depth string, path int"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def chats(spark, rows):
    return spark.createDataFrame([(*r, "d", 1) for r in rows], CHATS)


def plain_trie(rows):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in said.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        made = tuple(turns.get(base, [])[:h] + own[h:])
        ends[made].append(c)
        for d in range(len(made) + 1):
            members[made[:d]].append(c)
    out = []
    for node, convs in members.items():
        under = [m for m in members if m[: len(node)] == node]
        leaves = [m for m in under if not any(len(k) == len(m) + 1 and k[: len(m)] == m for k in under)]
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    sum(len(k) == len(node) + 1 for k in under), len(leaves),
                    sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in under if m),
                    hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()))
    return sorted(out, key=repr)


def awkward_chats():
    rng = random.Random(3)
    rows = [(None, 0, "user", "lost"), (7, None, None, None), (7, 0, "user", None), (-3, 0, "user", "é" * 3),
            (-5, 0, "user", "below"), (-5, 1, "assistant", "zero"), (12, 1, "user", "late"), (12, 1, "user", "late"),
            (12, 1, "user", "early"), (12, 1, "assistant", "same turn"), (33, 0, "user", "x" * 100_000), (34, 0, "", "")]
    rows += [(200, k, "user", str(k % 3)) for k in range(120)]
    for c in range(40, 160):
        rows += [(c, k, ("user", "assistant")[k % 2], rng.choice(("ja", "nein", "dóch"))) for k in range(rng.randrange(0, 7))]
    # Copies of one conversation and one first turn for many.
    rows += [(c, k, "user", f"copy {k}") for c in range(1000, 3400, 5) for k in range(3)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("how", [PrefixTrie(), PrefixTrie(7, 2)])
def test_trie_equals_plain_counting(spark, how):
    rows = awkward_chats()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        found = prefix_trie(chats(spark, rows), how)
        assert tuple(found.columns) == NAMES
        assert sorted(map(tuple, found.collect()), key=repr) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trie_sql_equals_plain_counting():
    rows = awkward_chats()
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = con.sql(f"SELECT {', '.join(NAMES)} FROM ({TRIE_SQL})").fetchall()
    assert sorted(found, key=repr) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie(chats(spark, [])).count() == 0
    assert prefix_trie(chats(spark, [(None, 1, "user", "a")])).count() == 0
    rows = [(4, 0, "user", "gone")]  # its first turns come from an absent conversation
    assert [tuple(r) for r in prefix_trie(chats(spark, rows)).collect()] == plain_trie(rows)


def test_middle_first_balances_the_tree():
    assert sorted(middle_first(1000)) == list(range(1000))
    paths = [k.to_bytes(20, "big") for k in range(1000)]
    from lodestone.llm.prefix_trie import Tree, encoded
    tree, codes = Tree(), encoded(paths)
    for k in middle_first(1000):
        tree.insert(*codes[k])
    deepest, stack = 0, [(tree.down[0], 1)]
    while stack:
        node, depth = stack.pop()
        if node:
            deepest = max(deepest, depth)
            stack += [(tree.less[node], depth + 1), (tree.more[node], depth + 1)]
    assert deepest == 10 and [tree.symbol[n] for n in tree.children(0)] == list(range(1000))


def test_fragments_survive_packing():
    paths = [b"".join(w.rjust(16, b"\0") + (len(w) - 3).to_bytes(4, "big") for w in words) for words in
             ([b"aaaa"], [b"aaaa", b"bbbb\0"], [b"cccc", b"d" * 16])]
    loads = [(p, {len(p) // 20: (k + 1, k - 5, hashlib.sha256(p).hexdigest(), None)}) for k, p in enumerate(paths)]
    rows, fragment = grown(loads, False)
    again = Fragment.unpack(fragment.pack())
    assert again.paths == fragment.paths and again.records == fragment.records
    whole, left = merged([again], True)
    assert left is None and sorted(r[:2] for r in rows + whole) == [(-5, 0), (-5, 1), (-4, 2), (-3, 1), (-3, 2)]


# ---- whitening

VECTORS = "vec_id long, embedding array<float>, label int, component string, n double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 0.5) for i, v in rows], VECTORS)


def plain_whitening(rows, components=32, multiplicity=True):
    """{component}: whitened by rows, and the exact deviations, in the order of the rows."""
    whole = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows]
    fit = whole if multiplicity else [list(x) for x in sorted(set(map(tuple, whole)))]
    n, dims = len(fit), len(whole[0])
    sums = [sum(x[k] for x in fit) for k in range(dims)]
    def centred(xs):
        return np.array([[n * x[k] - sums[k] for k in range(dims)] for x in xs], object).astype(float) / n
    moved = centred(fit)
    values, basis = np.linalg.eigh(moved.T @ moved / n)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    deviations = [sum((n * x[k] - sums[k]) ** 2 for k in range(dims)) for x in whole]
    return centred(whole) @ basis / np.sqrt(values), deviations, values / np.trace(moved.T @ moved / n)


def random_vectors(copies=0, n=300, dims=40):
    rng = np.random.default_rng(5)
    scales = np.linspace(0.2, 3, dims)
    rows = [(k, (rng.normal(size=dims) * scales).tolist()) for k in range(n)]
    return rows + [(1000 + k, rows[0][1]) for k in range(copies)]


@pytest.mark.parametrize("how", [Whitening(), Whitening(hot_rows=10), Whitening(multiplicity=False), Whitening(components=3)])
def test_whitening_equals_numpy(spark, how):
    rows = random_vectors(copies=150)
    junk = [(-1, None), (-2, [None] * 40), (-3, [float("nan")] * 40), (-4, [float("inf")] * 40)]
    found = whiten(vectors(spark, rows + junk), how).toPandas().sort_values(["vec_id", "component"])
    white, deviations, shares = plain_whitening(rows, how.components, how.multiplicity)
    many = white.shape[1]
    assert found.vec_id.tolist() == [i for i, _ in rows for _ in range(many)]
    assert found.component.tolist() == list(range(1, many + 1)) * len(rows)
    assert found.deviation.tolist() == [d for d in deviations for _ in range(many)]
    got = found.whitened.to_numpy().reshape(-1, many)
    signs = np.sign((got * white).sum(0))
    assert np.abs(got * signs - white).max() < 1e-8
    assert np.allclose(found.explained.to_numpy()[:many], shares, rtol=1e-9)
    assert found.identity_error.nunique() == 1 and found.identity_error.iloc[0] < 1e-9
    assert found.n.unique().tolist() == [450 if how.multiplicity else 300]


def test_whitening_of_awkward_vectors(spark):
    assert whiten(vectors(spark, [])).count() == 0
    assert whiten(vectors(spark, [(1, []), (2, None)])).count() == 0
    assert whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0, "equal vectors have no variance"
    # Shorter vectors are filled up; repeated rows and null ids return each; huge entries stay exact.
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0]), (4, []), (5, [-2.0, 5.0])]
    found = whiten(vectors(spark, rows)).toPandas()
    assert len(found) == 10 and found.vec_id.isna().sum() == 2
    full = [(i, [*v, 0.0, 0.0][:2]) for i, v in rows]
    assert sorted(found.deviation) == sorted(plain_whitening(full)[1] * 2)
    huge = whiten(vectors(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [1e17, 3.0])])).toPandas()
    assert huge.deviation.isna().all() and huge.identity_error.iloc[0] < 1e-4
    wide = [(k, [float(k % 7) * 1e5, float(k)]) for k in range(30)]
    found = whiten(vectors(spark, wide)).toPandas().sort_values(["vec_id", "component"])
    assert found.deviation.tolist() == [d for d in plain_whitening(wide)[1] for _ in range(2)]
