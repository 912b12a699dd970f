"""Near-dedup, substring dedup and decontamination against brute force."""

import hashlib
import random
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.llm.decontaminate import Decontamination, Items, best_match, clean, contaminated
from lodestone.llm.near_dedup import NearDedup, near_duplicates, one_permutation, representatives
from lodestone.llm.substring_dedup import SubstringDedup, repeated_digests, without_repeats
from lodestone.llm.tables import components, numbered, stored
from lodestone.llm.words import LOWER, NOT_ALNUM, Words

from .cases import awkward_docs, awkward_rows, edit_distance, empty_docs, jaccard_groups, kept_words, prose, words


def copies(rng, n=60, size=80):
    """Texts at many similarities around the threshold, some linked only through others."""
    base = prose(rng, size, 5000).split()
    rows, current = [], base
    for i in range(n):
        source = rng.choice([base, current])
        current = [w if rng.random() > 0.03 else f"e{rng.randrange(900)}" for w in source]
        rows.append((i, " ".join(current)))
    return rows


def as_groups(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_near_duplicates_equal_all_pairs(spark, seed):
    rng = random.Random(seed)
    rows = copies(rng) + [(100 + i, t) for i, t in copies(rng, 40, 12)]
    wanted = jaccard_groups(rows)
    assert as_groups(near_duplicates(awkward_docs(spark, rows))) == wanted
    # The same with groups cut into many blocks.
    assert as_groups(near_duplicates(awkward_docs(spark, rows), NearDedup(block=7))) == wanted


def test_near_duplicates_of_awkward_rows(spark):
    rows = awkward_rows()
    found = near_duplicates(awkward_docs(spark, rows)).collect()
    wanted = jaccard_groups([r for r in rows if r[0] is not None])
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == wanted[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert near_duplicates(empty_docs(spark)).count() == 0
    kept = representatives(awkward_docs(spark, rows))
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == awkward_docs(spark, rows).columns and ids.count(16) == 1 and ids.count(None) == 2
    assert {i for i in ids if i is not None} == {i for i, (_, c) in wanted.items() if i == c}


def test_repeated_ids_are_compared_once_a_class(spark, monkeypatch):
    """Rows that repeat two near ids in turns, with texts that come and go, make one row a pair of classes."""
    from lodestone.llm import near_dedup

    rng = random.Random(3)
    base = prose(rng, 90, 5000)
    near, far = base.replace(" ", " \t", 30) + " one", prose(rng, 90, 5000)
    rows = [(1 + k % 2, (base, near)[k % 2] + " " * (k % 7)) for k in range(300)]
    # The same id with a text of its own, with another id's text, and with an empty one.
    rows += [(2, far), (5, far), (2, None), (7, "alone"), (7, base + " two"), (9, far + " three"), (9, far + " three")]
    rng.shuffle(rows)
    seen = []
    kept = near_dedup._compared
    monkeypatch.setattr(near_dedup, "_compared", lambda *a: seen.append(kept(*a)) or seen[-1])
    found = near_duplicates(awkward_docs(spark, rows)).collect()
    assert len(found) == len(rows)
    # Classes: base, near and base + two; far and far + three; alone.
    assert 3 <= seen[0].count() <= 4 and seen[0].select("class_a", "class_b").distinct().count() == seen[0].count()
    for r in found:
        empty = r["doc_id"] == 2 and not r["n_shingles"]
        assert r["component_id"] == (2 if empty else 1), r


def test_permutation_bins_match_as_often_as_sets_overlap():
    rng = np.random.default_rng(1)
    for size in (7, 60, 2000):
        shared = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        equal = []
        for _ in range(40):
            own = rng.integers(0, 1 << 63, (2, max(1, size // 9)), dtype=np.uint64)
            shared = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            a, b = one_permutation([np.sort(np.concatenate([shared, x])) for x in own], 160)
            equal.append((a == b).mean())
        assert abs(np.mean(equal) - size / (size + 2 * max(1, size // 9))) < 0.03


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(5)
    ids = rng.sample(range(10_000), 120)
    edges = list(zip(ids[:50], ids[1:50])) + [(ids[50], x) for x in ids[51:100]] + [(ids[100], ids[100])]
    edges += list(zip(ids[101:120], ids[102:120])) + [(ids[119], ids[101])]
    found = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for part in (ids[:50], ids[50:100], ids[101:120]):
        assert {found[i] for i in part} == {min(part)}
    none = spark.createDataFrame([], "a long, b long")
    assert components(none).count() == 0


def test_numbering_is_gapless_with_hot_and_null_keys(spark):
    df = stored(spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.lit(1)).alias("k"), F.col("id").alias("uid")), "n")
    rows = numbered(df, ["k"], ["uid"], rows_a_block=100).groupBy("k").agg(
        F.collect_set("place").alias("places"), F.count("*").alias("n")).collect()
    for r in rows:
        assert sorted(r["places"]) == list(range(r["n"]))
    assert sum(r["n"] for r in rows) == 5000


def digests(rows):
    return {i: (len(w), len(w) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest())
            for i, (w, k) in kept_words(rows).items()}


@pytest.mark.parametrize("how", [SubstringDedup(), SubstringDedup(hot=2, shard_segments=5)])
def test_repeats_equal_a_scan_of_all_windows(spark, how):
    rng = random.Random(11)
    passages = [prose(rng, rng.randrange(15, 70)) for _ in range(12)] + ["one two " * 20, "tick " * 45]
    rows = []
    for i in range(50):
        parts = [prose(rng, rng.randrange(0, 40)) for _ in range(4)] + rng.choices(passages, k=3)
        rng.shuffle(parts)
        rows.append((i, "\n".join(parts)))
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
             for r in repeated_digests(awkward_docs(spark, rows), how).collect()}
    assert found == digests(rows)


def test_repeats_of_awkward_rows(spark):
    rows = awkward_rows()
    found = repeated_digests(awkward_docs(spark, rows)).collect()
    assert len(found) == len(rows)
    single = [r for r in rows if r[0] is not None and r[0] != 16]
    wanted = digests(single)
    for r in found:
        if r["doc_id"] in wanted:
            assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == wanted[r["doc_id"]]
    # Rows that repeat an id are one document: its first windows keep their words in each.
    assert len({(r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found if r["doc_id"] == 16}) == 1
    # Rows without an id come last.
    assert [r["n_removed"] for r in found if r["doc_id"] is None and r["n_words"]] == [120]
    assert repeated_digests(empty_docs(spark)).count() == 0


def test_rewritten_texts_hold_the_kept_words(spark):
    rows = [r for r in awkward_rows() if r[0] is not None and r[0] != 16]
    docs = awkward_docs(spark, rows)
    kept = {r["doc_id"]: r for r in without_repeats(docs).collect()}
    for i, (w, left) in kept_words(rows).items():
        if w and not left:
            assert i not in kept
        else:
            assert words(kept[i]["text"]) == left
            if len(w) == len(left):
                assert kept[i]["text"] == dict(rows)[i]
            else:
                assert kept[i]["n_chars"] == len(kept[i]["text"])
    assert without_repeats(docs).columns == docs.columns and without_repeats(empty_docs(spark)).count() == 0


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        k, kind = rng.randrange(len(w)), rng.randrange(3)
        if kind == 0:
            w[k] = "zz"
        elif kind == 1:
            w.insert(k, "yy")
        elif len(w) > 1:
            del w[k]
    return " ".join(w)


def test_decontamination_finds_edited_items(spark):
    rng, how = random.Random(4), Decontamination()
    items = [(i, prose(rng, rng.randrange(8, 60), 3000).replace(".", "")) for i in range(30)]
    items += [(90, "one two three four"), (91, "a b"), (92, ""), (93, None), (None, prose(rng, 20))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(1))
    rows, planted = [], set()
    for k in range(300):
        i, text = items[rng.randrange(30)]
        inside = edited(rng, text, rng.randint(0, how.edits(len(text.split()))))
        rows.append((k, prose(rng, 40) + " " + inside.title() + ", " + prose(rng, 40)))
        planted.add((k, i))
    clean_rows = [(1000 + k, prose(rng, 100)) for k in range(100)] + [(2000, None), (2001, "One, TWO three-four!")]
    found = contaminated(awkward_docs(spark, rows + clean_rows), bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert len(planted - got) <= 3  # target recall 0.99
    assert (2001, 90) in got and not {d for d, _ in got} & {r[0] for r in clean_rows[:-1]}
    texts = dict(rows + clean_rows)
    for r in found[:60]:
        item = [w for w in dict(items)[r["item_id"]].lower().split()]
        text = [w.strip(".,!").lower() for w in texts[r["doc_id"]].replace("-", " ").split()]
        near = min(edit_distance(item, text[r["start"] : r["start"] + n]) for n in range(len(item) * 2))
        assert near == r["distance"] <= how.edits(len(item))
    small = contaminated(awkward_docs(spark, rows), bench, replace(how, items_a_block=7))
    assert {(r["doc_id"], r["item_id"]) for r in small.collect()} == {p for p in got if p[0] < 1000}


@pytest.mark.parametrize("n", [20, 50, 120, 200])
@pytest.mark.parametrize("kind", ["swap", "insert", "delete"])
def test_decontamination_recall_at_the_full_edit_budget(n, kind):
    rng, how, docs = random.Random(n), Decontamination(), []
    items = [[f"w{rng.randrange(3000)}" for _ in range(n)] for _ in range(30)]
    for item in items:
        w = list(item)
        for k in range(how.edits(n)):
            at = rng.randrange(len(w))
            w[at : at + (kind != "insert")] = [] if kind == "delete" else [f"new{k}"]
        docs.append(prose(rng, 40) + " " + " ".join(w) + " " + prose(rng, 40))
    machine = Items(list(range(30)), [" ".join(item) for item in items], how)
    found = machine.matches(Words(pa.array(docs), NOT_ALNUM, LOWER))
    assert sum((i, i) in found for i in range(30)) >= 29


def test_decontamination_finds_items_cut_off_at_a_text_s_ends(spark):
    rng, how = random.Random(8), Decontamination()
    items = [(i, prose(rng, n, 3000).replace(".", "")) for i, n in enumerate([10, 15, 20, 30, 40, 50, 120] * 6)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows, short = [], [(5000, None), (5001, ""), (5002, "one two")]
    for i, text in items:
        w, gone = text.split(), how.edits(len(text.split()))
        rows += [(i, " ".join(w[gone:]) + " " + prose(rng, 40)), (1000 + i, prose(rng, 40) + " " + " ".join(w[: len(w) - gone])),
                 (2000 + i, " ".join(w[gone:])), (3000 + i, " ".join(w[: len(w) - gone]))]
    # In one task, so texts stand beside each other and before the first there is nothing.
    found = contaminated(awkward_docs(spark, rows + short).coalesce(1), bench).collect()
    got = {(r["doc_id"], r["item_id"]): (r["distance"], r["start"]) for r in found}
    wanted = {(d, d % 1000) for d, _ in rows}
    assert len(wanted - got.keys()) <= 2 and got.keys() <= wanted  # target recall 0.99
    assert all(distance <= how.edits(len(items[i][1].split())) for (_, i), (distance, _) in got.items())
    assert {start for (d, _), (_, start) in got.items() if d < 1000 or d >= 2000} == {0}


def test_clean_drops_only_leaks(spark):
    rng = random.Random(6)
    item = prose(rng, 30)
    docs = awkward_docs(spark, awkward_rows() + [(300, "x " + item), (None, item + " y")])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(awkward_rows())
    assert clean(docs, bench.limit(0)).count() == docs.count() and clean(empty_docs(spark), bench).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_best_match_is_the_nearest_part(seed):
    rng = random.Random(seed)
    item = [rng.randrange(6) for _ in range(rng.randrange(1, 9))]
    text = [rng.randrange(6) for _ in range(rng.randrange(0, 14))]
    parts = [edit_distance(item, text[i:j]) for i in range(len(text) + 1) for j in range(i, len(text) + 1)]
    distance, start = best_match(np.array(item, np.uint64), np.array(text, np.uint64))
    assert distance == min(parts)
    assert min(edit_distance(item, text[start:j]) for j in range(start, len(text) + 1)) == distance
