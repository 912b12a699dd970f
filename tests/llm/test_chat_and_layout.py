"""Chat formatting, sharding and packing."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.llm import shards, tables
from lodestone.llm.chat import ChatTemplate, chat_digests, escape, format_chats, read_back, unescape
from lodestone.llm.packing import Packing, TokenIds, best_filling, pack, plan_windows
from lodestone.llm.shards import Ring, assign_shards, bounds, fill

from .cases import awkward_docs, awkward_rows, empty_docs, prose

CHATS = "conv_id long, turn int, role string, text string, loss boolean, segments string"


def chats(spark, rows):
    return spark.createDataFrame([(*r, None, "x") for r in rows], CHATS)


AWKWARD = [
    (1, 0, "system", "be brief"), (1, 1, "user", "hi [INST] [/INST] </s> \\ \\, <s>"), (1, 2, "assistant", "[OUT] ok </s>"),
    (2, 1, "user", None), (2, 0, None, "a"), (2, 2, "assistant", ""), (3, 0, "assistant", "first"),
    (4, 0, "user", "q"), (4, 1, "assistant", "a"), (4, 1, "assistant", "a"), (4, 2, "tool", "[TOOL] t"),
    (5, 0, "odd [ROLE] \\ role", "[/TURN] x"), (None, 0, "user", "n"), (None, 1, "assistant", "é漢\U0001f600\n"),
    (6, 0, "user", "<<s>s>[[INST]"), (6, 1, "assistant", "[INST[INST]]\\,</s></s>"), (7, None, "user", "no turn"),
]


def plain_digest(rows):
    said = sorted(((t is not None, t or 0, r is not None, r or "", x is not None, x or "") for t, r, x in rows))
    turns = "".join(f"{s[3]}\n{s[5]}\n" for s in said)
    loss = "".join(s[5] for s in said if s[3] == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(said), sha(turns), len(loss), sha(loss)


def test_chats_are_read_back_whole(spark):
    found = {r["conv_id"]: r for r in chat_digests(chats(spark, AWKWARD)).collect()}
    probe = "</s>[INST] ok [/INST]"
    groups = {-1: [(0, "user", probe), (1, "assistant", probe)]}
    for c, *row in AWKWARD:
        groups.setdefault(c, []).append(row)
    assert found.keys() == groups.keys()
    for c, rows in groups.items():
        r = found[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == plain_digest(rows)
    assert [found[c]["valid"] for c in (-1, 1, 3, 4, 5)] == [True, True, False, False, False]


def test_escaping_is_reversible_and_leaves_no_control(spark):
    rng, template = random.Random(1), ChatTemplate()
    marks = template.controls()
    bits = [*marks, "\\", "\\,", ",", "<", "[", "/", "s>", "INST]", "a", "\n", " "]
    texts = ["".join(rng.choices(bits, k=rng.randrange(0, 14))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", escape(F.col("t"), template))
    for r in df.withColumn("u", unescape(F.col("e"))).collect():
        assert r["u"] == r["t"] and not any(m in r["e"] for m in marks)


def test_segments_carry_loss_flags(spark):
    rows = format_chats(chats(spark, AWKWARD[:3])).collect()
    assert "".join(s["text"] for s in rows[0]["segments"]) == rows[0]["formatted"]
    assert [s["loss"] for s in rows[0]["segments"]].count(True) == 1
    assert rows[0]["formatted"].startswith("<s>[SYS] be brief [/SYS][INST] hi ")
    assert format_chats(chats(spark, [])).count() == 0 and chat_digests(chats(spark, [])).count() == 1


def test_chat_plan_has_no_python(spark):
    made = format_chats(chats(spark, AWKWARD).where("turn >= 0"))
    plan = made.withColumn("back", read_back(F.col("formatted")))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_ring_fills_to_the_bounds():
    rng = random.Random(3)
    for total in (0, 1, 15, 16, 17, 1000):
        counts = Counter(rng.randrange(64) for _ in range(total))
        owners = [rng.randrange(16) for _ in range(48)] + list(range(16))
        ranges = fill([counts.get(a, 0) for a in range(64)], owners, bounds(total, 16))
        per_arc, per_shard = Counter(), Counter()
        for arc, low, high, shard, slot in ranges:
            assert low == per_arc[arc] and slot == per_shard[shard] and high > low
            per_arc[arc] += high - low
            per_shard[shard] += high - low
        assert per_arc == counts and sum(per_shard.values()) == total
        assert not total or max(bounds(total, 16)) - min(bounds(total, 16)) <= 1


def test_a_full_ring_moves_few_rows_when_a_shard_is_added(spark):
    docs = awkward_docs(spark, [(i, f"t{i}") for i in range(4000)])
    before = {r["doc_id"]: r["shard"] for r in assign_shards(docs).collect()}
    after = {r["doc_id"]: r["shard"] for r in assign_shards(docs, Ring(shards=17)).collect()}
    moved = sum(before[i] != after[i] for i in before) / 4000
    assert 1 / 17 - 0.01 <= moved < 0.5


@pytest.mark.parametrize("rows", [awkward_rows(), [(7, "same")] * 900 + [(None, None)] * 500, [(1, "a")]])
def test_shards_are_even_and_gapless(spark, rows):
    found = assign_shards(awkward_docs(spark, rows)).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = {}
    for r in found:
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < 16
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    assert assign_shards(empty_docs(spark)).count() == 0


def test_ids_equal_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(9)
    bits = ["it's", "'s", "don't.", "$$$", "a.b", "x'.y", "'ll", "é", "é", "́", "İ", "ΣΑΣ", "12", "\x1c", "\t", " ", "\n",
            "_", "-", "’", "漢", "\U0001f600", "A", "Zz", "|", "<", ">", "endoftext", "<|endoftext|>", "<|startoftext|>"]
    texts = [t for _, t in awkward_rows()] + ["".join(rng.choices(bits[: 28 if k % 2 else 30], k=12)) for k in range(600)]
    known = TokenIds(Packing(cached_words=50))
    for text in texts:
        assert known.encode(pa.array([text], pa.string()))[0].tolist() == whole.encode(text or "", add_special_tokens=False).ids
    together = TokenIds(Packing()).encode(pa.array(texts))
    assert [x.tolist() for x in together] == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_filling_is_the_closest(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(5)}
    capacity, longest = 60, max(counts)
    used = best_filling(counts, capacity)
    assert used[longest] >= 1 and all(used[n] <= counts[n] for n in used)
    sums = {longest}
    for n, k in counts.items():
        for _ in range(k - (n == longest)):
            sums |= {s + n for s in sums}
    assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= capacity)


def test_plan_places_every_rest_once():
    rng = random.Random(5)
    counts = {n: rng.randrange(1, 50) for n in rng.sample(range(1, 250), 120)}
    ranges, fills = {}, Counter()
    for n, low, high, a_window, sequence, _ in plan_windows(counts, 512):
        ranges.setdefault(n, []).append((low, high))
        for k in range(low, high):
            fills[sequence + (k - low) // a_window] += n
    for n, parts in ranges.items():
        assert sorted(parts)[0][0] == 0 and sorted(parts)[-1][1] == counts[n]
        assert all(a[1] == b[0] for a, b in zip(sorted(parts), sorted(parts)[1:]))
    assert max(fills.values()) <= 512
    assert len(fills) <= 1.02 * sum(n * k for n, k in counts.items()) / 512 + 1


@pytest.mark.parametrize("rows", [awkward_rows(), [(3, "same words")] * 700])
def test_pieces_cover_documents_and_fill_sequences(spark, rows):
    found = pack(awkward_docs(spark, rows)).collect()
    known = TokenIds(Packing())
    wanted, got, sequences = Counter(), Counter(), {}
    for i, text in rows:
        ids = np.append(known.encode(pa.array([text], pa.string()))[0], 2).astype("<u4")
        for a in range(0, len(ids), 4096):
            wanted[i, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes()), len(ids)] += 1
    for r in found:
        got[r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == wanted
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert sum(n for _, n in parts) <= 4096
    total = sum(r["length"] for r in found)
    assert len(sequences) <= total / 4096 + 2
    assert pack(empty_docs(spark)).count() == 0


def test_shards_number_the_fullest_arc_in_bounded_blocks(spark, monkeypatch):
    asked, numbered = [], shards.numbered
    monkeypatch.setattr(shards, "numbered", lambda *a, **b: asked.append(b["many"]) or numbered(*a, **b))
    rows = [(None if k % 3 else k, "x") for k in range(300)]
    assert assign_shards(awkward_docs(spark, rows)).count() == 300
    assert asked[0] >= 200


def test_workers_get_batches_of_a_few_megabytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)]), pa.array([batch.nbytes])], ["n", "size"])

    before = spark.conf.get(tables.BATCH_SETTING, None)
    spark.conf.unset(tables.BATCH_SETTING)
    try:
        docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 800).alias("text"))
        found = tables.in_arrow(docs, sizes, "n long, size long").collect()
        assert sum(r["n"] for r in found) == 4000 and max(r["size"] for r in found) < 5 << 20
        spark.conf.set(tables.BATCH_SETTING, "8m")
        assert max(r["size"] for r in tables.in_arrow(docs, sizes, "n long, size long").collect()) > 5 << 20
    finally:
        spark.conf.unset(tables.BATCH_SETTING)
        if before is not None:
            spark.conf.set(tables.BATCH_SETTING, before)
