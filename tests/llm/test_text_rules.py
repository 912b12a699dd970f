"""Quality rules, licence scan and the shared word helpers against plain versions."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lodestone.llm.licenses import TEMPLATES, LicenseScan, automaton, scan_licenses
from lodestone.llm.quality_rules import QualityRules, passing, quality_rules, run_entropy
from lodestone.llm.words import LOWER, Remembered, Words, expand, slices

from .cases import awkward_docs, awkward_rows, empty_docs, lower, prose, words


def test_words_are_found_and_told_apart():
    texts = [t for _, t in awkward_rows()] + ["ab", "ba", "a b", "b a"]
    found = Words(pa.array(texts), fold=LOWER)
    plain = [w for t in texts for w in words(lower(t or ""))]
    assert [found.word(i).decode() for i in range(len(found))] == plain
    assert len(np.unique(found.hash)) == len(set(plain))
    assert found.counts().tolist() == [len(words(t)) for t in texts]


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 50, 3)] + [None]})
    assert [len(part) for part in slices(batch, most=10)] == [2, 1, 2]


def test_remembered_words_survive_a_full_table():
    table = Remembered(lambda ws: ([len(w) for w in ws], [ord(c) for w in ws for c in w], 0), most=3)
    for text in ("ab c ab d", "e f g h ab", "c c x"):
        found = Words(pa.array([text]))
        rows = table.rows(found)
        chars = table.flat[expand(rows, table.first, table.n)].tolist()
        assert "".join(map(chr, chars)) == text.replace(" ", "")


def plain_rules(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    spots = {}
    for k in range(len(w) - 7):
        spots.setdefault(tuple(w[k : k + 8]), []).append(k)
    covered = {k + i for at in spots.values() if len(at) > 1 for k in at for i in range(8)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)),
            "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(covered), "base_failed": len(w) < 20 or 100 * len(covered) > 30 * len(w)}


def test_quality_rules_equal_the_plain_counts(spark):
    rows = awkward_rows() + [(200, "a #b\n|c|\na #b\n\n \na #b\r\nx" * 3), (201, "one two three four five six seven eight " * 9)]
    found = quality_rules(awkward_docs(spark, rows)).collect()
    assert len(found) == len(rows)
    key = lambda i: (i is None, i or 0)
    wanted = sorted(((i, plain_rules(t)) for i, t in rows), key=lambda x: (key(x[0]), x[1]["n_words"]))
    for row, (i, plain) in zip(sorted(found, key=lambda r: (key(r["doc_id"]), r["n_words"])), wanted):
        assert row["doc_id"] == i and {k: row[k] for k in plain} == plain
        assert not (row["base_failed"] and row["kept"])


def test_quality_rules_measure_tokens(spark):
    clean = "The committee will meet again next week to discuss the new budget and the plans for the old library. " * 2
    junk = " ".join(f"{c}$$$" for c in prose(random.Random(1), 80).split())
    rows = {r["doc_id"]: r for r in quality_rules(awkward_docs(spark, [(1, clean), (2, junk), (3, "ʬʭ\U0001f9ff " * 90)])).collect()}
    assert rows[1]["chars_per_token"] > 3 > rows[2]["chars_per_token"] and rows[1]["byte_share"] == 0
    assert rows[3]["byte_share"] > 0.5 and not rows[2]["kept"]
    assert 0 < rows[1]["token_entropy"] <= 1


CLEAN = {
    "english": "the committee will meet again next week to discuss new budget and plans for old library near river bank",
    "french": "le comité se réunit encore demain pour parler du nouveau budget et des projets de la vieille bibliothèque près",
    "russian": "комитет снова соберётся на следующей неделе чтобы обсудить новый бюджет и планы старой библиотеки возле реки города",
    "chinese": "委员会 下周 再次 开会 讨论 新的 预算 以及 旧 图书馆 的 计划 城市 河边 人们 学习 历史 文化 音乐 艺术",
    "lao": "ສະບາຍດີ ປະເທດ ລາວ ພາສາ ເມືອງ ນ້ຳ ຄົນ ກິນ ເຂົ້າ ໂຮງຮຽນ ຄູ ນັກຮຽນ ປຶ້ມ ຕະຫຼາດ ເຮືອນ ມື້ນີ້ ດີ ຫຼາຍ ວັດ ພູເຂົາ",
    "gujarati": "આજે શાળામાં બાળકો નવું પુસ્તક વાંચે છે અને શિક્ષક તેમને ઇતિહાસ વિશે સરળ ભાષામાં સમજાવે ગામ નદી પાસે આવેલું મોટું બજાર",
    "amharic": "ሰላም ዛሬ ልጆች በትምህርት ቤት አዲስ መጽሐፍ ያነባሉ መምህሩ ስለ ታሪክ ይነግራቸዋል ከተማ ወንዝ አጠገብ ትልቅ ገበያ አለ ሰዎች ቡና ይጠጣሉ",
    "burmese": "မြန်မာ နိုင်ငံ ကျောင်း ဆရာ ကလေး စာအုပ် ဖတ် မြစ် ဈေး အိမ် ထမင်း စား ရေ သောက် မြို့ လူ တောင် ယနေ့ ကောင်း သည်",
}


@pytest.mark.parametrize("name", CLEAN)
def test_a_longer_clean_text_keeps_its_verdict(spark, name):
    rng, vocabulary = random.Random(9), CLEAN[name].split()
    rows = [(n, " ".join(rng.choices(vocabulary, k=40 * n))) for n in (1, 10, 100)]
    found = {r["doc_id"]: r for r in quality_rules(awkward_docs(spark, rows)).collect()}
    assert all(r["n_tokens"] >= 40 and r["kept"] for r in found.values())
    assert abs(found[1]["token_entropy"] - found[100]["token_entropy"]) < 0.05


def test_runs_cover_the_whole_text():
    rng = np.random.default_rng(5)
    for n in (1, 2, 39, 40, 41, 80, 999):
        ids = rng.integers(0, 9, n).astype(np.int32)
        size = min(40, n)
        parts = [ids[a : a + size] for a in [*range(0, n - size, size), n - size]]
        shares = [np.unique(p, return_counts=True)[1] / size for p in parts]
        assert run_entropy(ids, 40) == pytest.approx(np.mean([-(p * np.log2(p)).sum() for p in shares]))


def test_passing_keeps_rows_whole(spark):
    docs = awkward_docs(spark)
    kept = passing(docs)
    assert kept.schema == docs.schema
    good = {r["doc_id"] for r in quality_rules(docs).where("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == good
    assert passing(empty_docs(spark)).count() == 0 and quality_rules(empty_docs(spark)).count() == 0
    assert QualityRules().bands["latin"].byte_share < 1


PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]


def plain_scan(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    spots = [(k, label) for p, label in PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    starts = [k for k, _ in spots]
    return (len(w), len(spots), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in spots})))


def test_license_base_equals_a_plain_scan(spark):
    rng = random.Random(2)
    vocabulary = "under the mit license apache version 2 cc by nc other".split()
    rows = awkward_rows() + [(500 + i, " ".join(rng.choices(vocabulary, k=60))) for i in range(60)]
    rows += [(900, "Under The MIT-License; CC-BY-NC 4.0 (apache license, version 2.0)")]
    found = scan_licenses(awkward_docs(spark, rows)).collect()
    plain = sorted(((i is None, i or 0), *plain_scan(t)) for i, t in rows if plain_scan(t)[1])
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_words"], r["n_base"], r["first_word"], r["last_word"],
                  r["base_labels"]) for r in found if r["n_base"])
    assert got == plain and len(found) == len(rows)
    for r in found:
        assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
    assert scan_licenses(empty_docs(spark)).count() == 0


def test_license_templates_are_covered(spark):
    rng = random.Random(3)
    rows = []
    for k, (text, _) in enumerate(TEMPLATES):
        cut = text.split()
        cut[len(cut) // 2] = "zebra"
        rows.append((k, prose(rng, 30) + " " + " ".join(cut) + " " + prose(rng, 30)))
    found = {r["doc_id"]: r for r in scan_licenses(awkward_docs(spark, rows)).collect()}
    for k, (text, label) in enumerate(TEMPLATES):
        spans = [s for s in found[k]["spans"] if s["label"] == label]
        assert label in found[k]["labels"].split(",")
        assert spans[0]["first"] == 30 + 0 and spans[0]["last"] - spans[0]["first"] + 1 >= 0.6 * len(text.split())


@pytest.mark.parametrize("seed", range(5))
def test_matching_statistics_equal_brute_force(seed):
    rng = random.Random(seed)
    machine = automaton(LicenseScan())
    held = {tuple(t[i:j]) for t in machine.texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    text = [w for _ in range(30) for t in [rng.choice(machine.texts)] for i in [rng.randrange(len(t))] for w in t[i : i + rng.randrange(1, 9)]]
    for at, _, length in machine.walk(text):
        longest = max((n for n in range(1, at + 2) if tuple(text[at + 1 - n : at + 1]) in held), default=0)
        assert length == longest
