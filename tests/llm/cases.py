"""Small tables with awkward rows, and plain versions of the operators' definitions."""

import random
import re

WORD = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return re.findall(WORD, text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" + "." * (rng.random() < 0.1) for _ in range(n))


def awkward_rows():
    """(doc_id, text) with nulls, blanks, repeats, ties, copies and a very long text."""
    rng = random.Random(7)
    passage, base = prose(rng, 40), prose(rng, 120)
    edited = base.split()
    edited[5], edited[60] = "other", "words"
    rows = [
        (0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "One two"), (5, base), (6, base.upper().lower()),
        (7, " ".join(edited)), (8, prose(rng, 60) + " " + passage), (9, passage + "\n" + prose(rng, 50)),
        (10, passage + " " + passage), (11, "é ü ñ " * 30), (12, "漢字 仮名 " * 30), (13, "a b ́ c"),
        (14, prose(rng, 30_000)), (15, "x" * 300_000), (16, "same same same " * 40), (16, "same same same " * 40),
        (None, base), (None, None), (18, "<|endoftext|> [INST] \\ </s>"), (19, prose(rng, 25)),
    ]
    return rows + [(100 + i, prose(rng, rng.randrange(1, 200))) for i in range(40)]


def awkward_docs(spark, rows=None):
    """The rows with further columns, some of them named as the operators name theirs."""
    rows = awkward_rows() if rows is None else rows
    full = [(i, t, "en", None, len(t or ""), 1, "s", 0.5, True) for i, t in rows]
    return spark.createDataFrame(
        full, "doc_id long, text string, lang string, source string, n_chars long, size int, code string, "
        "score double, kept boolean")


def empty_docs(spark):
    return awkward_docs(spark, [])


def jaccard_groups(rows, shingle=3, percent=85):
    """{doc_id: (set size, smallest id reachable)} by comparing every pair; ids must differ."""
    sets = {}
    for i, text in rows:
        w = words(lower(text or ""))
        runs = [tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)] if len(w) >= shingle else [tuple(w)] * bool(w)
        sets[i] = set(runs)
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in sets}


def kept_words(rows, window=20):
    """{doc_id: (words, words that no later window covers)} by scanning all windows in order."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        gone = set()
        for k in range(len(w) - window + 1):
            run = tuple(w[k : k + window])
            if run in seen:
                gone.update(range(k, k + window))
            seen.add(run)
        out[i] = (w, [x for k, x in enumerate(w) if k not in gone])
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]
