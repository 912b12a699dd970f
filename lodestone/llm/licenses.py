"""Licence scans with a generalised suffix automaton of licence words.

The automaton holds every run of words of all templates. A text is streamed through it: at
each word it tells the longest run ending there that some template holds (the matching
statistic). Maximal long runs are chained, in the order of both text and template, into
spans that cover a template, and a span that covers enough of it gives its label. Short
phrases, the base, must stand in full; the automaton's states know which of them end there.

Words that no template holds reset the automaton, so only stretches of template words are
walked. Null and empty texts have no words, no labels and score 0; rows are judged one by one.
"""

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import in_arrow
from .words import LOWER, NOT_ALNUM, Words, slices, strings

# The base phrases and their labels.
PHRASES = (
    ("under the MIT License", "mit"),
    ("Apache License Version 2", "apache-2"),
    ("CC BY NC", "cc-by-nc"),
)

# Opening passages of public licence notices and their labels.
TEMPLATES = (
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the Software), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
     "copies of the Software", "mit"),
    ("Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at", "apache-2"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met: Redistributions of source code must retain the above copyright "
     "notice, this list of conditions and the following disclaimer", "bsd"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation", "gpl"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation", "lgpl"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
     "was not distributed with this file, You can obtain one at", "mpl-2"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
     "isc"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
     "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
     "publish, use, compile, sell, or distribute this software", "unlicense"),
)


@dataclass(frozen=True)
class LicenseScan:
    """A run counts from ``least_run`` words on; chained runs lie at most ``most_gap`` words
    apart; a template is found when ``least_cover`` of its words are covered."""

    phrases: tuple = PHRASES
    templates: tuple = TEMPLATES
    least_run: int = 4
    most_gap: int = 12
    least_cover: float = 0.6


@lru_cache(4)
def automaton(scan: LicenseScan) -> "SuffixAutomaton":
    return SuffixAutomaton(scan)


class SuffixAutomaton:
    """Suffix automaton of all phrases and templates, over numbered words."""

    def __init__(self, scan: LicenseScan):
        texts = [text for text, _ in (*scan.phrases, *scan.templates)]
        words = Words(pa.array(texts), NOT_ALNUM, LOWER)
        self.vocabulary = np.unique(words.hash)
        coded = np.searchsorted(self.vocabulary, words.hash).tolist()
        self.texts = [coded[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        self.next, self.link, self.length = [{}], [-1], [0]
        for text in self.texts:
            last = 0
            for word in text:
                last = self._extend(last, word)
        self._ends(len(scan.phrases))

    def _new(self, length, link, edges):
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state, word, length):
        """The state after ``word`` whose longest run is ``length``, made apart if need be."""
        target = self.next[state][word]
        if self.length[target] == length:
            return target
        twin = self._new(length, self.link[target], dict(self.next[target]))
        self.link[target] = twin
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = twin
            state = self.link[state]
        return twin

    def _extend(self, last, word):
        if word in self.next[last]:
            return self._split(last, word, self.length[last] + 1)
        state = self._new(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, word, self.length[last] + 1)
        return state

    def _ends(self, n_phrases):
        """For each state: phrases (index, length) that end there, and where in which template."""
        self.phrases = [[] for _ in self.next]
        self.places = [{} for _ in self.next]
        for k, text in enumerate(self.texts):
            state = 0
            for at, word in enumerate(text):
                state = self.next[state][word]
                if k >= n_phrases:
                    up = state
                    while up > 0:
                        self.places[up].setdefault(k - n_phrases, at + 1)
                        up = self.link[up]
            if k < n_phrases:
                self.phrases[state].append((k, len(text)))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.phrases[state] = self.phrases[state] + self.phrases[self.link[state]]

    def walk(self, run):
        """(position, state, length) at each word of a run of vocabulary words."""
        state = length = 0
        for at, word in enumerate(run):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(word, 0)
            length = length + 1 if state else 0
            yield at, state, length


def maximal_runs(steps, least: int):
    """(end, state, length) of the runs that the next word does not prolong."""
    last = None
    for step in steps:
        if last and last[2] >= least and step[2] <= last[2]:
            yield last
        last = step
    if last and last[2] >= least:
        yield last


def chains(runs, scan: LicenseScan, sizes: list):
    """Best covered span (start, end, share) of each template.

    ``runs`` are (start, end, {template: end there}), by end. A run joins the best chain that
    ends shortly before it in the text and before it in the template.
    """
    best, recent = {}, {}
    for start, end, places in runs:
        for k, stop in places.items():
            begin = stop - (end - start)
            waiting = recent.setdefault(k, [])
            waiting[:] = [c for c in waiting if c[1] + scan.most_gap >= start]
            joined = (end - start, start)
            for covered, c_end, c_stop, c_start in waiting:
                shared = max(0, c_end - start, c_stop - begin)
                if c_end < end and c_stop < stop and covered + end - start - shared > joined[0]:
                    joined = (covered + end - start - shared, c_start)
            waiting.append((joined[0], end, stop, joined[1]))
            share = joined[0] / sizes[k]
            if share > best.get(k, (0, 0, 0.0))[2]:
                best[k] = (joined[1], end, share)
    return best


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, spans array<struct<label: string, first: long, last: long, cover: double>>")


def scan_text(codes: np.ndarray, known: np.ndarray, machine: SuffixAutomaton, scan: LicenseScan):
    """(places of base phrases, best spans of templates) of one text's word numbers."""
    least = min(len(t) for t in machine.texts)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], known.astype(np.int8), [0]])))
    base, runs = [], []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if b - a < min(least, scan.least_run):
            continue
        steps = list(machine.walk(codes[a:b].tolist()))
        for at, state, length in steps:
            for k, n in machine.phrases[state]:
                if length >= n:
                    base.append((a + at - n + 1, k))
        for at, state, length in maximal_runs(steps, scan.least_run):
            runs.append((a + at - length + 1, a + at + 1, machine.places[state]))
    sizes = [len(t) for t in machine.texts[len(scan.phrases):]]
    return base, chains(runs, scan, sizes)


def _scanned(batches, scan: LicenseScan):
    machine = automaton(scan)
    vocabulary, names = machine.vocabulary, [label for _, label in scan.phrases]
    for batch in batches:
        for part in slices(batch):
            words = Words(strings(part.column("text")), NOT_ALNUM, LOWER)
            codes = np.searchsorted(vocabulary, words.hash)
            codes[codes == len(vocabulary)] = 0
            known = vocabulary[codes] == words.hash
            out = []
            for k in range(words.n):
                a, b = words.first[k], words.first[k + 1]
                base, best = scan_text(codes[a:b], known[a:b], machine, scan)
                spans = [{"label": scan.templates[t][1], "first": s, "last": e - 1, "cover": c}
                         for t, (s, e, c) in sorted(best.items()) if c >= scan.least_cover]
                labels = {names[i] for _, i in base}
                score = 1.0 if base else max((c for _, _, c in best.values()), default=0.0)
                starts = [s for s, _ in base]
                out.append((int(b - a), len(base), min(starts, default=None), max(starts, default=None),
                            ",".join(sorted(labels)), ",".join(sorted(labels | {s["label"] for s in spans})),
                            min(1.0, float(score)), spans))
            span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                                       ("cover", pa.float64())]))
            types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), span]
            yield pa.RecordBatch.from_arrays(
                [strings(part.column("doc_id")).cast(pa.int64()),
                 *[pa.array(list(x), t) for x, t in zip(zip(*out), types)]],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])


def scan_licenses(docs: DataFrame, scan: LicenseScan | None = None) -> DataFrame:
    """One row per document: base places and labels, all labels, score and covered spans."""
    scan = scan or LicenseScan()
    return in_arrow(docs.select("doc_id", "text"), lambda batches: _scanned(batches, scan), SCHEMA)
