"""License scan by an exact set-similarity join of text blocks with templates.

A template's blocks are all runs of consecutive words of a text that are as long as the
template and a quarter more (its words / ``threshold``), whatever line breaks, blank
lines or comment marks stand between them. A template fits a block that holds at least
``threshold`` of its distinct words. Template words are ordered by how many texts of the
corpus hold them, rarest first; a block can only fit a template if it has one of the
first n - c + 1 words (prefix filter, c the words it needs), at least c places with any
of its words near that one (length filter) and enough of them left from the block's
start on (positional filter). What passes is counted exactly. Beside that, fixed phrases
are found anywhere in the text.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, alnum_table, lower_table, runs_of, slices, table, text_bytes, word_spans

# Phrases and their labels
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Well-known notices and their labels
TEMPLATES = [
    ("Licensed under the Apache License, Version 2.0", "apache"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation", "gpl"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met", "bsd"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa"),
    ("Licensed under CC BY 4.0", "cc-by"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
]
THRESHOLD = 0.8
MAX_TEMPLATES = 10_000    # templates travel with the tasks; a larger set is refused
LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str) -> list[str]:
    """Words of an ASCII phrase or template."""
    return "".join(c if c.isalnum() else " " for c in text.translate(LETTERS)).split()


def hashes_of(words: list[str]) -> np.ndarray:
    raw = "".join(words).encode()
    size = np.array([len(w.encode()) for w in words])
    end = np.cumsum(size)
    return Rolling(np.frombuffer(raw, np.uint8)).ranges(end - size, end) if words else np.zeros(0, np.uint64)


class Words:
    """All words of a batch of texts: bounds, text and hash."""

    def __init__(self, col: pa.Array, inside: np.ndarray, lower: np.ndarray):
        data, self.offsets = text_bytes(col)
        self.raw = lower[data]
        self.s, self.e, self.text = word_spans(self.raw, self.offsets, inside)
        self.hash = Rolling(self.raw).ranges(self.s, self.e) if len(self.s) else np.zeros(0, np.uint64)

    def known(self, sorted_hashes: np.ndarray) -> np.ndarray:
        """Places of the words whose hash is in a small sorted array."""
        if not len(sorted_hashes) or not len(self.hash):
            return np.zeros(0, np.int64)
        sieve = np.zeros(1 << 16, bool)
        sieve[sorted_hashes >> np.uint64(48)] = True
        at = np.flatnonzero(sieve[self.hash >> np.uint64(48)])
        return at[np.isin(self.hash[at], sorted_hashes)]

    def word(self, i: int) -> str:
        return self.raw[self.s[i]:self.e[i]].tobytes().decode()


def _text_counts(universe: list[str]):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, lower = alnum_table(), lower_table()
        hashes = np.sort(hashes_of(universe))
        total = np.zeros(len(hashes), np.int64)
        for b in slices(batches, "t"):
            w = Words(b.column(0), inside, lower)
            at = w.known(hashes)
            which = np.searchsorted(hashes, w.hash[at])
            pairs = np.unique(w.text[at].astype(np.int64) * len(hashes) + which)
            total += np.bincount(pairs % len(hashes), minlength=len(hashes))
        names = np.array(universe, object)[np.argsort(hashes_of(universe), kind="stable")]
        yield table(schema, names.tolist(), total)
    return run


def word_order(docs: DataFrame, templates: list[tuple[str, str]]) -> list[str]:
    """The templates' words, rarest in the corpus first (each counted once a text)."""
    universe = sorted({w for t, _ in templates for w in words_of(t)})
    if not universe:
        return []
    n = docs.select(F.col("text").cast("string").alias("t")).mapInArrow(_text_counts(universe), "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).collect()      # a row for each template word
    count = {r["word"]: r["n"] for r in n}
    return sorted(universe, key=lambda w: (count.get(w, 0), w))


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
                    ("score", pa.float64())])


def needed(distinct: int, threshold: float) -> int:
    """Distinct words that a block must have of a template with ``distinct`` ones."""
    return max(1, ceil(threshold * distinct - 1e-9))


def block_size(words: int, threshold: float) -> int:
    """Words of a block for a template of ``words`` words."""
    return ceil(words / threshold - 1e-9)


class Fit(NamedTuple):
    """A template in a block: its share and number of words, first and last word of the place."""

    share: float
    words: int
    start: int
    end: int
    template: int


def unbeaten(fits: list[Fit], rank, whole: bool) -> list[Fit]:
    """The fits that share no word (``whole``: not all words) with one of greater ``rank``, in the order of their starts."""
    fits = sorted(fits, key=lambda f: f.start)
    starts = [f.start for f in fits]
    ranks = [rank(f) for f in fits]
    reach = max((f.end - f.start for f in fits), default=0)
    return [f for i, f in enumerate(fits)
            if not any(ranks[j] > ranks[i] and fits[j].end >= (f.end if whole else f.start)
                       for j in range(bisect_left(starts, f.start - reach), bisect_right(starts, f.start if whole else f.end)))]


class Matcher:
    """Templates as sets in one word order, and the filters."""

    def __init__(self, order: list[str], templates: list[tuple[str, str]], threshold: float):
        rank = {w: i for i, w in enumerate(order)}
        self.rank = rank
        self.sets, self.labels, self.need, self.size = [], [], [], []
        self.by_prefix: dict[int, list[int]] = {}
        for text, label in templates:
            words = words_of(text)
            s = sorted({rank[w] for w in words})
            if not s:
                continue
            c = needed(len(s), threshold)
            for r in s[:len(s) - c + 1]:
                self.by_prefix.setdefault(r, []).append(len(self.sets))
            self.sets.append(frozenset(s))
            self.labels.append(label)
            self.need.append(c)
            self.size.append(block_size(len(words), threshold))

    def fits(self, at: list[int], ranks: list[int]) -> list[Fit]:
        """All blocks of a text that a template fits, each as its shortest part from the same start
        on with all the template's words it holds. ``at``, ``ranks``: the text's known words, in order."""
        near: dict[int, list[int]] = {}
        for p, r in zip(at, ranks):
            for t in self.by_prefix.get(r, ()):
                near.setdefault(t, []).append(p)
        out: list[Fit] = []
        for t, places in near.items():
            reach, i = self.size[t] - 1, 0
            while i < len(places):                     # places whose surroundings meet are searched at once
                first = last = places[i]
                while i < len(places) and places[i] - last <= 2 * reach:
                    last = places[i]
                    i += 1
                lo, hi = bisect_left(at, first - reach), bisect_right(at, last + reach)
                own = [k for k in range(lo, hi) if ranks[k] in self.sets[t]]
                if len(own) >= self.need[t]:
                    out += self._slide([at[k] for k in own], [ranks[k] for k in own], t)
        return out

    def _slide(self, at: list[int], ranks: list[int], t: int) -> Iterator[Fit]:
        inside: Counter = Counter()
        b = 0
        for a, start in enumerate(at):
            while b < len(at) and at[b] < start + self.size[t]:
                inside[ranks[b]] += 1
                b += 1
            if b - a >= self.need[t] and len(inside) >= self.need[t]:
                seen: set[int] = set()
                for k in range(a, b):
                    seen.add(ranks[k])
                    if len(seen) == len(inside):
                        yield Fit(len(seen) / len(self.sets[t]), len(self.sets[t]), start, at[k], t)
                        break
            inside[ranks[a]] -= 1
            if not inside[ranks[a]]:
                del inside[ranks[a]]

    def best(self, fits: list[Fit]) -> list[Fit]:
        """The fits that count: of one template's that share a word the largest share, then the
        shortest; of those of all templates, a fit inside another one's words needs as large a share
        and, at an equal one, as many words."""
        own: dict[int, list[Fit]] = {}
        for f in fits:
            own.setdefault(f.template, []).append(f)
        tight = [f for group in own.values() for f in unbeaten(group, lambda f: (f.share, f.start - f.end), False)]
        return unbeaten(tight, lambda f: (f.share, f.words), True)


def _scan(order: list[str], phrases: list[tuple[str, str]], templates: list[tuple[str, str]], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, lower = alnum_table(), lower_table()
        match = Matcher(order, templates, threshold)
        seeds = np.sort(hashes_of(sorted({order[r] for r in match.by_prefix})))
        universe = np.sort(hashes_of(order))
        fixed = [(p.split(), label) for p, label in phrases]
        lasts = np.sort(hashes_of(sorted({p[-1] for p, _ in fixed})))
        for b in slices(batches, "t"):
            w, n = Words(b.column(1), inside, lower), b.num_rows
            first: list = [None] * n
            last: list = [None] * n
            count = [0] * n
            base: list[set] = [set() for _ in range(n)]
            more: list[set] = [set() for _ in range(n)]
            score = [0.0] * n
            for i in w.known(lasts).tolist():          # base phrases end here
                for p, label in fixed:
                    k = i - len(p) + 1
                    t = int(w.text[i])
                    if k >= 0 and w.text[k] == t and all(w.word(k + j) == x for j, x in enumerate(p)):
                        count[t] += 1
                        at = k - int(np.searchsorted(w.text, t))
                        first[t] = at if first[t] is None else min(first[t], at)
                        last[t] = at if last[t] is None else max(last[t], at)
                        base[t].add(label)
                        score[t] = 1.0
            likely = np.unique(w.text[w.known(seeds)])
            at = w.known(universe)
            at = at[np.isin(w.text[at], likely)]
            cut, size = runs_of(w.text[at])
            for c, k in zip(cut.tolist(), size.tolist()):
                known = [(i, r) for i in at[c:c + k].tolist() if (r := match.rank.get(w.word(i))) is not None]
                t = int(w.text[at[c]])
                for f in match.best(match.fits([i for i, _ in known], [r for _, r in known])):
                    more[t].add(match.labels[f.template])
                    score[t] = max(score[t], f.share)
            yield table(RESULT, b.column(0), np.bincount(w.text, minlength=n), count, first, last,
                        [",".join(sorted(x)) for x in base], [",".join(sorted(x | y)) for x, y in zip(base, more)], score)
    return run


def license_scan(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES,
                 templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: doc_id, n_words, n_base (places of
    phrases), first_word, last_word (smallest and largest start, words from 0),
    base_labels, labels (with those of the templates that fit; where one's place lies in
    another's, of the one that fits better), score (1 with a phrase, else the largest share of a
    template that counts, else 0).

    Null text: no words. Repeated rows each give a row; other columns are ignored; no
    rows: empty. Phrases are at least one word each."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("t"))
    return src.mapInArrow(_scan(word_order(docs, templates), phrases, templates, threshold),
                          "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                          "labels string, score double")


def oracle() -> str:
    values = ",\n    ".join(
        f"({i}, '{label}', {needed(len(set(words_of(t))), THRESHOLD)}, {block_size(len(words_of(t)), THRESHOLD)}, "
        f"[{', '.join(repr(w) for w in sorted(set(words_of(t))))}])" for i, (t, label) in enumerate(TEMPLATES))
    phrases = ",\n    ".join(f"([{', '.join(repr(w) for w in p.split())}], '{label}')" for p, label in PHRASES)
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return f"""
WITH templates(t, label, need, size, words) AS (VALUES
    {values}),
phrases(p, label) AS (VALUES
    {phrases}),
d AS (SELECT row_number() OVER () AS r, doc_id, {low} AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, {word}) AS ws FROM d),
places AS (
  SELECT r, i - 1 AS pos, label FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM w), phrases
  WHERE ws[i:i + len(p) - 1] = p),
base AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS found
         FROM places GROUP BY r),
occ AS (
  SELECT r, t, p, word FROM (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w)
  JOIN (SELECT t, unnest(words) AS word FROM templates) USING (word)),
likely AS (SELECT r, t, any_value(need) AS need, any_value(size) AS size, any_value(label) AS label, any_value(len(words)) AS n
           FROM occ JOIN templates USING (t) GROUP BY r, t HAVING count(DISTINCT word) >= any_value(need)),
slid AS (
  SELECT r, t, p AS s, need, size, label, n, count(DISTINCT word) OVER (
    PARTITION BY r, t ORDER BY p RANGE BETWEEN CURRENT ROW AND size - 1 FOLLOWING) AS k FROM occ JOIN likely USING (r, t)),
fits AS (
  SELECT r, t, s, label, n, k / n::DOUBLE AS share, max(p) AS e FROM (
    SELECT f.r, f.t, f.s, f.label, f.n, f.k, o.word, min(o.p) AS p
    FROM slid f JOIN occ o ON o.r = f.r AND o.t = f.t AND o.p BETWEEN f.s AND f.s + f.size - 1
    WHERE f.k >= f.need GROUP BY f.r, f.t, f.s, f.label, f.n, f.k, o.word)
  GROUP BY r, t, s, label, n, k),
tight AS (
  SELECT * FROM fits a WHERE NOT EXISTS (
    SELECT 1 FROM fits b WHERE b.r = a.r AND b.t = a.t AND b.s <= a.e AND b.e >= a.s
      AND (b.share > a.share OR b.share = a.share AND b.e - b.s < a.e - a.s))),
best AS (
  SELECT r, list(DISTINCT label) AS found, max(share) AS share FROM tight a WHERE NOT EXISTS (
    SELECT 1 FROM tight b WHERE b.r = a.r AND b.s <= a.s AND b.e >= a.e
      AND (b.share > a.share OR b.share = a.share AND b.n > a.n)) GROUP BY r)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.found), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base.found, best.found))), ','), '') AS labels,
  CASE WHEN base.r IS NOT NULL THEN 1.0::DOUBLE ELSE coalesce(best.share, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN base ON base.r = w.r LEFT JOIN best ON best.r = w.r
"""
