"""Quality rules, with cross-document line frequency.

Every text is read once, as arrays, into its base counts and the hashes of its
normalised lines (A-Z lower-cased, digits as 0, white space runs as one space).
A host's lines that too many of its distinct documents have are removed, and a
document that keeps too little is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, lower_table, mix, powers, row_key, runs_of, shared_table, slices, space_table, table, \
    text_bytes, unused, word_spans

# The symbols counted by n_symbols
SYMBOLS = "#*$%&|<>"
WINDOW = 8
SALT = 0xD6E8FEB86659FD93


@dataclass(frozen=True)
class Limits:
    """A document fails the base rules with under ``min_words`` words or more than
    ``repeat_pct`` % of them in repeated windows. A line is above the limit if more
    than ``line_docs`` of its host's distinct documents have it, however many
    documents the host has. A document is depleted if under ``min_words`` words or under
    ``left_pct`` % of them stand in lines that stay."""

    min_words: int = 20
    repeat_pct: int = 30
    line_docs: int = 10
    left_pct: int = 30


def normal_table() -> np.ndarray:
    t = lower_table()
    t[0x30:0x3A] = 0x30
    return t


class LineHashes:
    """The lines of a batch of texts that hold a word: text number, number of words
    and hash of the normalised words in order."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, normal: np.ndarray):
        self.s, self.e, self.doc = word_spans(data, offsets, inside)
        starts = np.union1d(offsets[:-1], np.flatnonzero(data == 10) + 1)
        line = np.searchsorted(starts, self.s, side="right") - 1
        self.first, self.words = runs_of(line)
        self.text = self.doc[self.first]
        self.begin = starts[line[self.first]]
        w = Rolling(normal[data]).ranges(self.s, self.e) if len(self.s) else np.zeros(0, np.uint64)
        sums = np.zeros(len(w) + 1, np.uint64)
        np.cumsum(w * powers(len(w), SALT)[:-1], out=sums[1:])
        last = self.first + self.words
        self.hash = mix((sums[last] - sums[self.first]) * powers(len(w), pow(SALT, -1, 1 << 64))[self.first])


FEATURES = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), ("key", pa.binary()), ("n_words", pa.int64()),
                      ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
                      ("n_repeat_words", pa.int64()), ("line_hash", pa.list_(pa.int64())),
                      ("line_words", pa.list_(pa.int32()))])
FEATURES_DDL = ("doc_id long, host string, key binary, n_words long, word_chars long, n_symbols long, "
                "n_dup_lines long, n_repeat_words long, line_hash array<long>, line_words array<int>")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside, normal = space_table(), normal_table()
    symbol, whole = np.zeros(256, bool), np.ones(256, bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    whole[0x80:0xC0] = False                        # continuation bytes: one count for each code point

    def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])

    for b in slices(batches, "t"):
        data, offsets = text_bytes(b.column(3))
        n = b.num_rows
        lines = LineHashes(data, offsets, inside, normal)
        s, e, doc = lines.s, lines.e, lines.doc
        raw = Rolling(data)
        n_words = np.bincount(doc, minlength=n)
        # raw lines that equal an earlier one of their text
        ends = np.append(np.flatnonzero(data == 10), len(data))
        stop = np.minimum(ends[np.searchsorted(ends, lines.begin)], offsets[lines.text + 1])
        same = raw.ranges(lines.begin, stop) + lines.text.astype(np.uint64) * np.uint64(SALT)
        dup = np.ones(len(same), bool)
        dup[np.unique(same, return_index=True)[1]] = False
        # words in windows that occur twice or more
        rep = np.zeros(n, np.int64)
        if len(s) > WINDOW:
            w = raw.ranges(s, e)
            k = len(w) - WINDOW + 1
            h = np.zeros(k, np.uint64)
            for j in range(WINDOW):
                h = h * np.uint64(SALT) + w[j:j + k]
            at = np.flatnonzero(doc[:k] == doc[WINDOW - 1:])
            h = mix(h[at] + mix(doc[at].astype(np.uint64) + np.uint64(1)))
            order = np.argsort(h, kind="stable")
            first, size = runs_of(h[order])
            hits = at[order[np.repeat(size > 1, size)]]
            if len(hits):
                step = np.zeros(len(w) + 1, np.int64)
                np.add.at(step, hits, 1)
                np.add.at(step, hits + WINDOW, -1)
                rep = np.bincount(doc[np.cumsum(step[:-1]) > 0], minlength=n)
        # each text's distinct normalised lines, with the words in all their places
        by = np.lexsort((lines.hash, lines.text))
        lh, lt, lw = lines.hash[by], lines.text[by], lines.words[by]
        new = np.flatnonzero(np.concatenate([[True], (lh[1:] != lh[:-1]) | (lt[1:] != lt[:-1])])) if len(lh) else by
        words = np.add.reduceat(lw, new) if len(lh) else lw
        cuts = np.searchsorted(lt[new], np.arange(n + 1)).astype(np.int32)
        yield table(FEATURES, b.column(0), b.column(1), b.column(2), n_words,
                    per_text(inside[data] & whole[data], offsets), per_text(symbol[data], offsets),
                    np.bincount(lines.text[dup], minlength=n), rep,
                    pa.ListArray.from_arrays(cuts, pa.array(lh[new].view(np.int64))),
                    pa.ListArray.from_arrays(cuts, pa.array(words.astype(np.int32))))


def features(docs: DataFrame) -> DataFrame:
    """Base counts and line hashes of every row; ``key`` stands for (source, text)."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                      F.col("text").cast("string").alias("text"))
    return src.select("doc_id", F.col("source").alias("host"), row_key("source", "text").alias("key"),
                      F.col("text").alias("t")).mapInArrow(_features, FEATURES_DDL)


def frequent_lines(texts: DataFrame, limits: Limits) -> DataFrame:
    """(key, h, words) for the lines above the limits. ``texts`` has a row for each
    distinct (host, text). Counts are pre-aggregated on the map side, so a hot
    host or line is a row for each task; the join back is split by Spark where it
    is skewed."""
    lines = texts.select("key", "host", F.explode(F.arrays_zip("line_hash", "line_words")).alias("l")) \
        .select("key", "host", F.col("l.line_hash").alias("h"), F.col("l.line_words").alias("words"))
    often = lines.groupBy("host", "h").agg(F.count("*").alias("n")).where(F.col("n") > limits.line_docs) \
        .select(F.col("host").alias("host2"), F.col("h").alias("h2"))
    return lines.join(often, lines["host"].eqNullSafe(often["host2"]) & (lines["h"] == often["h2"])) \
        .select("key", "h", "words")


def _judged(docs: DataFrame, limits: Limits) -> DataFrame:
    feats = shared_table(features(docs))
    texts = feats.groupBy("key").agg(*(F.first(c).alias(c) for c in ("host", "line_hash", "line_words")))
    gone = frequent_lines(texts, limits)
    lost = gone.groupBy("key").agg(F.sum("words").alias("n_removed_words"), F.collect_list("h").alias("gone"))
    left = F.col("n_words") - F.col("n_removed_words")
    return (feats.drop("line_hash", "line_words").join(lost, "key", "left")
              .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))
              .withColumn("base_failed", (F.col("n_words") < limits.min_words)
                          | (100 * F.col("n_repeat_words") > limits.repeat_pct * F.col("n_words")))
              .withColumn("kept", ~F.col("base_failed") & (left >= limits.min_words)
                          & (100 * left >= limits.left_pct * F.col("n_words"))))


def quality_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source, ...)``: doc_id, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words (words in
    lines above the limits), base_failed, kept.

    Null text: no words, so base_failed. Null source: a host of its own. Rows equal
    in source and text count as one document for the line counts and get equal
    verdicts. Other columns are ignored. No rows: empty."""
    judged = _judged(docs, limits)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "n_removed_words", "base_failed", "kept")


def _cut_lines(text_at: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, normal = space_table(), normal_table()
        for b in slices(batches, schema.names[text_at]):
            data, offsets = text_bytes(b.column(text_at))
            lines = LineHashes(data, offsets, inside, normal)
            gone = b.column(b.num_columns - 1).to_pylist()
            texts = b.column(text_at).to_pylist()
            at = np.searchsorted(lines.text, np.arange(b.num_rows + 1))
            raw, new = data.tobytes(), []
            for i, (t, g) in enumerate(zip(texts, gone)):
                if not g:
                    new.append(t)
                    continue
                bad, kept, pos = set(g), [], int(offsets[i])
                for j in range(at[i], at[i + 1]):
                    if int(lines.hash[j].view(np.int64)) in bad:
                        kept.append(raw[pos:lines.begin[j]])
                        nl = raw.find(b"\n", lines.begin[j], offsets[i + 1])
                        pos = nl + 1 if nl >= 0 else int(offsets[i + 1])
                kept.append(raw[pos:offsets[i + 1]])
                out = b"".join(kept)
                new.append((out[:-1] if pos == offsets[i + 1] and out.endswith(b"\n") else out).decode())
            yield table(schema, *(pa.array(new, schema.field(j).type) if j == text_at else b.column(j)
                                  for j in range(len(schema))))
    return run


def apply_quality_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` without the rejected rows, and without the lines above the limits in
    the others (a text's last line loses the line break before it). Columns as in
    ``docs``; ``n_chars`` follows the text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    judged = _judged(docs, limits)
    key, gone = unused(docs, "_key"), unused(docs, "_gone")
    verdict = judged.where("kept").groupBy(F.col("key").alias(key)).agg(F.first("gone").alias(gone))
    kept = docs.withColumn(key, row_key("source", "text")).join(verdict, key).select(*docs.columns, gone)
    schema = to_arrow_schema(docs.schema)
    out = kept.mapInArrow(_cut_lines(docs.columns.index("text"), schema), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text AS raw, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
lines AS (SELECT r, source, raw, unnest(string_split(text, chr(10))) AS line FROM d),
worded AS (
  SELECT *, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'),
                               '[^\x20\x09-\x0D]+') AS ws FROM lines),
normal AS (SELECT *, array_to_string(ws, ' ') AS form FROM worded WHERE len(ws) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM normal GROUP BY r),
places AS (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i:i + 7]) AS n FROM places),
repeats AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM windows WHERE n > 1) GROUP BY r),
often AS (
  SELECT source, form FROM (SELECT DISTINCT source, raw, form FROM normal) GROUP BY source, form HAVING count(*) > 10),
gone AS (
  SELECT r, sum(len(ws))::BIGINT AS n FROM normal l JOIN often o ON l.source IS NOT DISTINCT FROM o.source AND l.form = o.form GROUP BY r),
base AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
         coalesce(gone.n, 0)::BIGINT AS n_removed_words
  FROM w LEFT JOIN dup ON w.r = dup.r LEFT JOIN repeats ON w.r = repeats.r LEFT JOIN gone ON w.r = gone.r),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND n_words - n_removed_words >= 20 AND 100 * (n_words - n_removed_words) >= 30 * n_words AS kept
FROM judged
"""
