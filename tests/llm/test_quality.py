import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from canvass.llm import quality
from canvass.llm.common import documents

from .helpers import edge_docs, no_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def normal(line):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), re.sub("[0-9]", "0", line))
    return " ".join(WORD.findall(t))


def brute(rows, limits=quality.Limits()):
    lines = Counter()
    for source, text in {(r.source, r.text or "") if r.text is not None else (r.source, None) for r in rows}:
        for x in {normal(x) for x in (text or "").split("\n")} - {""}:
            lines[source, x] += 1
    out = []
    for r in rows:
        text = r.text or ""
        w = WORD.findall(text)
        windows, seen, dup = defaultdict(list), set(), 0
        for i in range(len(w) - 7):
            windows[tuple(w[i:i + 8])].append(i)
        marked = {j for v in windows.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
        for x in text.split("\n"):
            if WORD.search(x):
                dup += x in seen
                seen.add(x)
        gone = sum(len(WORD.findall(x)) for x in text.split("\n") if normal(x)
                   and lines[r.source, normal(x)] > limits.line_docs)
        failed = len(w) < limits.min_words or 100 * len(marked) > limits.repeat_pct * len(w)
        left = len(w) - gone
        kept = not failed and left >= limits.min_words and 100 * left >= limits.left_pct * len(w)
        out.append((r.doc_id, len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(marked), gone,
                    failed, kept))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    got = sorted(map(tuple, quality.quality_rules(docs).collect()), key=str)
    assert got == brute(docs.collect())


def test_frequent_lines_and_edge_cases(spark):
    rows = [(100 + i, f"Common line number {i % 10} of many words here\nown line {'abcdefghijkl'[i % 12]} " + f"w{i}x " * 3
             + " ".join(f"u{i}q{j}z" for j in range(25 if i % 2 else 2)), "en", "a" if i % 3 else None, 1) for i in range(60)]
    docs = edge_docs(spark).union(edge_docs(spark, rows))
    got = quality.quality_rules(docs).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs.collect())
    assert any(r.n_removed_words for r in got) and any(r.n_removed_words and r.kept for r in got)
    kept = quality.apply_quality_rules(docs)
    assert kept.columns == docs.columns
    texts = kept.collect()
    assert Counter(r.doc_id for r in texts) == Counter(r.doc_id for r in got if r.kept)
    assert not any("Common line" in r.text for r in texts) and all(r.n_chars == len(r.text) for r in texts)


def letters(*numbers):
    """A word of its own (digits count as one in lines)."""
    return "".join(chr(97 + int(d)) for n in numbers for d in f"{n:05d}")


def test_a_line_counts_alike_in_small_and_large_hosts(spark):
    """A passage that 12 documents share goes from all 12, whatever else their host holds."""
    rows = [(h * 10_000 + i, (f"The passage that twelve documents share {h}\n" if i < 12 else "")
             + " ".join(letters(h, i, j) for j in range(25)), "en", f"host{h}", 1) for h, n in ((1, 60), (2, 1300)) for i in range(n)]
    got = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    found = got.where("n_removed_words = 7").groupBy((F.col("doc_id") / 10_000).cast("int").alias("h")).count().collect()
    assert {r.h: r["count"] for r in found} == {1: 12, 2: 12} and got.where("not kept").count() == 0


def test_no_rows(spark):
    assert quality.quality_rules(no_docs(spark)).count() == 0
    assert quality.apply_quality_rules(no_docs(spark)).count() == 0
