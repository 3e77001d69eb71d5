import random
from collections import defaultdict

from canvass.llm import line_dedup
from canvass.llm.common import documents

from .helpers import components_of, edge_docs, no_docs


def brute(rows, similarity=0.8):
    lines = sorted({(r.doc_id is None, r.doc_id or 0, r.text or "", i, x) for r in rows
                    for i, x in enumerate(line_dedup.normal_lines(r.text)) if x})
    sets = {x: {x[i:i + 6] for i in range(max(1, len(x) - 5))} for *_, x in lines}

    def alike(a, b):
        a, b = sets[a], sets[b]
        if min(len(a), len(b)) < similarity * max(len(a), len(b)):
            return False
        n = len(a & b)
        return n >= similarity * (len(a) + len(b) - n)

    part = components_of(sets, alike)
    seen, gone = set(), defaultdict(list)
    for none, i, t, no, x in lines:
        if part[x] in seen:
            gone[None if none else i, t].append(no)
        seen.add(part[x])
    return gone


def test_equals_brute_force(spark):
    docs = documents(spark, "/root/testdata/sf0.001").limit(80)
    rows = docs.collect()
    docs = spark.createDataFrame(rows, docs.schema)
    want = {k[0]: v for k, v in brute(rows).items()}
    got = {r.doc_id: r.removed for r in line_dedup.line_dedup(docs).collect()}
    lost = sum(len(set(v) - set(got[k])) for k, v in want.items())
    assert lost <= 0.02 * sum(map(len, want.values()))
    assert all(set(v) <= set(want.get(k, ())) for k, v in got.items())


def test_near_copies_and_text(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(300)]
    line = " ".join(rng.choices(words, k=60))
    near = [line.replace(" ", "  ").upper() if i == 1 else line[:10 * i] + "zq" + line[10 * i:] for i in range(1, 30)]
    rows = [(0, line + "\nfirst own line", "en", "a", 1)] + [(i, f"own line of {words[i]}{i * 7919}\n{x}", "en", "a", 1)
                                                          for i, x in enumerate(near, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in line_dedup.remove_duplicate_lines(docs).collect()}
    assert got[0].text == rows[0][1] and got[0].n_chars == 1
    assert all(got[i].text == rows[i][1].split("\n")[0] and got[i].n_chars == len(got[i].text) for i in range(1, 30))


def test_recall_of_the_bands():
    rng = random.Random(5)
    found = total = 0
    lines = []
    for _ in range(200):
        a = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=240))
        cuts = sorted(rng.sample(range(240), 3))
        b = "".join(a[i:j] + "#" for i, j in zip([0, *cuts], [*cuts, 240]))
        lines += [a, b]
    bands = line_dedup.band_values(lines)
    for i in range(0, len(lines), 2):
        a, b = line_dedup.shingles(lines[i]), line_dedup.shingles(lines[i + 1])
        if len(a & b) >= 0.8 * len(a | b):
            total += 1
            found += bool((bands[i] == bands[i + 1]).any())
    assert total > 100 and found >= 0.97 * total


def test_edge_cases(spark):
    docs = edge_docs(spark)
    want = brute(docs.collect())
    rows = line_dedup.line_dedup(docs).collect()
    assert len(rows) == docs.count()
    assert sorted((str(r.doc_id), r.n_removed) for r in rows) == \
        sorted((str(r.doc_id), len(want.get((r.doc_id, r.text or ""), ()))) for r in docs.collect())
    assert {(r.doc_id, r.n_lines) for r in rows} >= {(1, 0), (2, 1), (3, 3), (10, 3001)}
    out = line_dedup.remove_duplicate_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_no_rows(spark):
    assert line_dedup.line_dedup(no_docs(spark)).count() == 0
    assert line_dedup.remove_duplicate_lines(no_docs(spark)).count() == 0


def test_large_buckets_in_blocks(spark, monkeypatch):
    """Buckets of more lines than a block give the same links' components as one task."""
    import random

    rng = random.Random(3)
    lines = [f"posted by user {rng.randint(0, 999999):06d} on the old forum of the town, reply {i % 3} of three to the first topic"
             for i in range(60)]
    lines += [f"an other line with {''.join(rng.choices('abcdefgh', k=9))} words, chain {'xyz' * (i % 9)} of them" for i in range(60)]
    for i in range(40):                                  # neighbours alike, ends not
        lines.append(" ".join(f"w{j}q" for j in range(i, i + 30)))
    lines = sorted(set(lines))
    keys = [line_dedup.line_key(x) for x in lines]
    frame = spark.createDataFrame([(b, k, x) for b in (1, 2) for k, x in zip(keys, lines) if b == 1 or k[0] % 3], "bucket long, key binary, line string")

    def roots(links):
        up = {k: k for k in keys}

        def top(k):
            while up[k] != k:
                k = up[k]
            return k
        for a, b in links:
            up[top(bytes(a))] = top(bytes(b))
        groups = {}
        for k in keys:
            groups.setdefault(top(k), set()).add(k)
        return sorted(map(sorted, groups.values()))

    sets = line_dedup.shingle_hashes(lines)
    want = roots(line_dedup.link_lines(keys, sets))
    assert any(len(g) > 20 for g in want) and len(want) > 3
    for block in (1, 5, 30):
        monkeypatch.setattr(line_dedup, "BLOCK", block)
        assert roots(map(tuple, line_dedup._large_links(frame).collect())) == want


def test_no_task_holds_a_large_bucket(spark, monkeypatch):
    docs = documents(spark, "/root/testdata/sf0.001").limit(60)
    docs = docs.union(spark.createDataFrame([(9000 + i, f"posted by user {i:06d} on the old forum of the town, reply to the first topic",
                                              "en", "a", 1) for i in range(90)], docs.schema))
    want = sorted(map(str, line_dedup.line_dedup(docs).collect()))
    seen = []
    large = line_dedup._large_links
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    monkeypatch.setattr(line_dedup, "_large_links", lambda lines: seen.append(1) or large(lines))
    assert sorted(map(str, line_dedup.line_dedup(docs).collect())) == want and seen


def test_heavy_buckets_of_long_lines(spark, monkeypatch):
    """A bucket of few but long lines is cut into blocks too, with the same result."""
    rng = random.Random(8)
    long = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(400))
    rows = [(i, f"{long[:40 * i]} {i * 7919} {long[40 * i:]}\nown line {i * 104729} of one", "en", "a", 1) for i in range(40)]
    rows += [(100 + i, "a short line that comes again and again\n" + "z" * i, "en", "a", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = sorted(map(str, line_dedup.line_dedup(docs).collect()))
    seen = []
    large = line_dedup._large_links
    monkeypatch.setattr(line_dedup, "HEAVY_CHARS", 20_000)
    monkeypatch.setattr(line_dedup, "BLOCK_CHARS", 10_000)
    monkeypatch.setattr(line_dedup, "_large_links", lambda lines: seen.append(lines.count()) or large(lines))
    got = line_dedup.line_dedup(docs)
    assert sorted(map(str, got.collect())) == want and seen
    assert sum(r.n_removed for r in got.collect()) >= 39
