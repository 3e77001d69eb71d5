import re
import textwrap

import duckdb

from canvass.llm import license_scan
from canvass.llm.common import documents

from .helpers import edge_docs, no_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def overlap(a, b):
    return a[2] <= b[3] and b[2] <= a[3]


def fitting(w, threshold):
    """(share, words, first, last, label, template) of every block, straight from the definition."""
    fits = []
    for t, (text, label) in enumerate(license_scan.TEMPLATES):
        words = license_scan.words_of(text)
        own, size = set(words), len(words)
        while size * threshold < len(words) - 1e-9:
            size += 1
        if len(own & set(w)) < threshold * len(own) - 1e-9:
            continue
        for s in range(len(w)):
            both = own & set(w[s:s + size])
            if w[s] in own and len(both) >= threshold * len(own) - 1e-9:
                e = next(e for e in range(s, s + size) if both <= set(w[s:e + 1]))
                fits.append((len(both) / len(own), len(own), s, e, label, t))
    tight = [a for a in fits if not any(a[5] == b[5] and overlap(a, b) and (b[0], b[2] - b[3]) > (a[0], a[2] - a[3]) for b in fits)]
    return [a for a in tight if not any(b[2] <= a[2] and a[3] <= b[3] and b[:2] > a[:2] for b in tight)]


def brute(rows, threshold=0.8):
    out = []
    for r in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")
        w = WORD.findall(text)
        places = sorted((i, label) for p, label in license_scan.PHRASES for i in range(len(w))
                        if w[i:i + len(p.split())] == p.split())
        labels, score = {x for _, x in places}, 1.0 if places else 0.0
        for f in fitting(w, threshold):
            labels.add(f[4])
            score = max(score, f[0])
        out.append((r.doc_id, len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None,
                    ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), score))
    return sorted(out, key=str)


BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
       "following conditions are met")
WRAPPED = textwrap.fill("Some prose first, under the heading of forms. " + BSD + ": and more prose that goes on and on.", 40)
SCATTERED = " and ".join(f"{x} filler{i} words here stand between" for i, x in enumerate(license_scan.words_of(BSD)))
NOTICES = ["licensed under the apache license", "This work is licensed under the GNU General Public Licence version 3 or later.",
           "Licensed under CC BY-SA 4.0", "licensed under cc by 4.0, see there", "GENERAL PUBLIC LICENSE mit-license MIT\nLicense",
           "Redistribution and use in source and binary forms, with modification, are permitted provided the following conditions are met",
           "apache license " * 200, WRAPPED, "\n *\n * ".join(textwrap.wrap(BSD, 30)), SCATTERED, WRAPPED.replace("\n", "\n\n# "),
           "Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0", "Licensed under CC BY-SA 4.0\nLicensed under CC BY 4.0",
           "licensed by licensed under cc\nby 4.0 0 4 by cc under licensed", "licensed under cc by 4.0 " * 60,
           "This Source Code Form is\nsubject to the terms of\nthe Mozilla Public License,\nv. 2.0. Licensed under CC BY 4.0",
           "Permission is hereby granted,\nfree of charge, to any\nperson obtaining a copy\nof this software and associated files",
           "free and unencumbered software released into the public domain, this", "public license general"]


def test_equals_brute_force_and_sql(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    docs = docs.union(spark.createDataFrame([(10_000 + i, t, "en", "a", 1) for i, t in enumerate(NOTICES)], docs.schema))
    rows = docs.collect()
    got = sorted(map(tuple, license_scan.license_scan(docs).collect()), key=str)
    assert got == brute(rows)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert sorted(con.sql(license_scan.oracle()).fetchall(), key=str) == got


def test_edge_cases_and_no_rows(spark):
    docs = edge_docs(spark)
    assert sorted(map(tuple, license_scan.license_scan(docs).collect()), key=str) == brute(docs.collect())
    assert license_scan.license_scan(no_docs(spark)).count() == 0
    none = license_scan.license_scan(docs, phrases=[], templates=[]).collect()
    assert len(none) == docs.count() and all(r.labels == "" and r.score == 0 for r in none)


def test_line_breaks_do_not_matter(spark):
    texts = {1: WRAPPED, 2: " ".join(WRAPPED.split()), 3: WRAPPED.replace("\n", "\n\n// "), 4: SCATTERED,
             5: "x " * 30_000 + WRAPPED + " y" * 30_000, 6: "Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.license_scan(docs).collect()}
    assert got == {1: ("bsd", 1.0), 2: ("bsd", 1.0), 3: ("bsd", 1.0), 4: ("", 0.0), 5: ("bsd", 1.0), 6: ("cc-by,cc-by-sa", 1.0)}
