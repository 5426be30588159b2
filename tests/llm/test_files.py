"""WARC archives, licence scans and HTML extraction, and the registered queries against their SQL."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.llm import host_paths, licenses, warc
from quern.llm.common import shared_folder
from quern.llm.queries import QUERIES
from tests.conftest import TESTDATA
from tests.oracle import connect, differences


def pages(spark, rows):
    schema = "page_id bigint, url string, html string, digest string, bytes int, host string"
    return spark.createDataFrame([(*r, "d", 1, "h") for r in rows], schema)


BIG = "x" * 150 + " é\r\n\r\nWARC/1.1 y"
PAGES = [
    (5, "http://www.b.example/q?x=1#f", BIG),
    (3, "http://a.example/", BIG),
    (9, None, BIG),
    (3, "http://a.example/", BIG),
    (None, "http://c.example/line\r\nend", BIG),
    (1, "http://b.example/q?x=1", "short"),
    (2, "http://b.example/q?x=1", "short"),
    (4, "http://b.example/", None),
    (6, "http://b.example/long", "long " * 60_000),
]


# ---- WARC


def test_archives_round_trip(spark):
    path = shared_folder(spark, "test-warc")
    warc.write_archives(pages(spark, PAGES), path, timestamp=F.timestamp_seconds(F.col("page_id")), records_per_archive=2)
    index = warc.read_archives(spark, path)
    got = sorted(((r["record"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in index.collect()), key=str)
    want = []
    for key, _, html in PAGES:
        body = (html or "").encode()
        revisit = html == BIG and key != 3
        want.append((key, "revisit" if revisit else "response", 3 if revisit else None, len(body), hashlib.sha256(body).hexdigest()))
    assert got == sorted(want, key=str)
    assert index.where("not digest_matches").count() == 0
    back = sorted(((r["record"], r["payload"]) for r in warc.payloads(spark, path).collect()), key=str)
    assert back == sorted(((k, h or "") for k, _, h in PAGES), key=str)
    # Offsets and lengths point at whole records.
    for r in index.collect():
        with open(r["archive"].removeprefix("file:"), "rb") as archive:
            archive.seek(r["offset"])
            record = archive.read(r["length"] + 4)
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: ") and record.endswith(b"\r\n\r\n")
    merged = warc.merge_index(index).orderBy("position").collect()
    keys = [(r["url_key"], r["timestamp"], r["record"] is not None, r["record"] or 0) for r in merged]
    assert keys == sorted(keys) and len(keys) == len(PAGES)


def test_archives_are_bounded_by_bytes(spark):
    path = shared_folder(spark, "test-warc")
    rows = [(i, f"http://a.example/{i}", str(i) * (n // len(str(i)))) for i, n in enumerate([300] * 50 + [3000] * 30 + [20_000] * 7 + [90_000] * 2)]
    bound = 1 << 18  # classes: up to 64 bytes, 2 KB, 64 KB and beyond
    warc.write_archives(pages(spark, rows).coalesce(1), path, archive_bytes=bound)
    index = warc.read_archives(spark, path)
    archives = index.groupBy("archive").agg(F.count("*").alias("n"), F.sum("payload_bytes").alias("bytes")).collect()
    assert all(a["n"] == 1 or a["bytes"] <= bound for a in archives) and sum(a["n"] == 1 for a in archives) >= 2
    assert sorted((r["record"], r["payload_bytes"]) for r in index.collect()) == [(i, len(t)) for i, _, t in rows]
    assert {r["record"]: r["payload"] for r in warc.payloads(spark, path).collect()} == {i: t for i, _, t in rows}


def test_ranges_follow_each_other_at_any_number(spark):
    path = shared_folder(spark, "test-warc")
    hot = [(i, "http://hot.example/", f"page {i}") for i in range(60)] + [(100 + i, f"http://b.example/{i % 7}", f"{i}") for i in range(40)]
    warc.write_archives(pages(spark, hot), path, timestamp=F.timestamp_seconds(F.col("page_id") % 3), records_per_archive=9)
    merged = warc.merge_index(warc.read_archives(spark, path), batch=4, range_rows=5).orderBy("position").collect()
    keys = [(r["url_key"], r["timestamp"], r["record"]) for r in merged]
    assert keys == sorted(keys) and len(set(keys)) == 100


def test_archives_of_nothing(spark):
    assert warc.archived(spark, pages(spark, [])).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree(k):
    rng = random.Random(k)
    rows = [(f"u{rng.randrange(5)}", str(rng.randrange(3)), rng.choice([None, 1, 2, 3]), i) for i in range(40 * (k > 0))]
    runs = [sorted(rows[i::k], key=warc._order) for i in range(k)]
    runs = [*runs[:1], [], *runs[1:]] if k > 2 else runs
    merged = list(warc.LoserTree([iter(r) for r in runs]))
    assert [warc._order(r) for r in merged] == sorted(map(warc._order, rows)) and sorted(r[3] for r in merged) == list(range(len(rows)))


def test_url_keys():
    assert warc.url_key("https://user@WWW2.Example.co.uk:80/A?b#c") == "uk,co,example)/a?b"
    assert warc.url_key("") == ")/"


# ---- licences


def test_licence_inheritance(spark):
    mit, apache = "Released under the MIT License.", "# Licensed under the Apache License, Version 2.0."
    rows = [
        (1, "p/LICENSE", mit),
        (2, "p/a/x.txt", "no words on rights"),
        (3, "p/a/LICENSE.md", "something else\n" + apache),
        (4, "p/a/b/c/y.txt", None),
        (5, "p/z.txt", "text\n" + apache + "\nmore"),
        (6, "q/w.txt", "plain"),
        (7, None, mit),
        (8, None, "plain"),
        (9, "top.txt", ""),
        (10, "p/a/b/c/y.txt", None),
        (11, "q/v.txt", "license " + "word " * 5000),
    ]
    files = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, path string, text string, license string, of string")
    got = {r["doc_id"]: (r["license"], r["origin"], r["licensed_by"]) for r in licenses.scan(files).collect()}
    assert got == {
        1: ("MIT", "file", None),
        2: ("Apache-2.0", "inherited", "p/a"),
        3: ("Apache-2.0", "file", None),
        4: ("Apache-2.0", "inherited", "p/a"),
        5: ("Apache-2.0", "header", None),
        6: (None, None, None),
        7: ("MIT", "header", None),
        8: (None, None, None),
        9: (None, None, None),
        10: ("Apache-2.0", "inherited", "p/a"),
        11: (None, None, None),
    }
    assert licenses.scan(files.limit(0)).count() == 0


def test_anchors_lose_no_unit():
    """No unit without an anchor can reach the threshold, since what a template has besides them is too short."""
    weights = licenses.Weights(licenses.TEMPLATES)
    anchors = set(weights.anchors(licenses.THRESHOLD))
    for vector in weights.vectors:
        assert sum(w * w for term, w in vector.items() if term not in anchors) < licenses.THRESHOLD**2


BSD3 = """BSD 3-Clause License

Copyright (c) 2020, Some Body

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def brute_scores(text):
    """Per unit that reaches the threshold: the best name and score, by plain comparison with every template."""
    weights, found = licenses.Weights(licenses.TEMPLATES), set()
    for unit in dict.fromkeys(text.split("\n") + re.split(r"\n[ \t\r]*\n", text)):
        n = Counter(re.findall(licenses.TERM, unit.lower()))
        vector = {t: k * weights.idf.get(t, weights.outside) for t, k in n.items()}
        norm = math.sqrt(sum(w * w for w in vector.values())) or 1
        scores = [
            (-round(sum(w * v.get(t, 0) for t, w in vector.items()) / norm, 6), name)
            for name, v in zip(weights.names, weights.vectors, strict=True)
        ]
        if -min(scores)[0] >= licenses.THRESHOLD:
            found.add((min(scores)[1], -min(scores)[0]))
    return found


def test_units_are_found_and_counted_once(spark):
    """By a pattern that finds the same words as a list of them does, and by counts that no condition repeats."""
    anchors = licenses.Weights(licenses.TEMPLATES).anchors(licenses.THRESHOLD)
    around = r"(?i)(?<![a-z0-9]){}(?![a-z])"
    listed = re.compile(around.format("(?:" + "|".join(map(re.escape, anchors)) + ")"))
    tree, dice = licenses._any_of(anchors), random.Random(5)
    assert "|".join(map(re.escape, anchors)) not in tree and licenses._any_of([]) == "(?!)"
    tree = re.compile(around.format(tree))
    found = 0
    for _ in range(20_000):
        word = dice.choice(anchors)
        text = dice.choice(["", "x", "1", " ", "("]) + word[: dice.randint(1, len(word))] + dice.choice(["", "s", "r", ".0", "9", "-"])
        text = text.upper() if dice.random() < 0.3 else text
        found += bool(listed.search(text))
        assert bool(tree.search(text)) == bool(listed.search(text)), text
    assert 1000 < found < 19_000
    files = spark.createDataFrame([("a", "Released under the MIT License.")], "path string, text string")
    plan = licenses.unit_licenses(files)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("filter(runs") == 2


def test_licence_file_of_bsd_is_found(spark):
    """Function words count in the vectors: without them no unit of the usual file reaches the threshold."""
    rows = [(1, "p/LICENSE", BSD3), (2, "p/x.txt", "plain")]
    files = spark.createDataFrame(rows, "doc_id bigint, path string, text string")
    assert {r["doc_id"]: r["license"] for r in licenses.scan(files).collect()} == {1: "BSD-3-Clause", 2: "BSD-3-Clause"}


def gnu(kind, version, what="program", later=True):
    ends = f"either version {version} of the License, or\n * (at your option) any later version."
    return (
        f"/*\n * This {what} is free software; you can redistribute it and/or modify\n * it under the terms of the GNU {kind}"
        f"General Public License as published by\n * the Free Software Foundation; {ends}\n */\n\nint main;"
    )


CREATIVE = "This work is licensed under a Creative Commons {} 4.0 International License."
DISCLAIMED = BSD3.partition("3. Neither")[0].partition("Copyright")[2]


@pytest.mark.parametrize(
    "text,name",
    [
        (gnu("", "2"), "GPL-2.0"),
        (gnu("", "3"), "GPL-3.0"),
        (gnu("Lesser ", "2.1", "library"), "LGPL-2.1"),
        (gnu("Lesser ", "3", "library"), "LGPL-3.0"),
        (gnu("Affero ", "3"), "AGPL-3.0"),
        (CREATIVE.format("Attribution"), "CC-BY-4.0"),
        (CREATIVE.format("Attribution-NonCommercial"), "CC-BY-NC-4.0"),
        (CREATIVE.format("Attribution-ShareAlike"), "CC-BY-SA-4.0"),
        (CREATIVE.format("Attribution-NoDerivatives"), "CC-BY-ND-4.0"),
        (CREATIVE.format("Attribution-NonCommercial-ShareAlike"), "CC-BY-NC-SA-4.0"),
        (CREATIVE.format("Attribution-NonCommercial-NoDerivatives"), "CC-BY-NC-ND-4.0"),
        ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright", "GPL-2.0"),
        ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright", "GPL-3.0"),
        ("  GNU LESSER GENERAL PUBLIC LICENSE\n   Version 2.1, February 1999\n\n Copyright", "LGPL-2.1"),
        ("   Apache License\n  Version 2.0, January 2004\n  http://www.apache.org/licenses/\n\n  TERMS", "Apache-2.0"),
        (BSD3, "BSD-3-Clause"),
        (BSD3.partition("Copyright")[2], "BSD-3-Clause"),
        (BSD3.partition("3. Neither")[0].replace("3-Clause", "2-Clause"), "BSD-2-Clause"),
        (DISCLAIMED, "BSD-2-Clause"),
        (BSD3.partition("Copyright")[2].replace("\n\n", "\n"), "BSD-3-Clause"),
        (
            "MIT License\n\nCopyright (c) 2020 X\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
            'of this software and associated documentation files (the "Software"), to deal',
            "MIT",
        ),
        ("// SPDX-License-Identifier: MIT\nint x;", "MIT"),
        ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
        ("/* SPDX-License-Identifier: GPL-2.0-only */", "GPL-2.0"),
        ("/* SPDX-License-Identifier: LGPL-2.1-or-later */", "LGPL-2.1"),
        ("# SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
        ("# SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"),
        ("# SPDX-License-Identifier: Artistic", None),
        ("mit", None),
        ("mit der mit", None),
    ],
)
def test_usual_notices_get_their_own_name(text, name):
    found = brute_scores(text)
    assert (max(found, key=lambda f: f[1])[0] if found else None) == name


def test_unit_scores_are_those_of_plain_comparison(spark):
    rng = random.Random(3)
    common = [t for t in licenses.Weights(licenses.TEMPLATES).idf if t in licenses.FUNCTION_WORDS]
    texts = [BSD3, "the of and the the of to or", "", "\n\n", "MIT mit", "... ---"]
    for _, template in licenses.TEMPLATES:
        texts += [template, template.replace(" ", "\n * "), template + " und mehr Wörter hier"]
        words = template.split() + rng.choices(common, k=12) + [f"w{i}" for i in range(rng.randrange(6))]
        texts.append(" ".join(rng.sample(words, len(words))))
    # The same path twice: units of two rows are not added up.
    rows = [(str(i), t) for i, t in enumerate(texts)] + [("0", "Released under"), ("0", "the MIT License.")]
    got = {}
    for r in licenses.unit_licenses(spark.createDataFrame(rows, "path string, text string")).collect():
        got.setdefault(r["place"], set()).add((r["name"], round(r["score"], 5)))
    want = {}
    for place, text in rows:
        want.setdefault(place, set()).update((name, round(score, 5)) for name, score in brute_scores(text))
    assert got == {k: v for k, v in want.items() if v}


# ---- HTML


ARTICLE = "<h1>T &amp; U</h1><p>Hello <b>world</b>, this\n is\tthe text.<p>Second &eacute; &#8364;<br>line<ul><li>one<li>two</ul>"
WANT = "T & U\nHello world, this is the text.\nSecond é € line\none\ntwo"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body><nav><a>m</a></nav><article>{ARTICLE}</article><footer>f</footer></body></html>",
        f"<body><header>h<div>x</div></header><div class='main-content'>{ARTICLE}<aside>s</aside></div><div id=sidebar>side",
        f"<div class=menu>m</div><article>{ARTICLE}<section class='comments'><p>I think</section></article>",
        f"<article><script>if (a<b) '<p>'</script>{ARTICLE}<form><p>q<input></form><style>p{{}}</style><!-- <p>no</p> --></article>",
        f"<div class='cookie-notice'>We</div><article><p class=\"ad\">Buy <i>now</i>{ARTICLE}<div hidden>x</div></article>",
        f"<ARTICLE CLASS='Post 7'>{ARTICLE}<div style='display: none'>x</div><span class='share'>s</span></ARTICLE>",
    ],
)
def test_extraction(page):
    assert host_paths.extract(host_paths.parse(page), None) == WANT


LONG = "".join(f"<p>Sentence number {i} of the article goes on for some while here.</p>" for i in range(12))
LONG_TEXT = "\n".join(f"Sentence number {i} of the article goes on for some while here." for i in range(12))


@pytest.mark.parametrize(
    "name",
    ["site-content has-sidebar", "content no-sidebar", "elementor-widget-text-editor", "elementor-widget-container", "entry no-comments", "wrapper with-sidebar", "widget"],
)
def test_wrappers_named_like_boilerplate_keep_their_article(name):
    page = f"<html><body><nav>menu</nav><div class='{name}'>{LONG}</div><div class='sidebar widget'><p>side</p></div><div class=comments><p>I</p></div></body></html>"
    assert host_paths.extract(host_paths.parse(page), None) == LONG_TEXT


def test_boilerplate_inside_such_wrappers_still_goes():
    inside = f"<div class='widget box'><div class='sidebar box'><p>no</p></div>{LONG}<div class=comments>{LONG}{LONG}</div></div>"
    assert host_paths.extract(host_paths.parse(f"<body>{inside}<div class=ad>buy</div></body>"), None) == LONG_TEXT
    assert host_paths.extract(host_paths.parse("<body>" + "<div class=sidebar>" * 2000 + LONG), None) == LONG_TEXT


def test_parts_around_the_best_container_belong_to_it():
    lead = f"<body><main><h1>Title</h1><p>Lead.</p><div class=body>{LONG}</div></main><div class=promo>x</div></body>"
    assert host_paths.extract(host_paths.parse(lead), None) == "Title\nLead.\n" + LONG_TEXT
    parts = f"<body><div id=all><div class=one>{LONG}</div><div class=two>{LONG[:400]}</p></div><div class=three>{LONG[:300]}</p></div></div></body>"
    whole = host_paths.extract(host_paths.parse(parts), None)
    assert whole.startswith(LONG_TEXT) and whole.count("Sentence number 0") == 3
    # A short article stays one beside a longer advert.
    short = f"<body><div class=ad>{LONG}</div><div class=sidebar>{LONG}</div><article><p>Short.</p></article></body>"
    assert host_paths.extract(host_paths.parse(short), None) == "Short."
    # Links beside a container, and what lies directly in the body, are no parts of it.
    links = f"<body><div><div class=text>{LONG}</div><div><a>{'more ' * 60}</a></div></div><div>site</div></body>"
    assert host_paths.extract(host_paths.parse(links), None) == LONG_TEXT
    assert host_paths.extract(host_paths.parse("<article><p>Let <math><mi>x</mi><mo>+</mo><mn>1</mn></math> be.</p></article>"), None) == "Let x+1 be."


def test_extraction_of_odd_pages(spark):
    rows = [(1, "http://h/1", None), (2, None, ""), (3, "http://h/3", "just text < 3 &lt;"), (4, "http://h/4", "<div>" * 3000 + "deep"),
            (5, "http://h/5", "<p>" + "long text " * 50_000), (5, "http://h/5", "<a <b <"), (None, "x", "<body><p>one</p><script>no")]
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in host_paths.main_text(pages(spark, rows)).collect()]
    assert got[0] == (1, "", 0) and got[1] == (2, "", 0) and got[2] == (3, "just text < 3 <", 15)
    assert got[3][1] == "deep" and got[4][2] == 499_999 and got[6][1] == "one"
    assert host_paths.main_text(pages(spark, [])).count() == 0


def test_hosts_agree_on_a_path(spark):
    """A page whose advert-like box holds more text still gives the container its host's pages agree on."""
    usual = "<body><div class='c1'><p>{}</p></div><div class='extra'><p>{}</p></div></body>"
    rows = [(i, f"http://site.example:80/{i}", usual.format("main " * 50, "x")) for i in range(9)]
    rows += [(50, "http://site.example/50", usual.format("short", "other " * 90)), (60, "http://else.example/", "<div class=z><p>alone</div>")]
    got = {r["page_id"]: r["text"] for r in host_paths.main_text(pages(spark, rows)).collect()}
    assert got[50] == "short" and got[60] == "alone"
    paths = {r["host"]: r["path"] for r in host_paths.winning_paths(pages(spark, rows)).collect()}
    assert paths == {"site.example": ">body>div.c#", "else.example": ">div.z"}


# ---- registered queries


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_query_equals_sql(spark, name):
    query, sql = QUERIES[name]
    assert differences(spark, connect(TESTDATA), TESTDATA, query, sql) == []


@pytest.mark.parametrize("name,table", [("op3_main_text", "pages"), ("op7_fingerprints", "documents"), ("op8_language", "documents"), ("op4_pieces", "documents")])
def test_other_queries_give_every_row(spark, name, table):
    query, _ = QUERIES[name]
    assert query(spark, TESTDATA).count() == spark.read.parquet(f"{TESTDATA}/{table}.parquet").count()
