import hashlib
import random
import re
import textwrap
import time
from html import unescape

import numpy as np
import pytest

from starlane.llm import licences, neighbours, warc, wrappers
from starlane.sources.scratch import scratch_folder
from messy_tables import PAGES, documents, no_documents, words


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "h", "d", "p") for r in rows], PAGES)


def test_archives_round_trip(spark, tmp_path):
    long = "<p>" + words(20_000, 1) + "</p>é"
    rows = [(1, "http://a/x y", long), (2, "http://a/2", long), (3, None, None), (4, "http://b", ""), (5, "http://b", "x" * 999),
            (6, "http://b", "x" * 999), (7, "http://b", "y" * 1000), (8, "http://b", "y" * 1000), (8, "http://b", "y" * 1000),
            (None, "http://c", "y" * 1000), (None, None, "z")]
    got = warc.round_trip(pages(spark, rows).coalesce(1), str(tmp_path / "w")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["payload"] is not None:
            assert hashlib.sha1(bytes(r["payload"])).hexdigest() == r["payload_digest"] and len(r["payload"]) == r["payload_bytes"]
    found = {(r["page_id"], r["payload_bytes"]): (r["record_type"], r["refers_to"]) for r in got}
    assert found[1, len(long.encode())] == ("revisit", 2) and found[2, len(long.encode())] == ("response", None)
    assert found[5, 999] == found[6, 999] == ("response", None)
    assert found[7, 1000] == ("revisit", 8) and found[8, 1000] == ("response", None)
    assert found[None, 1000] == ("revisit", 8) and found[None, 1] == ("response", None) and found[3, 0] == ("response", None)
    assert warc.round_trip(pages(spark, []), str(tmp_path / "none")).count() == 0


def test_segments_are_checked(spark, tmp_path):
    index = warc.write_archives(pages(spark, [(1, "u", words(9000, 2))]), str(tmp_path / "w"))
    segments = warc.read_segments(index, str(tmp_path / "w"))
    assert segments.count() > 3 and segments.select("origin").distinct().count() == 1
    for broken in (segments.where("segment <> 2"), segments.where("total is null"), segments.withColumn("total", segments["total"] + 1)):
        with pytest.raises(Exception, match="segments of page 1"):
            warc.payloads(warc.reassembled(broken)).collect()


def test_chunked_framing():
    body = bytes(range(256)) * 40
    assert warc.unchunked(warc.chunked(body, 1000)) == body and warc.unchunked(b"3;x=1\r\nabc\r\n0\r\nT: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"3\r\nabcd\r\n0\r\n\r\n")


def page(title, body, n, wrap='<article>{}</article>'):
    return (
        f'<html><head><title>{title}</title><style>p{{}}</style><script>var a="</p>";</script></head><body><nav><a href="/{n}">menu {n}</a></nav>'
        f'<div class="cookie-notice">We use {n} cookies</div><div id="sidebar">{words(40, n)}</div>'
        + wrap.format(f"<h1>{title}</h1>{body}")
        + f'<div class="comments"><p>{words(90, n + 1)}</p></div><form><p>Join {n}</p></form><footer>&copy; {n}</footer></body></html>'
    )


def test_main_text_of_a_host(spark):
    soup = '<div class="post-7"><div class="share-bar">Share</div><span class="tag">Read more</span>{}</div>'
    rows, want = [], {}
    for i in range(12):
        body = f"<p>{words(50, i)} &amp; <b>b</b>old<br>x</p><p>same line</p>"
        rows += [(i, "http://a.example/x", page(f"T{i}", body, i)), (100 + i, "https://b.example/y", page(f"T{i}", body, i, soup))]
        want[i] = want[100 + i] = f"T{i} {words(50, i)} & bold x same line"
    rows += [(50, "http://a.example/x", None), (51, None, "plain text"), (52, "http://a.example/", "<article>cut <p>of&#102;"),
             (53, "http://c.example/", page("Alone", "<p>only page</p>", 3)), (None, "http://a.example/x", page("N", "<p>no id</p>", 4)),
             (54, "http://d.example", "<b<i>" + "<div>" * 4000 + "deep" + "</div>" * 4000)]
    got = {r["page_id"]: r for r in wrappers.main_texts(pages(spark, rows)).collect()}
    for i in range(12):
        assert got[i]["text"] == want[i]
        # Below a plain element the text that all pages share is template.
        assert got[100 + i]["text"].startswith(f"T{i} {words(50, i)}") and "Share" not in got[100 + i]["text"] and "Read more" not in got[100 + i]["text"]
    assert got[50]["text"] == "" and got[50]["n_chars"] == 0 and got[51]["text"] == "plain text" and got[52]["text"] == "cut off"
    assert got[53]["text"] == "Alone only page" and got[None]["text"] == "N no id" and "deep" in got[54]["text"]
    assert wrappers.main_texts(pages(spark, [])).count() == 0


def test_template_inside_an_article(spark):
    rows = []
    for i in range(16):
        box = "<div class='box-3'>Read more on our site</div>" if i != 7 else "<div class='box-3'>Own words</div>"
        rows.append((i, "http://a.example/x", page(f"T{i}", f"{box}<p>{words(50, i)}</p>", i)))
        # Copies of one article with other menus: its text is not template.
        rows.append((100 + i, "http://b.example/x", page("T", f"<p>{words(50, 1)}</p>", 1).replace("menu 1", f"menu {i}")))
    got = {r["page_id"]: r["text"] for r in wrappers.main_texts(pages(spark, rows)).collect()}
    for i in range(16):
        assert got[i] == f"T{i} {'Own words ' if i == 7 else ''}{words(50, i)}"
        assert got[100 + i] == f"T {words(50, 1)}"


def test_words_of_a_class_do_not_drop_the_content(spark):
    def text_of(html):
        return wrappers.extract(html, None)

    body = f"<h1>Head</h1><p>{words(40, 1)}</p>"
    want = f"Head {words(40, 1)}"
    for start in ("<body class='page has-sidebar'>{}", "<body class='single no-comments'>{}", "<main class='content-with-sidebar'>{}</main>"):
        assert text_of(start.format(body)) == want
    assert text_of(f"<article><div class='entry-header'><h1>Head</h1></div><p>{words(40, 1)}</p></article>") == want
    assert text_of('<p title="hidden gems">one</p><div data-hidden="false">two</div><p hidden>three</p>') == "one two"
    rows = [(i, "http://a.example/x", f"<body><div class='menu'>all pages</div><div class='search-results'><p>{words(60, i)}</p></div><footer>f {i}</footer></body>") for i in range(9)]
    got = {r["page_id"]: r["text"] for r in wrappers.main_texts(pages(spark, rows)).collect()}
    assert got == {i: words(60, i) for i in range(9)}


def test_main_text_of_sample_pages(spark, samples):
    table = spark.read.parquet(f"{samples}/pages.parquet")

    def article(html):
        inner = re.search(r"<article>(.*)</article>", html, re.S)[1]
        return " ".join(unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())

    html = {r["page_id"]: r["html"] for r in table.collect()}
    assert all(r["text"] == article(html[r["page_id"]]) for r in wrappers.main_texts(table).collect())


def test_tree_matching():
    def tree(label, *children):
        return [label, label, False, "", list(children), []]

    a = tree("body", tree("nav"), tree("div", tree("p")), tree("footer"))
    b = tree("body", tree("div", tree("p"), tree("ul")), tree("aside"), tree("footer"))
    assert [(x, y) for x, _, y, _ in sorted(wrappers.align(a, b))] == [
        ("body", "body"), ("body/div", "body/div"), ("body/div/p", "body/div/p"), ("body/footer", "body/footer")
    ]


def test_a_list_page_first(spark):
    def article(i):
        return f"<body><div class='teaser'>Teaser {words(1, i)}</div><div class='post'><h2>T{i}</h2><p>{words(80, i)}</p></div></body>"

    teasers = "".join(f"<div class='teaser'>Teaser {words(1, i)}</div>" for i in range(1, 10))
    rows = [(0, "http://a.example/", f"<body>{teasers}</body>")] + [(i, f"http://a.example/{i}", article(i)) for i in range(1, 10)]
    got = {r["page_id"]: r["text"] for r in wrappers.main_texts(pages(spark, rows)).collect()}
    assert all(got[i] == f"T{i} {words(80, i)}" for i in range(1, 10)) and got[0].count("Teaser") == 9


def test_constant_blocks_among_equal_siblings(spark):
    rows = []
    for i in range(12):
        rows.append((i, "http://a.example/x", f"<body><div><p>home about</p></div><div><p>{words(60, i)}</p></div><div><p>imprint</p></div></body>"))
        body = f"<p>share this story</p><p>{words(30, i)}</p><p>{words(30, i + 50)}</p>"
        rows.append((100 + i, "http://b.example/x", f"<body><div class='x'>{body}</div></body>"))
        # An article keeps a line that all pages have: it is text, not a block of the template.
        rows.append((200 + i, "http://c.example/x", f"<body><article>{body}</article></body>"))
        # Copies of one page tell nothing about what varies.
        rows.append((300 + i, "http://d.example/x", f"<body><div><p>{words(60, 1)}</p></div><div><p>end</p></div></body>"))
    got = {r["page_id"]: r["text"] for r in wrappers.main_texts(pages(spark, rows).repartition(3)).collect()}
    for i in range(12):
        assert got[i] == words(60, i)
        assert got[100 + i] == f"{words(30, i)} {words(30, i + 50)}"
        assert got[200 + i] == f"share this story {words(30, i)} {words(30, i + 50)}"
        assert got[300 + i] == f"{words(60, 1)} end"


def test_time_for_malformed_pages():
    n = 1_000_000
    bad = ['<a "' * (n // 4), '<a x="' * (n // 6), '<a x=">" ' * (n // 9), "<a b='c' " * (n // 9), "<" * n, "<!" * (n // 2), "<!--" * (n // 4),
           "<span>" * 80_000 + "</b>" * 100_000, "<li><ul>" + "<span>" * 60_000 + "<li></li>" * 60_000, "<header>" * 60_000]
    for html in bad:
        start = time.process_time()
        wrappers.parse(html)
        assert time.process_time() - start < 5, html[:12]
    rich = "<body>" + "".join(f"<div class='{words(1, i)}x{'y' * (i % 40)}z{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}'>t{i}</div>" for i in range(8000))
    mixed = wrappers.page_tree(rich)
    mixed[4][0][4].reverse()
    start = time.process_time()
    assert len(wrappers.align(wrappers.page_tree(rich), mixed)) == 3 and time.process_time() - start < 5


def test_tags_end_where_they_should():
    def text_of(html):
        return wrappers.extract(html, None)

    assert text_of("""<p title="it's 5" tall">one</p><p title='a > b'>two</p><p x = ">" y>three</p>a < b <3 <p title="open>four</p>""") == "one two three a < b <3 four"
    assert text_of("<p>one<br/>two<!-- > x -->three</p></b></div><ul><li>a<li>b<p>c<div>d</div>") == "one twothree a b c d"


@pytest.mark.parametrize("seed", range(40))
def test_best_pairs_equal_the_plain_recurrence(seed):
    pick = random.Random(seed)

    def tree(depth):
        labels = pick.sample("abcdefg", pick.randrange(0, 7) if depth else 0)
        return [pick.choice("xy") if depth == 3 else "", "div", False, "", [[c, *tree(depth - 1)[1:]] for c in labels], []]

    def plain(a, b):
        if a[0] != b[0]:
            return 0
        rows = [[0] * (len(b[4]) + 1) for _ in range(len(a[4]) + 1)]
        for i, x in enumerate(a[4], 1):
            for j, y in enumerate(b[4], 1):
                rows[i][j] = max(rows[i - 1][j], rows[i][j - 1], rows[i - 1][j - 1] + plain(x, y))
        return 1 + rows[-1][-1]

    a, b = tree(3), tree(3)
    assert wrappers.match(a, b, {}) == plain(a, b) == len(wrappers.align(a, b))


def test_licences(spark):
    mit = "Copyright (c) 2020 Some One\n\n" + licences.MIT.upper().replace("SUBLICENSE", "Sub-Licence") + "\n© others"
    docs = documents(spark, extra=[(40, mit, "en", "a"), (41, "Text.\nReleased under the MIT licence\nMore.", "en", "a"), (42, "Released under the MIT License", "en", "a"), (43, mit + "\nx", "en", "a")])
    known = spark.createDataFrame(licences.KNOWN, "license_id string, kind string, text string")
    got = sorted((r["doc_id"], r["line"], r["license_id"]) for r in licences.scan(docs, known).collect())
    assert got == [(40, 0, "MIT"), (41, 2, "MIT"), (42, 0, "MIT"), (42, 1, "MIT")]
    assert licences.scan(no_documents(spark), known, few_known=True).count() == 0


def test_licence_forms_do_not_depend_on_line_breaks(spark):
    published = (
        "MIT License\n\nCopyright (c) 2021 A. Holder and others\n\n"
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation "
        'files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished "
        "to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\n"
        'copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\n'
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE\nAUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER\nLIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM,\nOUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE\nSOFTWARE.\n"
    )
    heads = ["", "Copyright 2020 Some One\n", "(c) 1999-2004, X Inc. All rights reserved.\n", "Copyright Acme Corp.\n", "Copyright © Some One\n\n"]
    texts, want = [published, " ".join(published.split())], ["MIT", "MIT"]
    for name, body in (("MIT", licences.MIT), ("ISC", licences.ISC)):
        one = " ".join(body.split())
        texts += [one, f"Copyright (c) 2020 Some One. All rights reserved. {one}"]
        want += [name, name]
        for width in range(12, 130, 3):
            texts.append(heads[width % 5] + textwrap.fill(one, width, break_long_words=False))
            want.append(name)
    texts += ["Copyright holders may object.\n" + licences.MIT, "© the sign of 2020\nsome text"]
    docs = documents(spark, extra=[(100 + i, t, "en", "a") for i, t in enumerate(texts)])
    known = spark.createDataFrame(licences.KNOWN, "license_id string, kind string, text string")
    got = {r["doc_id"]: r["license_id"] for r in licences.scan(docs, known).where("line = 0").collect()}
    assert [got.get(100 + i) for i in range(len(texts))] == [*want, None, None]


def test_licence_registry(spark):
    held = licences.registry()
    texts = {i: t for i, k, t in held if k == "text" and i in ("BSD-2-Clause", "BSD-3-Clause", "Unlicense", "Zlib", "Apache-2.0", "GPL-2.0-only", "MPL-2.0")}
    header = "#!/bin/sh\n# Copyright 2020 Some One\n#\n" + "\n#\n".join(
        "\n".join("# " + x for x in textwrap.wrap(part, 60)) for part in licences.APACHE_NOTICE.strip().replace("License at ", "License at\n").split("\n")
    )
    lgpl = (
        "/*\n * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n"
        " * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.\n */\nint x;"
    )
    cases = [
        (header + "\n\necho licensed\n", [(4, "Apache-2.0")]),
        (lgpl, [(2, "LGPL-2.1-or-later")]),
        ("x\nLicensed under CC BY 3.0\ny", [(2, "CC-BY-3.0")]),
        ("x\nLicensed under the\nMIT\n\nLicence and more\nx", []),
        ("x\nLicensed under the\nMIT\n\nLicence\nx", [(2, "MIT")]),
        *((f"Foo {i}\n\n" + textwrap.fill(" ".join(t.split()), 90) + "\n\nbar", [(3, i)]) for i, t in texts.items() if not t.startswith("\n") and i not in ("GPL-2.0-only",)),
        (texts["GPL-2.0-only"], [(0, "GPL-2.0-only")]),
    ]
    docs = documents(spark, extra=[(200 + n, c[0], "en", "a") for n, c in enumerate(cases)])
    known = spark.createDataFrame(held, "license_id string, kind string, text string")
    got = {(r["doc_id"], r["line"], r["license_id"]) for r in licences.scan(docs, known, few_known=True, runs=True).collect()}
    for n, (_, want) in enumerate(cases):
        mine = {(line, i) for d, line, i in got if d == 200 + n}
        assert set(want) <= mine and (want or not mine), (n, cases[n][0][:60], want, mine)
    assert licences.scan(no_documents(spark), known, runs=True).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, v int, rank string, block string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if x is None else [None if y is None else float(y) for y in x], 0, 1, "r", "b") for i, x in rows], VECTORS)


def test_neighbours_equal_brute_force(spark):
    random = np.random.default_rng(5)
    x = random.normal(size=(600, 32)).astype(np.float32)
    x[100:160] = x[100]  # ties
    rows = list(enumerate(x.tolist())) + [(700, None), (750, [0.0] * 32), (800, [float("nan")] + [1.0] * 31), (850, [None] + [1.0] * 31), (None, [1.0] * 32), (900, [1.0] * 3)]
    got = neighbours.nearest(vectors(spark, rows), every=50).collect()
    hit = total = 0
    for q in range(0, 600, 50):
        s = x.astype(float) @ x[q].astype(float) / np.linalg.norm(x.astype(float), axis=1) / np.linalg.norm(x[q].astype(float))
        s[q] = -9
        best = np.lexsort((np.arange(600), -np.round(s, 12)))[:5]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in mine] == [1, 2, 3, 4, 5] and all(abs(s[v] - score) < 1e-9 for _, v, score in mine)
        hit += len({v for _, v, _ in mine} & set(best.tolist()))
        total += 5
    assert hit / total >= 0.9 and {r["query_id"] for r in got} == set(range(0, 600, 50))
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 100] == [101, 102, 103, 104, 105]


def test_neighbours_of_few_rows(spark):
    got = neighbours.nearest(vectors(spark, [(0, [1, 0]), (1, [0, 1]), (2, [-1, 0.0])]), every=50).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1), (2, 2)]
    assert neighbours.nearest(vectors(spark, []), every=50).count() == 0
    assert neighbours.nearest(vectors(spark, [(0, [1, 0])]), every=50).count() == 0


def test_every_code_within_the_radius_is_found():
    random = np.random.default_rng(2)
    code = random.integers(0, 2**63, (500, 4)).astype(np.uint64)
    code[::2] = code[0] ^ (np.uint64(1) << random.integers(0, 63, (250, 4)).astype(np.uint64))
    index = neighbours.BlockIndex(code)
    for radius in (0, 3, 8, 100, 256):
        assert index.within(code[0], radius).tolist() == np.flatnonzero(neighbours.hamming(code, code[0]) <= radius).tolist()


def test_scratch_folders_are_new(spark):
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")


def test_a_long_page_is_put_together_in_time(spark, tmp_path):
    """Thousands of segments; each is copied once."""
    import time

    long = spark.range(1).selectExpr("id AS page_id", "'u' AS url", "repeat('0123456789abcdef', 2500000) AS html")
    start = time.time()
    got = warc.round_trip(long, str(tmp_path / "long")).select("payload_bytes", "payload_digest").first()
    assert got["payload_bytes"] == 40_000_000 and got["payload_digest"] == hashlib.sha1(b"0123456789abcdef" * 2_500_000).hexdigest()
    assert time.time() - start < 60


def test_licences_behind_long_statements_and_spellings_of_several_words(spark):
    body = " ".join(licences.MIT.split())
    holders = ", ".join(f"Holder Number {i}" for i in range(60))
    spelled = body.replace("sublicense", "sub licence")
    many = "Word one non commercial non commercial non commercial non commercial sub license and per cent, whilst all else stands."
    known = [("MIT", "text", body), ("Many", "text", many.replace("non commercial", "noncommercial").replace("per cent", "percent").replace("sub license", "sublicense"))]
    texts = [
        f"Copyright (c) 2020 {holders}. {body}",
        f"see below, Copyright 2019 {holders} {body}",
        "intro\n" + f"Copyright (c) 2020 {holders}\n" + spelled.replace(". ", ".\n").replace("sub licence", "sub\nlicence") + "\nend",
        "intro\n" + many.replace("non commercial", "non\ncommercial").replace(" else", "\nelse") + "\nend",
        "copyright 2020 " * 30_000 + "x",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = spark.createDataFrame(known, "license_id string, kind string, text string")
    found = {(r.doc_id, r.license_id) for r in licences.scan(docs, table, runs=True).collect()}
    assert found == {(0, "MIT"), (2, "MIT"), (3, "Many")}
