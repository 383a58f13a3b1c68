"""Operators that look at one text at a time, against plain Python on whole texts."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import html_text, language_id, licenses, quality_rules, url_filter
from millrace.llm.wordhash import pieces, windows, words

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ODD = [
    None, "", " ", "\n\n", "a", "a b c d", "a a a a", "é ñ\tü", "x" * 5000, "one\ntwo\none\n \none", "A b c d",
    "w " * 3000, "MIT License", "mit license mit license", "# $ % &&& | <>", "\x1c\x1d a\x85b", "中文 中文 中文",
]


@pytest.fixture(scope="module")
def texts(spark):
    found = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]
    return ODD + found


def test_pieces_give_the_words_of_each_text(texts):
    column = pa.array(texts)
    for size in (1, 100, 1 << 20):
        counts = np.concatenate([np.diff(words(p)[1]) for p in pieces(column, size)])
        assert counts.tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    sliced = column.slice(3, 9)
    assert sum(p.texts for p in pieces(sliced)) == 9


def test_equal_words_and_windows_have_equal_hashes():
    piece = next(pieces(pa.array(["one two three one two three", "ONE two three"])))
    hashes, _ = words(piece, lower=True)
    assert hashes[0] == hashes[3] == hashes[6] and len(set(hashes.tolist())) == 3
    runs = windows(hashes, 3)
    assert runs[0] == runs[3] == runs[6]


def counts_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, covered, again = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2)), set(), 0
    for i in range(len(w) - 2):
        if seen[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = set()
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered)


def test_quality_measures_equal_plain_counts(texts):
    found = quality_rules.measure(pa.array(texts))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert [tuple(r) for r in found[names].to_numpy().tolist()] == [counts_of(t) for t in texts]


def test_quality_report_keeps_good_and_rejects_junk(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    report = quality_rules.quality_report(docs, labels).join(labels, "doc_id").toPandas()
    for row in report.itertuples():
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        assert not (row.base_failed and row.kept)
    passed = report[~report.base_failed]
    assert passed[passed.quality == 1].kept.mean() > 0.99
    assert passed[passed.quality == 0].kept.mean() < 0.2


def test_quality_of_odd_tables(spark, make_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 0, 0), (5, None, None)], "doc_id bigint, quality int, toxic int")
    docs = make_docs([(i, t) for i, t in enumerate(ODD)] + [(1, "again"), (None, "no id")]).withColumn("measures", F.lit(1))
    report = quality_rules.quality_report(docs, labels)
    assert report.count() == len(ODD) + 2
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == report.where("kept").count()
    assert quality_rules.quality_report(make_docs([]), labels.limit(0)).count() == 0


def test_trees_isolate_outliers_sooner():
    rows = np.concatenate([np.zeros((250, 2)), np.full((6, 2), 5.0)])
    random = np.random.default_rng(1)
    parts, roots = [], []
    for _ in range(20):
        nodes = quality_rules._grow(rows, random)
        base = sum(map(len, parts))
        roots.append(base)
        parts.append([(f, s, a + base, b + base, n) for f, s, a, b, n in nodes])
    columns = [np.array(c) for c in zip(*sum(parts, []), strict=True)]
    forest = quality_rules.Forest(np.array(roots), *columns, 256)
    scores = forest.scores(np.array([[0.0, 0.0], [5.0, 5.0]]))
    assert 0 < scores[0] < scores[1] < 1


def license_brute_force(text, rules):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, base = [], set()
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        for i in range(len(w) - len(parts) + 1):
            if w[i : i + len(parts)] == parts:
                places.append(i)
                base.add(label)
    line, found = " " + " ".join(w) + " ", []
    for k, rule in enumerate(rules):
        for m in re.finditer(f"(?<= )(?=(?:{rule['pattern']}) )", line):
            start = line[: m.start()].count(" ") - 1
            words_in = re.compile(f"(?:{rule['pattern']})(?= )").match(line, m.start()).group().count(" ") + 1
            found.append((start, start + words_in, rule["priority"], k, rule["label"]))
    stays = [
        a for a in found
        if not any(b[0] <= a[0] and b[1] >= a[1] and b[2] >= a[2] and (b[:3] != a[:3] or b[3] < a[3]) for b in found)
    ]
    return (
        len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
        ",".join(sorted(base | {a[4] for a in stays})), max([a[2] for a in stays], default=0) / 4,
    )


def test_license_scan_equals_brute_force(spark, make_docs, texts):
    rules = licenses.signature_rules()
    assert len(rules) > 300
    assert all(any(a in f" {r['keyword']} " for a in licenses.ANCHORS) for r in rules)
    extra = [
        "Licensed under CC BY-NC 4.0. MIT license, Apache License, Version 2.0", "cc by cc by cc by", "gpl-3 or any later version",
        "GNU General Public License version 3 or later and the GNU Lesser General Public License v2.1", "SPDX-License-Identifier: MIT",
        "MIT-License. " * 500, "the mit. license", "released under the terms of the GNU AGPL",
    ]
    docs = make_docs(list(enumerate(texts + extra))).withColumn("license", F.lit("mine"))
    rows, verdict = licenses.scanned(docs)
    assert verdict != "license" and "license" in rows.columns
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    for row in rows.select("text", f"{verdict}.*").collect():
        assert tuple(row[n] for n in names) == license_brute_force(row.text, rules), row.text
    assert licenses.scanned(make_docs([]))[0].count() == 0


BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice. 2. Redistributions in binary form must reproduce it. "
NOTICES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": "mit",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice": "isc",
    BSD + "THIS SOFTWARE IS PROVIDED BY": "bsd-2-clause",
    BSD + "3. Neither the name of X nor the names of its contributors may be used to endorse or promote products derived from this software. THIS SOFTWARE IS PROVIDED BY": "bsd-3-clause",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages": "zlib",
    "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "gpl,gpl-3-or-later",
    "the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.": "lgpl-2.1-or-later",
    "under the terms of version 2 of the GNU General Public License": "gpl,gpl-2",
    "GPLv3": "gpl-3", "LGPLv2.1": "lgpl-2.1", "Apache-2.0": "apache-2.0", "MPL-2.0": "mpl-2.0", "BSD-3-Clause": "bsd-3-clause", "GPLv2 or later": "gpl-2-or-later",
    "released under the MIT": "mit", "Apache 2.4 serves": "", "a permission to use": "", "AGPL-3.0-or-later": "agpl-3-or-later",
}


def test_licenses_of_notices_texts_and_short_identifiers(make_docs):
    rules = licenses.signature_rules()
    rows, verdict = licenses.scanned(make_docs(list(enumerate(NOTICES))))
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    for row in rows.select("text", f"{verdict}.*").collect():
        assert row.labels == NOTICES[row.text], row.text
        assert tuple(row[n] for n in names) == license_brute_force(row.text, rules), row.text


def url_brute_force(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest, re.S).group()
        path, host = re.match(r"[^?#]*", rest[len(host) :], re.S).group(), host.translate(LOWER)
    fit = []
    for rule, verdict in url_filter.RULES:
        own, start = rule.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            fit.append((len(rule), rule, verdict))
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


def test_url_rules_equal_brute_force(spark):
    odd = [
        None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/1", "http://www.example.com/en/1?x=http://a.com/",
        "https://example.com/en/", "https://example.com/en", "http://a.example.com/en/x#y", "http://xexample.com/en/x", "ftp://net/es/1",
        "http://b.net/fr/", "http://com", "http://com/", "http://user:pw@h.org:80/p", "http://ü.de/\n/x", "http://h.org?q/",
    ]
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url")
    odd_rows = spark.createDataFrame([(-i, u) for i, u in enumerate(odd)] + [(None, "http://x.net/es/")], "page_id bigint, url string")
    rows, verdict = url_filter.judged(pages.unionByName(odd_rows).withColumn("filter", F.lit(0)))
    found = rows.select("url", f"{verdict}.*").collect()
    assert len(found) == pages.count() + len(odd) + 1
    for row in found:
        host, path, rule, says = url_brute_force(row.url)
        assert (row.host, row.path, row.rule) == (host, path, rule), row.url
        assert row.verdict == says if says else row.verdict in ("allow", "block")
    empty, name = url_filter.judged(pages.limit(0))
    assert empty.count() == 0
    alone, name = url_filter.judged(spark.createDataFrame([(1, "http://a.org/x")], "page_id bigint, url string"))
    assert alone.select(f"{name}.verdict").first()[0] == "allow"


def test_url_model_is_accurate_on_urls_it_has_not_seen(spark):
    good = [f"http://site{i}.org/story/{'abc'[i % 3]}ontent-{i}" for i in range(300)]
    bad = [f"http://win{i}.biz/xxx/casino{i}zz" for i in range(300)]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(good + bad)], "page_id bigint, url string")
    asked = [(10_000, "http://site900.org/story/content-7"), (10_001, "http://win900.biz/xxx/casino7zz")]
    rules = [(f"site{i}.org/", "allow") for i in range(0, 300, 7)] + [(f"win{i}.biz/", "block") for i in range(0, 300, 7)]
    found, name = url_filter.judged(rows.unionByName(spark.createDataFrame(asked, rows.schema)), rules=rules)
    verdicts = {r.page_id: r.verdict for r in found.where(f"{name}.rule is null").select("page_id", f"{name}.verdict").collect()}
    right = [verdicts[i] == ("allow" if i < 300 or i == 10_000 else "block") for i in verdicts]
    assert np.mean(right) > 0.95 and verdicts[10_000] == "allow" and verdicts[10_001] == "block"


def test_html_of_given_pages_is_their_article(spark):
    import html as html_module

    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    rows, text = html_text.extracted(pages.withColumn("main_text", F.lit(1)))
    for row in rows.select("html", F.col(text).alias("found")).collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S).group(1)
        blocks = [" ".join(html_module.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert row.found == "\n".join(b for b in blocks if b)


LONG = "This is a sentence of some length that tells a part of the story. "


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        (None, ""), ("", ""), ("  \n ", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\nb"),
        ("<script>var a='<p>x</p>'</script><!-- <p>c</p> -->", ""), ("<article><p>x&nbsp; &lt;y&gt;\n z</p></article>", "x <y> z"),
        ("<nav>menu<article><p>text</p></article>", "text"), ("<article><h1>T</h1><aside>no</aside><p>yes</article>", "T\nyes"),
        ("<article><p>one</p></article><section class='comments'><article><p>a reader</p></article></section>", "one"),
        (f"<div class='menu'><a href=x>{LONG}</a></div><div><p>{LONG * 3}</p><p>{LONG * 2}</p></div><div id=footer>{LONG}</div>", f"{LONG.strip() and (LONG * 3).strip()}\n{(LONG * 2).strip()}"),
        ("<article><form>f</form><p class=\"ad\">x</p><p title='a>b'>t</p></article>", "t"),
        ("<main><p>m</p></main><p>outside</p>", "m"), ("<" * 50, "<" * 50),
    ],
)
def test_html_cases(source, wanted):
    assert html_text.main_text(source) == wanted


@pytest.mark.parametrize(
    "lengths", [[60, *[400] * 8, 50], [400] * 4, [*[600] * 6, *[20] * 12, *[600] * 6], [300, 300], [10]],
)
def test_html_without_article_keeps_the_whole_span(lengths):
    lines = [chr(97 + i % 26) * n for i, n in enumerate(lengths)]
    assert html_text.main_text("".join(f"<p>{x}</p>" for x in lines)) == "\n".join(lines)


def test_html_keeps_linked_headings_and_every_article():
    text = LONG.strip()
    menu = "<ul><li><a href=a>Home</a><li><a href=b>News</a></ul>"
    page = f"{menu}<div><h1><a href=x>Title</a></h1><p>{text}</p><div><a href=y>More</a></div><p>{text}</p></div>{menu}"
    assert html_text.main_text(page) == f"Title\n{text}\nMore\n{text}"
    long, short = ["x" * 500] * 20, ["y" * 100] * 2
    articles = "".join("<article>" + "".join(f"<p>{x}</p>" for x in part) + "</article>" for part in (long, short))
    assert html_text.main_text(f"<p>{text}</p>{articles}<div class=related><article><p>{text}</p></article></div>") == "\n".join(long + short)


PARAGRAPHS = "".join(f"<p>{LONG * 6}</p>" for _ in range(6))
STORY = "\n".join([(LONG * 6).strip()] * 6)


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ('<article class="post comments-open"><p>one</p></article>', "one"), ('<div class="content comment-enabled"><p>one</p></div>', "one"),
        (f'<div>{PARAGRAPHS}</div><article class="teaser"><p>Read on.</p><p>More.</p></article>', f"{STORY}\nRead on.\nMore."),
        (f"<main><h1>The Title</h1><article>{PARAGRAPHS}</article><p>Closing text.</p></main>", f"The Title\n{STORY}\nClosing text."),
        (f'<article><p class="notice-board-history">Boards.</p>{PARAGRAPHS}</article>', f"Boards.\n{STORY}"),
        (f'<article>{PARAGRAPHS}<p class="site-notice">No.</p><div class="user-comments"><p>{LONG * 9}</p></div></article>', STORY),
        (f"<div>Acme Daily</div><div>Search</div><div>{PARAGRAPHS}</div><div>Copyright 2024 Acme</div><div>All rights reserved</div>", STORY),
        (f"<div>{PARAGRAPHS}</div><p>We use cookies. Accept all</p>", STORY), (f"<p>{PARAGRAPHS}<h3>2 Comments</h3><ul><li>Nice!<li>No.</ul>", STORY),
        (f'<form id="aspnetForm"><div class="cookie-bar"><p>Cookies</p></div>{PARAGRAPHS}</form><div>Home</div>', STORY),
        (f'<div class="widget-page">{PARAGRAPHS}</div><div>Home</div>', STORY), (f'<div class="comments">{PARAGRAPHS}</div>', ""),
        (f"<div>{PARAGRAPHS}<ul>{''.join(f'<li>item {i}</li>' for i in range(9))}</ul></div>", STORY + "".join(f"\nitem {i}" for i in range(9))),
        (f"<article><h1>T</h1><p>short</p></article><div>{PARAGRAPHS}</div>", "T\nshort"), ("<footer>all</footer><div class=cookie>c</div>", ""),
    ],
)
def test_html_tags_and_classes_are_evidence(source, wanted):
    assert html_text.main_text(source) == wanted


def test_html_distribution_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(300):
        weights = rng.integers(0, 200, rng.integers(1, 30)) * (rng.random() < 0.7)
        weights[rng.random(len(weights)) < 0.5] = 0
        sure = rng.random(len(weights)) < 0.2
        threshold = max(html_text.SURGE * np.mean([sum(weights[i : i + 3]) for i in range(len(weights))]), 1)
        raised = [max(w, threshold) if s else w for w, s in zip(weights, sure, strict=True)]
        high = [i for i in range(len(weights)) if max(sum(raised[i : i + 3]), sum(raised[max(i - 2, 0) : i + 1])) >= threshold - 1e-9]
        assert html_text.surge_and_dive(weights.astype(float), sure)[:2] == ((high[0], high[-1] + 1) if high else (0, 0))


def test_html_of_an_empty_table_and_repeated_rows(spark):
    page = "<article><p>x</p></article>"
    rows = [(1, "u", page), (1, "u", page), (None, None, None), (2, "v", "")]
    for given in (rows, []):
        found, text = html_text.extracted(spark.createDataFrame(given, "page_id bigint, MAIN_TEXT string, html string"))
        assert sorted((str(r.page_id), r[text]) for r in found.collect()) == ([("1", "x"), ("1", "x"), ("2", ""), ("None", "")] if given else [])


@pytest.mark.parametrize(
    ("line", "labels"),
    [
        ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2-or-later"), ("SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl-2.1-or-later"),
        ("SPDX-License-Identifier: GPL-3.0-only", "gpl-3"), ("SPDX-License-Identifier: MIT-0", "mit-0"), ("SPDX-License-Identifier: MIT", "mit"),
    ],
)
def test_license_tags(spark, line, labels):
    rows, name = licenses.scanned(spark.createDataFrame([(1, line)], "doc_id bigint, text string"))
    assert rows.select(f"`{name}`.labels").first()[0] == labels


def test_long_broken_pages_end_soon():
    import time

    began = time.time()
    for source in ("<a " * 100_000, '<a "' * 50_000, "<!-- " * 50_000, "<div>" * 50_000 + "x", "<title>" * 30_000 + ">", "<span>" * 20_000 + "<div></div>" * 20_000):
        html_text.main_text(source)
    assert time.time() - began < 20


def test_languages(spark, make_docs):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("evidence", F.lit(1))
    rows, verdict = language_id.document_languages(docs)
    found = rows.select("lang", f"{verdict}.*").collect()
    assert len(found) == docs.count()
    assert np.mean([r.language == r.lang for r in found]) > 0.98
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == docs.where("length(trim(text)) > 0").count()


def test_language_evidence_is_fused(spark, make_docs):
    known = [(i, "the cat and the dog sat on the mat with them", "en", "www.a.uk") for i in range(40)]
    known += [(100 + i, "le chat et le chien sont sur le tapis avec eux", "fr", "www.b.fr") for i in range(40)]
    odd = [(200, "", "en", "www.b.fr"), (201, None, None, None), (202, "12 34 !!", "fr", ""), (203, "xyz", None, "www.b.fr"), (203, "xyz", None, "www.b.fr")]
    docs = make_docs(known + odd)
    model = language_id.train(docs, "text", F.col("lang"), ("en", "fr"))
    rows, verdict = language_id.identified(docs, "text", F.col("lang"), F.col("source"), model, ("en", "fr"))
    found = {r.doc_id: r for r in rows.select("doc_id", f"{verdict}.*").collect()}
    assert all(found[i].language == ("en" if i < 100 else "fr") and found[i].kept for i in found if i < 200)
    assert found[203].language == "fr" and found[203].kept  # the host's prior decides
    assert not found[200].kept and not found[201].kept and not found[202].kept and found[201].text_language is None
    empty, _ = language_id.document_languages(make_docs([]))
    assert empty.count() == 0


def test_languages_are_learnt_and_unknown_text_is_rejected(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("length(trim(text)) > 0")
    dutch = "De kat zat op de mat en keek naar buiten, waar het al de hele dag regende en de kinderen niet konden spelen. "
    italian = "Il gatto era seduto sul tappeto e guardava fuori, dove pioveva tutto il giorno e i bambini non potevano giocare. "
    russian = "Кошка сидела на коврике и смотрела на улицу, где весь день шёл дождь, и дети не могли играть. "
    rng = np.random.default_rng(4)
    noise = ["".join(rng.choice(list("bcdfghjklmnpqrstvwxz "), 600)) for _ in range(5)]
    odd = [(-1, dutch * 4, "nl"), (-2, italian * 4, None), (-3, russian * 4, None), (-4, "他在垫子上坐着看外面下雨。" * 20, "zh"), (-5, italian, "it")]
    odd += [(-10 - i, text, "en") for i, text in enumerate(noise)]
    russians = [(10**6 + i, " ".join(rng.permutation(russian.split() * 5)), "ru-RU") for i in range(30)]
    planted = spark.createDataFrame([(*r, "src1") for r in odd], "doc_id bigint, text string, lang string, source string")
    known = spark.createDataFrame([(*r, "src1") for r in russians], planted.schema)
    given = docs.select(planted.columns)
    assert language_id.languages_of(given.unionByName(known), "text", language_id.primary_tag(F.col("lang"))) == ("de", "en", "es", "fr", "ru", "other")
    kept = {r.doc_id for r in language_id.keep_identified(given.unionByName(planted)).collect()}
    # what declares a language too rare to learn passes with its tag; what declares none, or a learnt one, does not
    assert kept == {r.doc_id for r in given.collect()} | {-1, -4, -5}
    rows, verdict = language_id.document_languages(given.unionByName(known).unionByName(planted))
    found = {r.doc_id: r for r in rows.select("doc_id", f"{verdict}.*").collect()}
    assert all(found[10**6 + i].language == "ru" and found[10**6 + i].kept for i in range(30)) and found[-3].kept
    assert {i: found[i].language for i in (-1, -4, -5)} == {-1: "nl", -4: "zh", -5: "it"}
    assert not any(r.kept for i, r in found.items() if i < 0 and i not in (-1, -3, -4, -5))


def test_a_rare_language_is_learnt_or_passes(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("length(trim(text)) > 0").select("doc_id", "text", "lang", "source")
    many = docs.unionByName(docs).unionByName(docs).unionByName(docs).unionByName(docs)
    icelandic = "Kötturinn sat á mottunni og horfði út um gluggann þar sem það hafði rignt allan daginn og börnin gátu ekki leikið sér. "
    for copies, size, learnt in ((6, 20, True), (4, 20, False), (6, 2, False)):
        rows = [(-1 - i, icelandic * size, "is", "src1") for i in range(copies)]
        planted = many.unionByName(spark.createDataFrame(rows, docs.schema))
        assert ("is" in language_id.languages_of(planted, "text", language_id.primary_tag(F.col("lang")))) is learnt
        found, verdict = language_id.document_languages(planted, keep=["doc_id"])
        told = [(r.language, r.kept) for r in found.where("doc_id < 0").select(f"{verdict}.*").collect()]
        assert told == [("is", True)] * copies


def test_texts_without_triples_in_generated_code(spark, make_docs):
    texts = {"en": "the cat and the dog sat on the mat with them", "fr": "le chat et le chien sont sur le tapis avec eux"}
    known = [(i, texts[tag], tag, f"www.a.{tag}") for i, tag in enumerate(["en", "fr"] * 30)]
    odd = [(100, None, "en", "src1"), (101, "", None, None), (102, "12 34 !!", "fr", "www.a.fr"), (103, "12", "is", "src1"), (104, None, None, "src1"), (None, None, None, None)]
    settings = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows, verdict = language_id.document_languages(make_docs(known + odd), keep=["doc_id"])
        found = {r.doc_id: r for r in rows.select("doc_id", f"{verdict}.*").collect()}
        pages = [(i, f"http://x.a.{tag}/", f"<html lang='{tag}'><p>{text}</p></html>" if text else None) for i, text, tag, _ in known + odd]
        rows, verdict = language_id.page_languages(spark.createDataFrame(pages, "page_id bigint, url string, html string"), keep=["page_id"])
        judged = {r.page_id: r for r in rows.select("page_id", f"{verdict}.*").collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) == len(judged) == 66
    for result in (found, judged):
        assert all(result[i].kept and result[i].language == tag for i, _, tag, _ in known)
        assert not any(result[i].kept or result[i].text_language for i, *_ in odd)


def test_long_texts_reach_python_workers_few_at_a_time(spark, make_docs, monkeypatch):
    most = 2 * 4 * 1024 * 1024
    counter, evidence = language_id._counter, language_id._text_evidence

    def checked(size):
        if size > most:
            raise ValueError(f"{size} bytes at once")

    def counted(languages):
        def run(batches):
            def few():
                for batch in batches:
                    checked(batch.nbytes)
                    yield batch

            yield from counter(languages)(few())

        return run

    def measured(model):
        def run(texts):
            checked(texts.nbytes)
            return evidence(model)(texts)

        return run

    monkeypatch.setattr(language_id, "_counter", counted)
    monkeypatch.setattr(language_id, "_text_evidence", measured)
    texts = {"en": "the cat and the dog sat on the mat with them ", "fr": "le chat et le chien sont sur le tapis avec eux "}
    docs = make_docs([(i, texts[tag] * 12_000, tag, "src1") for i, tag in enumerate(["en", "fr"] * 20)]).coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    rows, verdict = language_id.document_languages(docs, keep=["doc_id", "lang"])
    assert all(r.language == r.lang and r.kept for r in rows.select("lang", f"{verdict}.*").collect()) and rows.count() == 40
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_probabilities_of_many_languages_end_soon(spark):
    import time

    scores = np.random.default_rng(5).normal(0, 20, (60, 600))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(scores)] + [(60, None)], "i int, scores array<double>")
    began = time.time()
    found = {r.i: r.p for r in df.select("i", language_id.normalised(F.col("scores")).alias("p")).collect()}
    assert time.time() - began < 20 and found.pop(60) is None
    powers = np.exp(scores - scores.max(axis=1, keepdims=True))
    assert np.allclose([found[i] for i in range(60)], powers / powers.sum(axis=1, keepdims=True), rtol=1e-12)


def test_triples_of_many_languages_are_counted(spark, make_docs):
    tags = [f"{a}{b}" for a in "abcdefghij" for b in "pqrst"]
    docs = make_docs([(i, f"{tag} {tag * 3} abc", tag, "src1") for i, tag in enumerate(tags * 2)] + [(200, "zzz", "zz", "src1"), (201, None, None, None)])
    model = language_id.train(docs, "text", F.col("lang"), tags)
    for k, tag in enumerate(tags):
        codes = [c for c in zip(*(f"{tag} {tag * 3} abc".encode()[j:] for j in range(3))) if c[1] != 0x20]
        counts = np.full(1 << language_id.BUCKET_BITS, language_id.SMOOTHING)
        for a, b, c in codes * 2:
            counts[((a << 16 | b << 8 | c) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - language_id.BUCKET_BITS)] += 1
        assert np.allclose(model[k], np.log((1 - language_id.UNSEEN) * counts / counts.sum() + language_id.UNSEEN / len(counts)))


def test_languages_of_pages_use_markup_and_url(spark):
    tags = [
        ('<!DOCTYPE html><HTML class="x" LANG=en-US>', "en-US"), ("<html dir='ltr' xml:lang='de'>", "de"), ("<html data-lang='x'>", None),
        ("<html><meta content='fr' http-equiv='content-language'>", "fr"), ("<p lang='es'>", None), (None, None),
    ]
    df = spark.createDataFrame(tags, "html string, wanted string").select(language_id.markup_language(F.col("html")).alias("found"), "wanted")
    assert all(r.found == r.wanted for r in df.collect())
    texts = {"en": "the cat and the dog sat on the mat with them", "fr": "le chat et le chien sont sur le tapis avec eux"}
    pages = [(i, f"http://{tag}{i % 3}.a.{tag}/x", f"<html lang='{tag}-X'><p>{text}</p></html>") for k, (tag, text) in enumerate(texts.items()) for i in range(40 * k, 40 * k + 40)]
    pages += [(100, "http://fr9.a.fr/y", "<p>xyz</p>"), (101, "http://new.b.en/y", "<p>xyz</p>"), (102, "http://q.c.org/y", "<html lang='fr'><p>xyz</p>")]
    rows, verdict = language_id.page_languages(spark.createDataFrame(pages, "page_id bigint, url string, html string"))
    found = {r.page_id: r for r in rows.select("page_id", "html", f"{verdict}.*").collect()}
    assert len(found) == 83 and all(found[i].language == ("en" if i < 40 else "fr") and found[i].kept for i in range(80))
    assert [found[i].language for i in (100, 101, 102)] == ["fr", "en", "fr"]  # domain, suffix and markup decide


def test_language_keys(spark):
    row = spark.createDataFrame([("en-US", "https://www.News.example.de/x")], "d string, u string").select(
        language_id.primary_tag(F.col("d")).alias("tag"), language_id.host_of(F.col("u")).alias("host"),
        language_id.domain_of(language_id.host_of(F.col("u"))).alias("domain"),
    ).first()
    assert tuple(row) == ("en", "www.news.example.de", "example.de")


