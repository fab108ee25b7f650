"""URL filter and license scan against plain Python."""

import itertools

from corvane.llm import license_scan as ls
from corvane.llm import url_filter as uf


def test_url_filter(spark):
    urls = [None, "", "no scheme", "HTTP://WWW.Example.COM/en/x?q", "http://a.example.com/en/", "http://a.example.com/EN/", "x://com", "x://com/", "x://b.net/es/1#f", "x://net/fr/", "x://b.net/fr", "y://spam.org/p/", "http://spam.org/p", "http://www.spam.org/p?x=1", "ftp://u://v/w", "x://example.com/en/", "http://xexample.com/en/", "http://spam.org/p"]
    pages = spark.createDataFrame([(i, u, 1, "z") for i, u in enumerate(urls)], "page_id long, url string, block int, canon string")
    listed = spark.createDataFrame([("spam.org/p",), ("spam.org/p",), (None,)], "u string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uf.judge(pages, listed).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[4] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert got[5] == ("a.example.com", "/EN/", "com/", "allow")
    assert got[6] == ("com", "", None, "allow") and got[7] == ("com", "/", "com/", "allow")
    assert got[8][2:] == ("net/es/", "block") and got[9][2:] == ("net/fr/", "block") and got[10][2:] == (None, "allow")
    assert [got[i][3] for i in (11, 12, 13, 17)] == ["block"] * 4
    assert got[14][0] == "u:" and got[15][2] == "example.com/en/" and got[16][2] == "com/"
    assert {r.verdict for r in uf.judge(pages, listed.limit(0)).filter("rule is null").collect()} == {"allow"}
    assert uf.judge(pages.limit(0), listed).count() == 0


def test_bloom_never_misses(spark):
    keys = spark.range(5000).selectExpr("concat('h', id, '.org/p') as canon")
    pages = spark.range(20000).selectExpr("id as page_id", "concat('x://h', id, '.org/p') as url")
    out = uf.judge(pages, keys).selectExpr("count_if(listed) n", "count_if(possible) p", "count_if(listed and page_id >= 5000) wrong").first()
    assert out.n == 5000 and out.wrong == 0 and out.p < 5300


def test_large_filters_are_joined(spark, monkeypatch):
    """Beyond the size that is broadcast the same verdicts come from joins."""
    keys = spark.range(5000).selectExpr("concat('h', id % 4000, '.org/p') as canon")
    urls = spark.range(9000).selectExpr("id as page_id", "case when id % 3 = 0 then 'x://h7.org/p/' when id % 7 = 0 then null else concat('x://h', id, '.org/p') end as url")
    long = spark.createDataFrame([(-1, "x://h1.org/p?" + "q" * 200_000), (-2, "x://h1.org/" + "p" * 200_000), (-3, "x://" + "h" * 100_000)], "page_id long, url string")
    pages = urls.unionByName(long)
    want = sorted(map(tuple, uf.judge(pages, keys).select("page_id", "verdict", "listed").collect()))
    assert dict((r[0], r[2]) for r in want[:3]) == {-3: False, -2: False, -1: True}
    monkeypatch.setattr(uf, "BROADCAST_BYTES", 0)
    joined = uf.judge(pages, keys)
    assert sorted(map(tuple, joined.select("page_id", "verdict", "listed").collect())) == want
    assert all(r[2] == (r[0] % 3 == 0 or (r[0] % 7 > 0 and r[0] < 4000)) for r in want[3:])


def test_a_list_beyond_the_broadcast_size(spark):
    """Over 8 MB of filter: four million keys and more."""
    n = (uf.BROADCAST_BYTES // uf._ROW_BYTES) * 256 // uf.BITS_PER_KEY + 1
    keys = spark.range(n).selectExpr("concat('k', id, '.org') as canon")
    pages = spark.range(0, 2 * n, 1009).selectExpr("id as page_id", "concat('x://k', id, '.org/') as url")
    out = uf.judge(pages, keys).selectExpr("count_if(listed <> (page_id < " + str(n) + ")) wrong", "count(*) n", "count_if(possible and not listed) extra").first()
    assert out.wrong == 0 and out.n == -(-2 * n // 1009) and out.extra < 0.01 * out.n


def _brute(text):
    words = ls.words_of(text or "") if text else []
    places = [(i, label) for p, label in ls.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    fits = []
    for _, label, w, need, must, stride in ls.template_rows():
        for i in range(0, len(words), stride):
            held = set(words[i : i + 2 * stride])
            if len(held & set(w)) >= need and held >= set(must):
                fits.append((label, len(held & set(w)) / len(w)))
    base = sorted({x for _, x in places})
    return (len(words), len(places), min(places, default=(None,))[0], max(places, default=(None,))[0], ",".join(base), ",".join(sorted({*base, *(x for x, _ in fits)})), 1.0 if places else max((c for _, c in fits), default=0.0))


def test_license_scan(spark):
    parts = ["MIT License", "mit license mit-license", "Released under the MIT terms. License", "cc by", "x CC  BY-NC 4.0 under licensed", "GNU\ngeneral public license!", "", "apache é license", "Apache\tLicense, Version 2.0 licensed", "ÀÉ 12 the of under version 3 this is work"]
    texts = [None, "", *("\n".join(p) for n in (1, 2) for p in itertools.permutations(parts, n)), "word " * 30_000 + "mit license"]
    docs = spark.createDataFrame([(i // 2, t, "l", 1) for i, t in enumerate(texts)], "doc_id long, text string, label string, words int")
    got = sorted((tuple(r) for r in ls.scan(docs).collect()), key=str)
    want = sorted(((i // 2, *_brute(t)) for i, t in enumerate(texts)), key=str)
    assert got == want
    assert ls.scan(docs.limit(0)).count() == 0


def test_license_places_beyond_line_separators(spark):
    texts = [f"a b{c} c MIT License d{c} e cc by f" for c in ("\x85", "\u2028", "\u2029")] + [f"x {c} MIT License" for c in ("\x85", "\u2028", "\u2029")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(tuple(r) for r in ls.scan(docs).collect()) == [(i, *_brute(t)) for i, t in enumerate(texts)]


MIT = """Permission is hereby granted, free of
charge, to any person obtaining a copy
of this software and associated files"""
BSD = """# Redistribution and use in source and binary
# forms, with or without modification, are
# permitted provided that"""
ISC = """ * Permission to use, copy, modify, and/or distribute this
 * software for any purpose with or without
 * fee is hereby granted, provided"""
GPL = """// This program is free software: you can redistribute it and/or modify
// it under the terms of the GNU General Public License as published by
// the Free Software Foundation, either version %d of the License, or"""
APACHE = """ * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at"""


def test_wrapped_and_similar_notices(spark):
    texts = {
        "mit": MIT, "bsd": BSD, "isc": ISC, "gpl,gpl-3.0": GPL % 3, "gpl,gpl-2.0": GPL % 2, "apache,apache-2.0": APACHE,
        "": "Released under the BSD License, the terms of which are these", "cc-by": "Licensed under CC BY 4.0", "cc-by,cc-by-sa-4.0": "Licensed under CC BY-SA\n4.0",
        "cc-by,cc-by-nc-4.0": "Licensed\r\nunder\t CC BY-NC\n4.0", "bsd,isc,mit": f"{MIT}\n{ISC}\n{BSD}",
    }
    rows, want = [], []
    for i, (labels, t) in enumerate(texts.items()):
        for k, before in enumerate(("", "word " * 5, "word " * 1001, "word " * 50)):
            rows.append((10 * i + k, before + t + " after" * 40))
            want.append((10 * i + k, *_brute(rows[-1][1])))
            assert want[-1][6] == labels, (labels, want[-1])
    rows.append((None, MIT)), want.append((None, *_brute(MIT)))
    got = [tuple(r) for r in ls.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_random_mixes_of_template_words(spark):
    import random

    rnd = random.Random(6)
    words = sorted({w for _, t, _ in ls.TEMPLATES for w in ls.words_of(t)})
    texts = []
    for _ in range(400):
        _, t, _ = rnd.choice(ls.TEMPLATES)
        some = [w for w in ls.words_of(t) if rnd.random() < 0.93] + rnd.sample(words, 3)
        rnd.shuffle(some)
        texts.append(" ".join(["pad"] * rnd.randrange(40) + some + ["pad"] * rnd.randrange(40)))
    got = sorted(tuple(r) for r in ls.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    want = [(i, *_brute(t)) for i, t in enumerate(texts)]
    assert got == want and 50 < sum(bool(w[6]) for w in want) < 400
