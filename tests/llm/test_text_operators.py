"""Licences, personal data, spot signatures, latent retrieval, classifier."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from tests_llm_helpers import odd_rows

from stayledger.llm import decontaminate, licenses, pii, quality, spotsigs


# licences ----------------------------------------------------------------------------------


def brute_licences(text):
    if text is None or not re.search(licenses.TELLING, text, re.I):
        return "", "", ""
    ids = []
    for line in re.split("[\n\r]+", re.sub(licenses.SENTENCE_END, r"\1\n", text)):
        if re.search(licenses.TELLING, line, re.I):
            plain = re.sub(r"^[ .]+|[ .]+$", "", re.sub("[^a-z0-9.]+", " ", line.lower()))
            ids += [name for name, form in licenses.SENTENCES if re.search(form, plain)][:1]
    left, found = [*ids], []
    for licence, seq in licenses.RULES:
        k = 0
        while k + len(seq) <= len(left):
            if tuple(left[k : k + len(seq)]) == seq:
                left[k : k + len(seq)] = [None]
                found += [] if licence in found else [licence]
            k += 1
    return ",".join(ids), ",".join(found), ",".join(x for x in left if x)


def test_licences(spark, make_docs):
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. "
        "The above copyright notice and this permission notice shall be included in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED!'
    )
    texts = [
        mit, "Text.\nReleased under the MIT License.\nMore text", "Licensed under CC BY-NC 4.0. All rights reserved.",
        "This work is licensed under the GNU General Public License, version 3. Any later version.",
        "Licensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License.",
        "licensed under some terms", "Released under the MIT License. Released under the MIT License.",
        "Redistributions of source code must retain the above copyright notice", "SPDX-License-Identifier: MIT",
    ]
    rows = list(enumerate(texts, 100)) + odd_rows()
    got = licenses.license_digest(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((d, *brute_licences(t)) for d, t in rows), key=str)
    named = {r[0]: r[2] for r in got}
    assert [named[k] for k in (100, 101, 102, 103)] == ["MIT", "MIT", "CC-BY-NC-4.0,All-rights-reserved", "GPL-3.0-or-later"]
    again = licenses.scan(make_docs(rows).selectExpr("*", "7 AS licenses", "8 AS ids"))
    assert again.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "identifiers", "licenses", "left_over"]
    assert licenses.license_digest(make_docs(rows).where("false")).collect() == []


GPL_HEADER = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
MIT_TEXT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a
copy of this software and associated documentation files (the "Software"),
to deal in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in
all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY."""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""


def test_wrapped_licence_texts(spark, make_docs):
    """Standard texts, wrapped and commented, are recognised whole."""
    later = ", or\n(at your option) any later version"
    gpl2 = GPL_HEADER.replace("Foundation, either version 3", "Foundation; either version 2")
    cases = [
        (GPL_HEADER, "GPL-3.0-or-later"), (gpl2, "GPL-2.0-or-later"),
        (GPL_HEADER.replace(later, ""), "GPL-3.0-only"), (gpl2.replace(later, "").replace("either ", ""), "GPL-2.0-only"),
        (GPL_HEADER.replace("GNU G", "GNU Affero G"), "AGPL-3.0"), (GPL_HEADER.replace("GNU G", "GNU Lesser G"), "LGPL"),
        (MIT_TEXT, "MIT"), (BSD_TEXT, "BSD-3-Clause"), (BSD_TEXT[: BSD_TEXT.index("3. ")] + BSD_TEXT[BSD_TEXT.index("THIS") :], "BSD-2-Clause"),
        (APACHE_HEADER, "Apache-2.0"), ("GPL, you can redistribute it and/or\nmodify it under the terms of the GNU General Public License.", "GPL"),
        ("Licensed under the GNU General Public License version 2 or any later version.", "GPL-2.0-or-later"),
    ]
    marked = [(t if k == 0 else "\n".join(f"{mark} {line}".rstrip() for line in t.split("\n")), n) for t, n in cases for k, mark in enumerate(["", " *", "#"])]
    marked += [(t.replace("\n", "\r\n"), n) for t, n in cases]
    # joined lines still end where a form asks for the end of a line
    marked += [("All rights reserved\nSPDX-License-Identifier: MIT\nint x", "MIT,All-rights-reserved"), ("spdx license identifier mit x", "")]
    got = {r.doc_id: (r.licenses, r.left_over) for r in licenses.license_digest(make_docs([(k, t) for k, (t, _) in enumerate(marked)])).collect()}
    assert [got[k] for k in range(len(marked))] == [(n, "") for _, n in marked]


# personal data -----------------------------------------------------------------------------


def brute_spans(text):
    """The formats by plain expressions."""
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        twice = [x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(reversed(d))]
        if 16 <= len(d) <= 19 and sum(twice) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_formats_on_random_text():
    rng = random.Random(1)
    pieces = ["@", ".", "-", " ", "+", "a", "b.c", "1", "23", "255", "256", "4111 1111 1111 1111", "x@y.z", "é", "(", ")", "%", "007"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(14)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_formats_in_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "a@" * 150_000):
        pii.base_spans(text)


def test_pii(spark, make_docs):
    rows = [(20, "write to jane.doe@mail.example.com or +1 (303) 555-0100, ip 10.0.0.1"), (21, "card 4111-1111-1111-1111 é 4111111111111112")]
    rows += odd_rows()
    got = pii.pii_digest(make_docs(rows)).collect()
    assert len(got) == len(rows)
    wanted = []
    for doc, text in rows:
        spans = brute_spans(text)
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        wanted.append((doc, *[sum(x[0] == k for x in spans) for k in pii.KINDS], hashlib.sha256(said.encode()).hexdigest(), said))
    assert sorted((tuple(r) for r in got), key=str) == sorted(wanted, key=str)
    assert pii.pii_digest(make_docs(rows).where("false")).collect() == []


def test_patterns_discover_identifiers(spark, make_docs):
    """Cards after 'account number' teach the pattern; a bad checksum in its place is found, elsewhere not."""
    good = ["4111111111111111", "5500005555555559", "4012888888881881", "6011000990139424", "3530111333300000"]
    rows = [(k, f"paid by account number {c} today") for k, c in enumerate(good)]
    rows += [(50, "paid by account number AB123456 today"), (51, "we saw AB999999 somewhere"), (52, "build 20240101 failed")]
    got = {r.doc_id: r.spans for r in pii.pii_digest(make_docs(rows)).collect()}
    assert got[50] == "id:23:31" and got[51] == "" and got[52] == ""


def test_redact(spark, make_docs):
    rows = [(1, "mail a.b@c.de and 10.0.0.1!"), (2, None), (3, ""), (4, "é +1 (303) 555-0100 é"), (4, "nothing")]
    docs = make_docs(rows).selectExpr("*", "1 AS kind", "2 AS start", "3 AS row")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, "mail <email> and <ip>!"), (2, None), (3, ""), (4, "é <phone> é"), (4, "nothing")], key=str)
    with pytest.raises(ValueError):
        pii.redact(docs.withColumnRenamed("row", "_pii_row"))


# spot signatures ---------------------------------------------------------------------------


def test_spot_signatures(spark, make_docs, monkeypatch):
    monkeypatch.setattr(spotsigs, "GROUP_BYTES", 2000)  # many ranges, so that neighbours meet across them
    monkeypatch.setattr(spotsigs, "CHUNK", 300)
    rng = random.Random(3)
    vocabulary = "the of and house tree über ça it is run walk stone river for to".split()
    rows = [(rng.randrange(-50, 200), " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for _ in range(120)]
    rows = list(dict(rows).items()) + [(500, None), (501, ""), (None, "the end of it"), (502, "\U0001f600" * 9)]
    got = {r.doc_id: r for r in spotsigs.fingerprint_digest(make_docs(rows)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    texts = [t or "" for _, t in order]
    sets = lambda f: {f[k : k + 8] for k in range(0, len(f), 8)}
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    by_text = {}
    for k, (doc, _) in enumerate(order):
        row, text, after = got[doc], texts[k], texts[(k + 1) % len(texts)]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, changed, following = sets(row.fingerprint), sets(row.edited_fingerprint), sets(got[order[(k + 1) % len(order)][0]].fingerprint)
        assert row.near_edited == pytest.approx(like(own, changed))
        assert row.near_next == pytest.approx(like(own, following))
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
        assert by_text.setdefault(edited, row.edited_fingerprint) == row.edited_fingerprint
    assert spotsigs.fingerprint_digest(make_docs(rows).where("false")).collect() == []
    alone = spotsigs.fingerprint_digest(make_docs([(7, "the only one of them")])).collect()[0]
    assert alone.near_next == 1.0


def test_similar_fingerprints(spark, make_docs):
    rng = random.Random(9)
    rows = []
    for family in range(8):
        base = [rng.choice(["the", "of", "and", "to"]) if k % 3 == 0 else f"w{rng.randrange(500)}" for k in range(150)]
        for copy in range(6):
            own = list(base)
            for _ in range(rng.randrange(8)):
                own[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
            rows.append((100 + family * 10 + copy, " ".join(own)))
    rows += odd_rows()[:4]
    docs = make_docs(rows)
    prints = {r.doc_id: r.fingerprint for r in spotsigs.fingerprint_digest(docs).collect()}
    sets = {d: {f[k : k + 8] for k in range(0, len(f), 8)} for d, f in prints.items()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    key = lambda d: (d is None, d or 0)
    for a in sets:
        for b in sets:
            if key(a) < key(b) and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)), key=key)
                root[y] = x
    got = spotsigs.similar_documents(docs).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((d, len(sets[d]), find(d)) for d in sets), key=str)


# latent retrieval --------------------------------------------------------------------------


def test_common_length():
    rng = random.Random(4)
    for _ in range(200):
        a = [rng.randrange(5) for _ in range(rng.randrange(1, 30))]
        b = [rng.randrange(5) for _ in range(rng.randrange(30))]
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for k, y in enumerate(b):
                new.append(row[k] + 1 if x == y else max(row[k + 1], new[k]))
            row = new
        assert decontaminate.common_length(decontaminate._masks(a), len(a), b) == row[-1]


def leak_table(seed=6):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in ("tor", "mel", "is") for b in ("en", "u", "ra") for c in ("th", "ga", "lo", "ne")]
    rare = [f"rare{k}" for k in range(400)]
    sentence = lambda n, share: [rng.choice(rare) if rng.random() < share else rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(sentence(rng.randrange(15, 60), 0.4))) for k in range(20)]
    rows, wanted = [], set()
    for doc in range(200):
        text = sentence(rng.randrange(30, 300), 0.02)
        if doc % 5 == 0:
            item = rng.choice(items)
            inside = item[1].split()
            if doc % 10 == 0:  # a paraphrase: one word in eight replaced, not in the answer
                inside = [rng.choice(vocabulary) if rng.random() < 0.125 and k < len(inside) * 0.75 else w for k, w in enumerate(inside)]
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() if doc % 15 == 0 else w for w in inside]
            wanted.add((doc, item[0]))
        rows.append((doc, " ".join(text)))
    return rows, items, wanted


def test_leaks(spark, make_docs):
    rows, items, wanted = leak_table()
    bench = spark.createDataFrame([*items, (98, None), (99, "")], "item_id long, text string")
    docs = make_docs(rows + odd_rows())
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    assert len(got & wanted) >= 0.95 * len(wanted)
    assert got <= wanted
    exact = {(d, i) for d, i in wanted if d % 10}
    assert exact <= got
    wide = docs.selectExpr("*", "1 AS codes", "2 AS block")
    kept = decontaminate.drop_contaminated(wide, bench)
    assert kept.columns == wide.columns
    assert kept.count() == docs.count() - len({d for d, _ in got})


def test_leaks_without_input(spark, make_docs):
    bench = spark.createDataFrame([(1, "some words of an item to be found")], "item_id long, text string")
    docs = make_docs(odd_rows())
    assert decontaminate.leaks(docs, bench.where("false")).collect() == []
    assert decontaminate.leaks(docs.where("false"), bench).collect() == []
    assert decontaminate.drop_contaminated(docs, bench.where("false")).count() == docs.count()


# classifier --------------------------------------------------------------------------------


def fold(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 0


def quality_rows(n=400):
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in ("tor", "mel", "is", "qua") for b in ("enth", "uga", "rane", "lo")]
    rows, labels = [], []
    for doc in range(n):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(10, 80))]
        good = doc % 4 != 0
        if not good:
            own = [w.upper() + "!!" for w in own] if doc % 8 else [w + " |" for w in own]
        rows.append((doc, " ".join(own)))
        labels.append((doc, int(good), 0))
    return rows, labels


def test_quality(spark, make_docs):
    rows, labels = quality_rows()
    marks = spark.createDataFrame([*labels, (3, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")
    docs = make_docs(rows + [(1000, None), (1001, ""), (None, "tor mel")])
    first = {r.doc_id: r for r in quality.quality_digest(docs, marks).collect()}
    assert len(first) == len(rows) + 3 and all(0 <= r.score <= 1 for r in first.values())
    assert all(first[d].held_out == fold(d) for d, _ in rows)
    held = [(first[d].predicted, y) for d, y, _ in labels if fold(d)]
    assert np.mean([p == y for p, y in held]) > 0.95
    # labels of held-out rows do not matter
    flipped = spark.createDataFrame([(d, 1 - y if fold(d) else y, t) for d, y, t in labels] + [(5, 1, 0)], marks.schema)
    second = {r.doc_id: r.score for r in quality.quality_digest(docs, flipped).collect()}
    assert second == {d: r.score for d, r in first.items()}
    kept = quality.keep_good(docs.selectExpr("*", "1 AS vector", "2 AS score"), marks)
    assert kept.columns[-2:] == ["vector", "score"]
    assert kept.count() == sum(r.predicted for r in first.values())


def test_training_rows_are_bounded_under_a_hot_id(spark, make_docs, monkeypatch):
    """A labelled id on a third of the rows, with copies and with own texts, brings its share at most."""
    monkeypatch.setattr(quality, "SAMPLE", 100)
    hot = next(d for d in range(1, 400) if not fold(d))
    rows, labels = quality_rows(600)
    for extra in ([(hot, "tor mel")] * 300, [(hot, f"tor mel {k}") for k in range(300)]):
        docs = make_docs(rows + extra)
        marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        stored = quality.pooled(docs, ["doc_id"], quality.word_vectors(docs))
        found = quality.training_rows(stored, marks).collect()
        assert 30 <= len(found) <= 150 and not any(fold(r["_q_id"]) for r in found)
        assert len(found) == len({(r["_q_id"], bytes(r["_q_vector"])) for r in found})


def test_quality_without_labels(spark, make_docs):
    marks = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    docs = make_docs(odd_rows())
    assert {r.predicted for r in quality.quality_digest(docs, marks).collect()} == {1}
    assert {r.score for r in quality.quality_digest(docs, marks.where("false")).collect()} == {0.5}
    assert quality.quality_digest(docs.where("false"), marks).collect() == []
