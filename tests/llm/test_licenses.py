import re
import time

import pytest
import regex

from waymark.llm.licenses import CONFIDENCE, PHRASES, rules, scan_licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute_base(text):
    words = WORD.findall(low(text or ""))
    at = [(i, name) for phrase, name in PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), sorted({n for _, n in at})


def brute_detections(text):
    """All rules on the whole text, without keywords, and all pairs."""
    found = []
    for n, r in enumerate(rules()):
        found += [(m.start(), m.end(), r.priority, n) for m in regex.finditer(r.pattern, text or "", regex.A)]
    found.sort(key=lambda d: (d[0], -d[1], d[2], d[3]))
    first = [d for k, d in enumerate(found) if not any(e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2] for e in found[:k])]
    kept = [d for d in first if not any(e[2] < d[2] and d[0] <= e[0] and e[1] <= d[1] for e in first)]
    return [(s, e, rules()[n].label, p) for s, e, p, n in kept]


TEXTS = [
    None,
    "",
    "--- ...",
    "Licensed under the Apache License, Version 2.0.",
    "Released under the MIT License. mit license MIT\nLicense, and again the mit_license",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0.",
    "SPDX-License-Identifier: GPL-2.0-or-later\nhttps://opensource.org/licenses/BSD-3-Clause see the BSD license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and the GNU Lesser General Public License v2.1",
    "général GENERAL public license x general public licenses 日本 apache license",
    "Copyright 2020. All rights reserved. Released under the foo-license terms.",
    "mit license " * 3000,
    "no hint: apache foundation",
    "word " * 50_000 + "GNU Affero General Public License, version 3",
]


def test_at_least_two_hundred_rules_that_compile():
    assert len(rules()) >= 400 and sum(r.priority == 1 for r in rules()) >= 120 and all(regex.compile(r.pattern) for r in rules())


def test_against_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[3]), (3, TEXTS[3])]
    frame = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    got = scan_licenses(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        text = TEXTS[3 if r["id"] is None else r["id"]]
        n, places, first, last, base = brute_base(text)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (n, places, first, last, base), text[:50]
        kept = brute_detections(text)
        assert [tuple(d) for d in r["detections"]] == sorted(kept), (text or "")[:80]
        assert r["labels"] == sorted({*base, *(d[2] for d in kept)})
        assert r["score"] == max([CONFIDENCE[d[3]] for d in kept] + [0.8 if places else 0.0])
    assert scan_licenses(frame.limit(0)).count() == 0


def test_labels_of_common_lines(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    labels = {r["id"]: r["labels"] for r in scan_licenses(frame).collect()}
    assert labels[3] == ["apache", "apache-2.0"] and labels[6] == ["cc-by-nc-4.0"]
    assert labels[4] == ["mit"] and labels[5] == ["gpl", "gpl-3.0"] and labels[12] == []


SINGLE = {
    "released under the GNU GPL v3": ("gpl-3.0", 0.95),
    "GPL-3.0 or later": ("gpl-3.0", 0.6),
    "CC0 1.0 Universal": ("cc0-1.0", 0.6),
    "Distributed under Apache 2.0 terms": ("apache-2.0", 0.95),
    "published under MIT": ("mit", 0.95),
    "https://www.mozilla.org/MPL/2.0/": ("mpl-2.0", 1.0),
    "This software is provided 'as-is', without any express or implied warranty": ("zlib", 1.0),
    "All advertising materials mentioning features or use of this software must display": ("bsd-4-clause", 1.0),
    "Confidential and proprietary. Do not copy.": ("proprietary", 0.8),
    "This crate is Apache-2.0 and GPL-2.0": ("gpl-2.0", 0.6),
    "Released under the Expat License": ("mit", 0.95),
    "the X11 License": ("mit", 0.8),
    "available under Creative Commons Zero 1.0": ("cc0-1.0", 0.95),
    "licensed under CC-BY-4.0": ("cc-by-4.0", 0.95),
    "licensed under CC BY-NC-SA 4.0": ("cc-by-nc-sa-4.0", 0.95),
    "released under foo terms": ("unspecified", 0.3),
    "# SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0) OR MIT": ("mit", 1.0),
    "SPDX-License-Identifier: Apache-2.0 AND BSD-3-Clause": ("bsd-3-clause", 1.0),
}

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in
all copies or substantial portions of the Software.
"""
BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
"""
BSD_3 = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
NOTICE = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU {0} as published
by the Free Software Foundation{2} version {1} of the License, or
(at your option) any later version.
"""
CANONICAL = {
    "mit": MIT,
    "bsd-2-clause": BSD_2 + BSD_END,
    "bsd-3-clause": BSD_2 + BSD_3 + BSD_END,
    "apache-2.0": APACHE,
    "gpl-2.0-or-later": NOTICE.format("General Public License", "2", "; either"),
    "gpl-3.0-or-later": NOTICE.format("General Public License", "3", ", either"),
    "lgpl-2.1-or-later": NOTICE.format("Lesser General Public License", "2.1", "; either"),
    "lgpl-3.0-or-later": NOTICE.format("Lesser General Public License", "3", ", either"),
    "agpl-3.0-or-later": NOTICE.format("Affero General Public License", "3", ", either"),
    "gpl-2.0-only": "This program is free software; you can redistribute it and/or modify it under\nthe terms of the GNU General Public License version 2 as\npublished by the Free Software Foundation.",
    "gpl-2.0": "        GNU GENERAL PUBLIC LICENSE\n           Version 2, June 1991\n",
    "gpl-3.0": "        GNU GENERAL PUBLIC LICENSE\n           Version 3, 29 June 2007\n",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://example.com",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED",
    "zlib": "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable",
    "bsl-1.0": "Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying documentation",
    "unlicense": "This is free and unencumbered software released into the public\ndomain.",
    "epl-2.0": "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License v2.0",
    "cddl-1.0": "The contents of this file are subject to the terms of the\nCommon Development and Distribution License (the \"License\").",
    "ofl-1.1": "This Font Software is licensed under the SIL Open Font License,\nVersion 1.1.",
    "cc-by-sa-4.0": "Creative Commons Attribution-ShareAlike 4.0\nInternational Public License",
    "python-2.0": "PYTHON SOFTWARE FOUNDATION LICENSE\nVERSION 2",
    "bsl-1.1": "Business Source License\n1.1",
}


def commented(text, first, each, last=""):
    return "\n".join([*([first] if first else []), *(each + line for line in text.splitlines()), *([last] if last else [])])


def scanned(spark, texts):
    got = {r["id"]: r for r in scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()}
    return [got[i] for i in range(len(texts))]


def test_single_lines(spark):
    for (text, (label, score)), r in zip(SINGLE.items(), scanned(spark, list(SINGLE)), strict=True):
        assert label in r["labels"] and r["score"] == score, (text, r)
        assert [tuple(d) for d in r["detections"]] == sorted(brute_detections(text)), text
    assert {"gpl-2.0", "classpath-exception-2.0", "mit"} <= set(scanned(spark, [list(SINGLE)[-2]])[0]["labels"])
    plain = scanned(spark, ["plain words"])[0]
    assert plain["labels"] == [] and plain["score"] == 0


@pytest.mark.parametrize("style", [("", ""), ("", "# "), ("", "// "), ("/*", " * ", " */"), ("", ";; "), ("", "%    "), ("<!--", "  ", "-->"), ("", "> ")], ids=repr)
def test_canonical_texts(spark, style):
    """Of published texts and notices, wrapped and in comments, the label is found at the best priority."""
    texts = [commented(t, *style) for t in CANONICAL.values()]
    for label, text, r in zip(CANONICAL, texts, scanned(spark, texts), strict=True):
        assert (label, 1) in {(d["label"], d["priority"]) for d in r["detections"]} and r["score"] == 1, (label, r)
        others = {d["label"] for d in r["detections"] if d["priority"] == 1} - {label}
        assert not others, (label, others)
        assert [tuple(d) for d in r["detections"]] == sorted(brute_detections(text)), label


def test_words_are_in_all_matches(spark):
    texts = [*SINGLE, *CANONICAL.values(), *(t for t in TEXTS if t and len(t) < 500)]
    tried = 0
    for r in rules():
        for text in texts:
            for m in regex.finditer(r.pattern, text, regex.A):
                tried += 1
                around = text[: m.end()].lower() if r.keyword.startswith("spdx") else m[0].lower()  # which looks back
                assert r.keyword in around and all(k in m[0].lower() for k in r.needs), (r, m[0])
    assert tried > 100


def test_many_matches_in_one_text(spark):
    n = 30_000
    began = time.monotonic()
    got = scanned(spark, ["licensed under the MIT license. " * n])[0]
    assert got["n_base"] == n and got["labels"] == ["mit"] and time.monotonic() - began < 120
