from __future__ import annotations

import functools
import math
import re

from blockloom.llm import licenses

FILES = "path string, text string, license string, n int"


def vector(words, df, n):
    return {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in words}


@functools.lru_cache(maxsize=None)
def split(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return set(re.findall(r"[^\W_]+", lower)) - set(licenses.COMMON)


def agree(unit, template):
    numbers = {w for w in template if w.isdigit()}
    return numbers <= set(unit) and set(unit) & set(licenses.TELLING) == set(template) & set(licenses.TELLING)


def denied(unit):
    return re.search(licenses.DENIED, unit)


def brute(rows):
    files = {}
    for path, text in rows:
        files.setdefault(path or "", []).append(text or "")
    n = len(files)
    known = [(name, split(text)) for name, text in licenses.TEMPLATES]
    vocabulary = set().union(*(w for _, w in known))
    df = {w: sum(any(w in split(t) for t in texts) for texts in files.values()) for w in vocabulary}

    def is_license(path):
        return re.search(licenses.LICENSE_FILE, path.split("/")[-1])

    vectors = [(name, words, vector(words, df, n)) for name, words in known]
    own = {}
    for path, texts in files.items():
        units = [u for t in texts for u in t.split("\n") + ([t] if is_license(path) else [])]
        for unit in units:
            a = vector(split(unit), df, n)
            for name, words, b in vectors:
                if a.keys().isdisjoint(b) or denied(unit) or not agree(split(unit), words):
                    continue
                dot = sum(a[w] * b[w] for w in a.keys() & b)
                norm = math.sqrt(sum(x * x for x in a.values())) * math.sqrt(sum(x * x for x in b.values()))
                similarity = round(dot / norm, 9) if norm else 0
                if similarity >= licenses.LEAST:
                    own[path] = max(own.get(path, (0, "")), (similarity, name))
    out = []
    for path, _ in rows:
        path = path or ""
        if path in own:
            out.append((path, own[path][1], own[path][0], "own", None))
            continue
        parts = path.split("/")[:-1]
        for k in range(len(parts), -1, -1):
            here = "/".join(parts[:k])
            beside = [p for p in files if is_license(p) and "/".join(p.split("/")[:-1]) == here]
            near = [own[p] for p in beside if p in own]
            if near and not is_license(path):
                out.append((path, max(near)[1], max(near)[0], "inherited", here))
                break
            if beside:
                out.append((path, None, None, "unknown", here))
                break
        else:
            out.append((path, None, None, None, None))
    return sorted(out, key=repr)


def result(frame):
    return sorted(
        ((r.path, r.license, None if r.similarity is None else round(r.similarity, 9), r.origin, r.directory) for r in frame.collect()),
        key=repr,
    )


def test_against_brute_force(spark):
    mit = "Released under the MIT License."
    rows = [
        ("a/b/c/x.py", "import os\nprint(1)"), ("a/b/LICENSE", f"Copyright me\n{mit}\n"), ("a/COPYING", "Released under the GNU Affero General Public License version 3."),
        ("u/LICENSE", "Terms of our own"), ("u/f", ""), ("u/LICENSE-2", "Pay us"), ("a/b/LICENSE.own", "Terms of our own"),
        ("a/y.py", "# SPDX-License-Identifier: Apache-2.0\nx = 1"), ("a/z/q/r/deep.txt", "nothing"), ("top.txt", None), (None, "plain"),
        ("other/LICENSE.md", "Licensed under the Apache License, Version 2.0"), ("other/NOTICE", mit), ("other/f", "This license of mine is not known, friends"),
        ("other/f", "second row"), ("a/b/c/x.py", "import os\nprint(1)"), ("a/bb/f", ""), ("Ünï/f", "mit license released"),
    ]
    frame = spark.createDataFrame([(p, t, "x", 1) for p, t in rows], FILES)
    got = result(licenses.scan(frame))
    assert [(a, b, d, e) for a, b, _, d, e in got] == [(a, b, d, e) for a, b, _, d, e in brute(rows)]
    assert all(x[2] is None or abs(x[2] - y[2]) < 1e-6 for x, y in zip(got, brute(rows)))


def test_root_license_and_empty(spark):
    rows = [("LICENSE", "All rights reserved."), ("d/e/f.txt", "x " * 100_000)]
    frame = spark.createDataFrame([(p, t, "x", 1) for p, t in rows], FILES)
    assert [r[1] for r in result(licenses.scan(frame))] == ["LicenseRef-proprietary"] * 2
    assert licenses.scan(frame.limit(0)).collect() == []


def all_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.findall(r"[^\W_]+", lower) if w not in licenses.COMMON]


def cosines(rows, unit):
    """Similarity of a unit to each template, with the frequencies of all words."""
    files = {}
    for path, text in rows:
        files.setdefault(path or "", set()).update(all_words(text))

    def weigh(text):
        words = all_words(text)
        return {w: words.count(w) * (math.log((1 + len(files)) / (1 + sum(w in f for f in files.values()))) + 1) for w in set(words)}

    a, out = weigh(unit), {}
    for name, text in licenses.TEMPLATES:
        if denied(unit) or not agree(all_words(unit), all_words(text)):
            continue
        b = weigh(text)
        dot = sum(a[w] * b[w] for w in a.keys() & b)
        norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        out[name] = max(out.get(name, 0), dot / norm)
    return out


def test_frequencies_of_all_words_count(spark):
    gpl = "This thing here is licensed under the GNU General Public License, version 3."
    rare = "Zyx wvu tsr qpo nml kji licensed under the GNU General Public License"
    rows = [(f"p/{k}.txt", f"thing here number{k} thing") for k in range(600)]
    rows += [("a/gpl.txt", gpl), ("a/twice.txt", f"x {gpl}\n{gpl}\n{gpl}"), ("a/rare.txt", rare), ("a/same.txt", "thing"), ("a/same.txt", "here thing")]
    rows += [("a/often.txt", f"mit {gpl} thing thing thing here"), ("a/gpl.txt", "one more row of this path"), (None, "here"), (None, None)]
    got = {r[0]: r[1:3] for r in result(licenses.scan(spark.createDataFrame(rows, "path string, text string")))}
    want = {}
    for path, text in rows:
        for unit in (text or "").split("\n") if path and path.startswith("a/") else []:
            similarity, name = max((s, name) for name, s in cosines(rows, unit).items())
            if similarity >= licenses.LEAST:
                want[path] = max(want.get(path, (0, "")), (similarity, name))
    assert {p for p, v in got.items() if v[0]} == set(want) >= {"a/gpl.txt", "a/twice.txt"}
    assert "a/rare.txt" not in want
    for path, (similarity, name) in want.items():
        assert got[path][0] == name and abs(got[path][1] - similarity) < 1e-6


def test_licence_lines_of_the_documents_match_their_own(spark):
    lines = {
        "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-or-later",
        "All rights reserved.": "LicenseRef-proprietary",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    }
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    files = documents.selectExpr("concat('p/', doc_id, '.txt') AS path", "text").collect()
    want = {r.path: lines[u] for r in files for u in (r.text or "").split("\n") if u in lines}
    marks = re.compile("licen[cs]e|rights reserved|creative commons|public domain|SPDX", re.I)
    others = [u for r in files for u in (r.text or "").split("\n") if len(u) < 200 and marks.search(u) and u not in lines]
    got = {r[0]: r[1] for r in result(licenses.scan(spark.createDataFrame(files))) if r[1]}
    assert others == [] and got == want and set(want.values()) == set(lines.values())


def test_commons_variants(spark):
    forms = ("{s} 4.0", "Licensed under CC {s} 4.0", "This work is licensed under the Creative Commons {l} 4.0 International License.", "SPDX-License-Identifier: CC-{s}-4.0")
    rows = [(f"{s}/{k}", form.format(s=f"CC {s}" if k == 0 else s, l=long)) for s, long in licenses.COMMONS.items() for k, form in enumerate(forms)]
    got = result(licenses.scan(spark.createDataFrame(rows + [("x", "nothing here")], "path string, text string")))
    assert [(r[0], r[1]) for r in got if r[1]] == sorted((p, f"CC-{p.split('/')[0]}-4.0") for p, _ in rows)


def test_families_and_versions(spark):
    lines = {
        "Released under the GNU General Public License version 2.": "GPL-2.0-or-later",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0-or-later",
        "Released under the GNU Affero General Public License version 3.": "AGPL-3.0-or-later",
        "Released under the GNU Lesser General Public License version 2.1.": "LGPL-2.1-or-later",
        "Released under the GNU Lesser General Public License version 3.": "LGPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0-only",
        "// SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1-or-later",
        "SPDX-License-Identifier: MPL-2.0": "MPL-2.0",
        "Released under the BSD 2-Clause License.": "BSD-2-Clause",
        "Released under the BSD 3-Clause License.": "BSD-3-Clause",
        "Licensed under CC BY-NC 3.0.": "CC-BY-NC-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Licensed under CC BY-NC 2.5.": None,
        "This program is not released under the MIT License.": None,
        "Released under the Apache License 1.1.": None,
        "Redistribution and use in source and binary forms, with or without modification, are permitted": None,
    }
    rows = [(f"d{k}/f", line) for k, line in enumerate(lines)]
    got = {r[0]: r[1] for r in result(licenses.scan(spark.createDataFrame(rows, "path string, text string")))}
    assert {line: got[path] for path, line in rows} == lines


def test_unknown_terms_stop_inheritance(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/LICENSE", "Terms of our own"), ("a/b/c/f", "x"), ("a/f", "x"), ("f", "x")]
    got = result(licenses.scan(spark.createDataFrame(rows, "path string, text string")))
    assert [(r[0], r[1], r[3], r[4]) for r in got] == [
        ("a/LICENSE", "MIT", "own", None),
        ("a/b/LICENSE", None, "unknown", "a/b"),
        ("a/b/c/f", None, "unknown", "a/b"),
        ("a/f", "MIT", "inherited", "a"),
        ("f", None, None, None),
    ]
