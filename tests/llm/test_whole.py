import random
import textwrap

import corpus_pipeline
import numpy as np
from tessaphon.llm import ann, licenses, linededup


def test_walk_goes_on_until_no_node_is_open(spark):
    n = 40
    x = np.stack([np.cos(np.arange(n) / n), np.sin(np.arange(n) / n)], 1)
    near = [[j for j in (i - 1, i + 1) if 0 <= j < n] for i in range(n)]
    nodes = spark.createDataFrame([(i, ann._f8(v), ann._f4(v)) for i, v in enumerate(x)], "node long, vec binary, gvec binary")
    graph = spark.createDataFrame([(i, ann._i8(near[i]), ann._f4([float(x[i] @ x[j]) for j in near[i]])) for i in range(n)], "node long, ids binary, scores binary")
    queries = spark.createDataFrame([(7, ann._f8(x[0]), n - 1)], "q long, vec binary, entry long")
    found = ann.walk(queries, nodes, graph).collect()[0]
    assert list(found.ids) == list(range(n)) and np.allclose(found.scores, x @ x[0])


def test_search_grows_with_the_table():
    small, large = ann.budget(500), ann.budget(40 * ann.SMALL)
    assert small == (ann.LIST, ann.EXPAND, ann.LONGEST) and all(b > 6 * a for a, b in zip(small, large, strict=True))


def test_short_equal_lines_go(spark):
    long = "a line that is longer than the limit"
    rows = [(1, "By To.\nLes.\n\nBy To.\n \n" + long), (2, "Les.\n\n梦の国。\nLes!\n \n梦の国。"), (3, long + "\nNew."), (None, "Les."), (4, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {x.doc_id: x.text for x in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert got == {1: "By To.\nLes.\n\n \n" + long, 2: "\n梦の国。\nLes!\n ", 3: "New.", None: "Les.", 4: None}


APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""


def found_licenses(spark, texts):
    return [x.licenses for x in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)).orderBy("doc_id").collect()]


def test_licenses_wrapped_and_unwrapped(spark):
    texts, want = [], []
    for text, name in ((APACHE, "Apache-2.0"), (MIT, "MIT"), (GPL, "GPL-3.0-or-later")):
        wrapped = "\n\n".join(textwrap.fill(p, 70) for p in text.split("\n\n"))
        texts += [text, wrapped, wrapped.replace("\n", "\r\n"), *(textwrap.indent(wrapped, mark, lambda _: True) for mark in (" * ", "// ", "# ", "-- "))]
        want += [name] * 7
    texts += ["This project is licensed under the MIT License.", "The mit license is short.", "Nothing here."]
    assert found_licenses(spark, texts) == [*want, "MIT", "", ""]


def test_every_licence_rule_fires_and_every_identifier_is_used(spark):
    rules, table = (*licenses.RULES, *licenses.MORE_RULES), licenses.everything()
    assert {name for _, name in table} == {x for _, wanted in rules for x in wanted}
    forms = {name: sentence for sentence, name in table}
    texts = [". ".join(forms[x] for x in wanted) + "." for _, wanted in rules]
    assert found_licenses(spark, texts) == [name for name, _ in rules]
    assert len({x for x, _ in table}) == len(table)
    ids = [x.sentence_ids for x in licenses.scan(spark.createDataFrame([(k, f"Foo {x} bar. Foo") for k, (x, _) in enumerate(table)], "doc_id long, text string").coalesce(1)).orderBy("doc_id").collect()]
    assert ids == ["" if name in licenses.WHOLE else name for _, name in table]


def test_licence_names(spark):
    texts = ["SPDX-License-Identifier: GPL-2.0-or-later", "Licensed under the GNU AGPL v3.0.", "Released under the GNU Lesser General Public License, version 2.1 or later.", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.", "licensed under the BSD license"]
    assert found_licenses(spark, texts) == ["GPL-2.0-or-later", "AGPL-3.0-only", "LGPL-2.1-or-later", "MPL-2.0", "BSD"]


def _edits_of(x, n, r, letters):
    x = list(x)
    for _ in range(n):
        i = r.randrange(len(x))
        x[i : i + r.randrange(2)] = r.choice(letters) if r.random() < 0.7 else ""
    return "".join(x)


def _near(a, b, most=2):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i, *(min(row[j] + (x != y), row[j + 1] + 1) for j, y in enumerate(b))]
        for j in range(1, len(row)):
            row[j] = min(row[j], row[j - 1] + 1)
    return row[-1] <= most


def test_frequent_keys_against_brute_force(spark, monkeypatch):
    r = random.Random(11)
    lines = []
    for letters, n, size in (("ab", 60, 22), ("abcdefgh ", 120, 40)):
        base = "".join(r.choice(letters) for _ in range(size))
        lines += [_edits_of(base, r.randrange(9), r, letters) for _ in range(n)]
    lines += [f"page number {r.randrange(10 ** r.randrange(1, 7))} of {r.randrange(300)}" for _ in range(60)]
    r.shuffle(lines)
    monkeypatch.setattr(linededup, "FREQUENT", 6)
    docs = [(k, "\n".join(lines[4 * k : 4 * k + 4])) for k in range(len(lines) // 4)]
    got = {x.doc_id: x.text for x in linededup.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    seen = []
    for k, t in docs:
        stay = []
        for x in t.split("\n"):
            if len(x) < 20 or not any(abs(len(x) - len(y)) <= 2 and _near(x, y) for y in seen):
                stay.append(x)
            if len(x) >= 20:
                seen.append(x)
        assert got[k] == "\n".join(stay)


def test_rows_of_a_large_cluster_stay_in_proportion(spark, monkeypatch):
    r, most, cut = random.Random(5), {}, linededup.cut
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9))) for _ in range(60)]

    def variant():
        own = list(words)
        for _ in range(r.randrange(1, 6)):
            own[r.randrange(60)] = "".join(r.choice("abcdefghij") for _ in range(r.randrange(4, 9)))
        return " ".join(own)

    def counted(df, tag):
        out = cut(df, tag)
        most[tag] = max(most.get(tag, 0), out.count())
        return out

    monkeypatch.setattr(linededup, "cut", counted)
    docs = [(-1, " ".join(words)), *((k, variant()) for k in range(2000)), (2001, " ".join(words) + "x")]
    got = {x.doc_id: x.text for x in linededup.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[-1] == " ".join(words) and got[2001] == ""
    # All pairs would be two million, and each of them under many keys.
    assert max(most.values()) <= 80 * len(docs), most


def test_lists_of_many_nodes_are_cut_down_at_once():
    """As each node's list by itself, with copies, ties, own ids and lists of no entries."""
    r = np.random.default_rng(4)
    lists = [[(r.integers(0, 30, k), r.integers(0, 9, k).astype("<f4") / 8, bool(r.integers(2))) for k in r.integers(0, 12, m)] for m in r.integers(0, 6, 300)]
    own = r.integers(0, 30, len(lists))
    flat = [(row, i, s, old) for row, one in enumerate(lists) for ids, scores, old in one for i, s in zip(ids, scores, strict=True)]
    row, ids, scores, old = (np.array(c, t) for c, t in zip(zip(*flat, strict=True), (np.int16, np.int64, np.float32, bool), strict=True))
    near, best, kept, new = ann._best_of_rows(row, ids, scores, old, own, 7)
    ends = np.cumsum(kept)
    for k, one in enumerate(lists):
        wanted = ann._best(np.concatenate([np.empty(0, np.int64), *(i for i, _, _ in one)]), np.concatenate([np.empty(0, np.float32), *(s for _, s, _ in one)]), 7, own[k])
        known = np.concatenate([np.empty(0, np.int64), *(i for i, _, o in one if o)])
        part = slice(ends[k] - kept[k], ends[k])
        assert near[part].tolist() == wanted[0].tolist() and best[part].tolist() == wanted[1].tolist() and new[k] == np.count_nonzero(~np.isin(wanted[0], known))
    column = ann._packed(near, kept)
    values, sizes = ann._flat(column.slice(5, 100), "<i8")
    assert sizes.tolist() == kept[5:105].tolist() and values.tolist() == near[ends[4] : ends[104]].tolist()
    assert ann._flat(column.slice(0, 0), "<i8")[0].tolist() == []


def test_search_takes_as_many_stages_however_often_lists_change(spark):
    """Descent and walk run within tasks: their rounds add no stage."""
    r = np.random.default_rng(5)
    df = spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(r.standard_normal((2500, 8)))], "vec_id long, embedding array<double>")
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("rounds", "rounds")
    assert ann.search(df, 20, 20).count() == 125 * 20
    stages = {s for job in tracker.getJobIdsForGroup("rounds") for s in tracker.getJobInfo(job).stageIds if tracker.getStageInfo(s) is not None}
    context.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(stages) <= 120


def test_a_block_is_walked_like_brute_force():
    r = np.random.default_rng(6)
    x = r.standard_normal((2500, 16))
    ids, v = np.arange(0, 7500, 3), r.standard_normal((40, 16))
    near, found = ann.neighbours(x.astype(np.float32), ann.DEGREE, ann.TREES, 256, ann.CONVERGED)
    assert (np.diff(found, axis=1) <= 0).all() and (near != np.arange(2500)[:, None]).all()
    hits = 0
    for query, (got, scores) in zip(v, ann.through(v, np.full(40, 1), ids, near, x), strict=True):
        assert np.allclose(scores, x[got // 3] @ query) and len(set(got.tolist())) == len(got)
        hits += len(set(got[:20].tolist()) & set((np.argsort(-(x @ query))[:20] * 3).tolist()))
    assert hits >= 0.95 * 800
