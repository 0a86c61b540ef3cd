"""Rules, licences, language model, resampling, decontamination."""

import hashlib
import math
import random
import re
import textwrap
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.llm import decontam, licenses, lm, queries, resample, rules

SF_SMALL = "/root/testdata/sf0.001"

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    got = sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
    res = con.execute(queries.ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    idx = sorted(range(len(cols)), key=cols.__getitem__)
    assert sorted(cols) == sorted(df.columns)
    assert got == sorted(tuple(str(r[i]) for i in idx) for r in res.fetchall())


def test_ledger_policies_and_ablation(odd, empty):
    led = rules.ledger(odd)
    rows = led.collect()
    assert len(rows) == odd.count()
    few = [r for r in rows if r.n_words < 50]
    assert all(r.failed_bits & 1 for r in few) and any(r.doc_id is None for r in rows)
    spam = next(r for r in rows if r.doc_id == -3)
    assert spam.n_repeat_words == 60 and spam.failed_bits & 2
    total = rules.ablation(led).collect()
    kept = led.where(rules.verdict()).count()
    for r in total:
        without = rules.Policy(9, tuple(x for x in rules.POLICY.rules if x != r.rule))
        assert r.kept_without == led.where(rules.verdict(without)).count() and r.kept_without - r.only_this == kept
    out = rules.apply_policy(odd)
    assert out.columns == odd.columns and out.count() == kept
    assert rules.ledger(empty).count() == 0 and rules.apply_policy(empty).count() == 0


def test_licences(spark, odd, empty):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
           '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
           "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
           "subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or "
           'substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
           "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")
    swapped = "\n".join(reversed(mit.split("\n")))
    rows = [(1, mit), (2, swapped), (3, "Some text. Licensed under CC BY-NC 4.0.\nMore."), (4, "All rights reserved."), (5, "MIT"),
            (6, "Released under the MIT License. Licensed under the Apache License, Version 2.0.")]
    got = {r.doc_id: (r.license, r.licenses) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1][0] == "MIT" and got[2][0] is None and got[3][0] == "CC-BY-NC-4.0" and got[4][0] == "all-rights-reserved"
    assert got[5] == (None, []) and got[6] == ("MIT", ["MIT", "Apache-2.0"])
    scan = licenses.license_scan(odd)
    assert scan.count() == odd.count() and scan.where("license is not null").count() == 0
    assert licenses.license_scan(empty).count() == 0
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


MIT = """MIT License
Copyright (c) 2021 Somebody
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM."""
BSD = """Copyright (c) 2020, Somebody. All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
APACHE = """Copyright 2019 The Authors
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY."""
GPL2 = GPL.replace("software:", "software;").replace("version 3", "version 2")


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// ", "-- ", ";; ", "! "])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_licences_wrapped(spark, mark, end):
    texts = {"MIT": MIT, "BSD-2-Clause": BSD, "BSD-3-Clause": BSD + BSD_NAME, "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL, "GPL-2.0-or-later": GPL2}
    rows = []
    for name, text in texts.items():
        for width in (24, 50, 72, 79):
            lines = [x for t in text.split("\n") for x in textwrap.wrap(t, width) or [""]]
            rows.append((name, f"some code(){end}{end}" + end.join((mark + x).rstrip() for x in lines) + f"{end}{end}more code()"))
    got = licenses.license_scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert [(r.doc_id, r.license) for r in got] == [(n, n) for n, _ in rows]


def test_licence_sentences_keep_to_lines_and_paragraphs(spark):
    rows = [(1, "Released under the\n\nMIT License."), (2, "Released under the. MIT License."), (3, "It is released under the\nMIT License."),
            (4, "Released under the\nMIT License of old."), (5, "Heading\nReleased under\n# the MIT License\nmore words")]
    got = {r.doc_id: r.license for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: None, 2: None, 3: None, 4: None, 5: "MIT"}


def brute_base(rows):
    texts = [WORDS.findall((t or "").translate(LOW)) + [None] for _, t in rows]
    train = [zlib.crc32(b"" if i is None else str(i).encode()) % 10 != 0 for i, _ in rows]
    c = Counter(w for x, ok in zip(texts, train) if ok for w in x)
    n, v = sum(c.values()), len(c)
    return [(i, not ok, len(x), sum(c[w] > 0 for w in x), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x))
            for (i, _), x, ok in zip(rows, texts, train)]


@pytest.mark.parametrize("head", [4, 1 << 16])
def test_language_model(odd, empty, vocab, head):
    path = vocab("piece_bpe_32k.model")
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = sorted(lm.score(odd, path, head_words=head).collect(), key=lambda r: (str(r.doc_id), r.base_score))
    want = sorted(brute_base(rows), key=lambda x: (str(x[0]), x[5]))
    for g, w in zip(got, want, strict=True):
        assert tuple(g)[:5] == w[:5] and abs(g.base_score - w[5]) <= 1e-9 * abs(w[5]) + 1e-9
        assert g.score < 0 and math.isfinite(g.score)
    assert lm.score(empty, path).count() == 0


def test_lattice_sums_all_segmentations(vocab):
    path = vocab("piece_bpe_32k.model")
    sp = lm._processor(path)
    counts = np.ones(sp.get_piece_size())
    model = lm.Lattice(path, counts, 10)
    logp = dict(zip(model.keys.tolist(), model.logp.tolist()))

    def brute(raw):  # every segmentation, one by one
        h = lm.prefix_hash(lm.byte_table(11)[np.frombuffer(raw, np.uint8)])
        piece = lambda a, b: logp.get(int(lm.range_hash(*h, np.array([a]), np.array([b]))[0]))
        total = 0.0
        for cuts in range(1 << (len(raw) - 1)):
            at = [0, *[k + 1 for k in range(len(raw) - 1) if cuts >> k & 1], len(raw)]
            ps = [piece(a, b) for a, b in zip(at, at[1:])]
            if None not in ps:
                total += math.exp(sum(ps))
        return math.log(total)

    words = ["the", "abba", "ée", "a", "zzzzzzzz"]
    for w, x in zip(words, model.words([w.encode() for w in words])):
        assert abs(x - brute("▁".encode() + w.encode())) < 1e-9


def test_scores_tell_text_from_noise(spark, vocab):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    noise = docs.withColumn("doc_id", F.col("doc_id") + 10_000).withColumn("text", F.reverse("text"))
    out = lm.score(docs.unionAll(noise), vocab("piece_bpe_32k.model")).where("held_out AND n_tokens > 20")
    mean = {r.noise: r.m for r in out.groupBy((F.col("doc_id") >= 10_000).alias("noise")).agg(F.avg(F.col("score") / F.col("n_tokens")).alias("m")).collect()}
    assert mean[False] > mean[True]


def test_resampling_finds_good_documents(spark, odd, empty):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.col("doc_id") % 2 == 0  # learned on one half of the labels, judged on the other
    out = resample.resample(docs, labels.where(fold))
    held = out.join(labels.where(~fold), "doc_id")
    right = held.where(F.col("selected") == (F.col("quality") == 1)).count() / held.count()
    assert right > 0.85
    again = resample.resample(docs.repartition(4), labels.where(fold))
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
    lab = spark.createDataFrame([(1, 1), (5, 0), (None, 1)], "doc_id bigint, quality int")
    rows = resample.resample(odd, lab, share=0.5).collect()
    assert len(rows) == odd.count() and not any(r.selected for r in rows if r.n_grams == 0)
    assert resample.resample(empty, lab).count() == 0
    none = resample.resample(odd, lab.where("1 = 0"), share=1.0).collect()
    assert {r.log_weight for r in none} <= {0.0, None}


def test_toxic_documents_get_lower_weights(spark):
    sf = "/root/testdata/sf0.1"  # most of its toxic documents have quality 1
    out = queries.op9_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("quality = 1")
    mean = {r.toxic: r for r in out.groupBy("toxic").agg(F.avg("log_weight").alias("w"), F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert mean[1].w < mean[0].w - 0.01 and mean[1].kept < 0.3 and mean[0].kept > 0.93, mean


def test_toxic_documents_of_unseen_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    out = resample.resample(docs, labels.where(fold), good="quality = 1 AND coalesce(toxic, 0) = 0", unwanted="toxic = 1")
    held = out.join(labels.where(~fold), "doc_id").where("quality = 1").groupBy("toxic").agg(F.avg(F.col("selected").cast("int")).alias("kept"))
    kept = {r.toxic: r.kept for r in held.collect()}
    assert kept[1] < 0.35 and kept[0] > 0.92, kept


def test_weights_like_brute_force(spark):
    """Counts, ratios and penalties by plain loops over the same n-grams."""
    import pyarrow as pa

    from tagweave.llm._text import blocks

    texts = ["Good words, good WORDS!", "bad bad words", "good day", "", None, "awful bad day; bad", "a day of words and words", "GOOD"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1, 0), (2, 1, 0), (5, 1, 1), (1, 0, 1), (99, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in resample.resample(docs, labels, good="quality = 1 AND toxic = 0", unwanted="toxic = 1", share=0.5).collect()}
    grams = []
    for t in texts:
        ((_, _, data, offsets),) = blocks(pa.array([t], pa.string()))
        grams.append(resample.ngrams(data, offsets)[1].tolist())
    good, bad, raw = (Counter(g for k in ks for g in grams[k]) for ks in ((0, 2), (1, 5), range(len(texts))))
    n = resample.N_BUCKETS
    logp = lambda c, g: math.log((c[g] + 1) / (c.total() + n))
    for k, gs in enumerate(grams):
        assert got[k].n_grams == len(gs)
        if gs:
            mean = sum(logp(good, g) - logp(raw, g) for g in gs) / len(gs)
            off = sum(max(0, logp(bad, g) - logp(good, g) - resample.MARGIN) for g in gs) * resample.PENALTY
            assert abs(got[k].log_weight - (mean - off)) < 1e-9
        else:
            assert got[k].log_weight is None and not got[k].selected
    assert sum(r.selected for r in got.values()) == 4


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(1)
    keys = [float(x) for x in rng.normal(size=500)] + [2.5] * 7 + [None] * 3
    df = spark.createDataFrame(list(enumerate(keys)), "id bigint, key double")
    for k in (0, 1, 5, 10, 250, 507, 600):
        got = {r.id for r in resample.top_k(df, k, bins=8).where("selected").collect()}
        want = {i for i, _ in sorted(((i, x) for i, x in enumerate(keys) if x is not None), key=lambda p: (-p[1], p[0]))[:k]}
        assert got == want, k


def brute_hits(docs, items, n=10):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    norm = lambda t: cut.findall((t or "").translate(LOW))
    wins = [(k, {tuple(w[p:p + min(n, len(w))]) for p in range(len(w) - min(n, len(w)) + 1)}) for k, w in ((k, norm(t)) for k, t in items) if w]
    out = []
    for i, t in docs:
        w, hit, found = norm(t), set(), set()
        for k, ws in wins:
            size = len(next(iter(ws)))
            for p in range(len(w) - size + 1):
                if tuple(w[p:p + size]) in ws:
                    hit.update(range(p, p + size))
                    found.add(str(k))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [20, 1 << 18])
def test_decontamination(spark, odd, block):
    import random

    rnd = random.Random(7)
    words = ["a", "b", "c", "D2", "é"]
    items = [(k, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 5, 9, 10, 11, 14, 30])))) for k in range(25)]
    items += [(90, None), (91, ""), (92, "... !"), (93, items[3][1]), (94, "brown fox jumps over the lazy dog and runs far away")]
    docs = [(k, " -- ".join(rnd.choice(words) for _ in range(rnd.randint(0, 80)))) for k in range(40)]
    docs += [(100 + k, f"Q {t} Z. {t.upper() if t else ''}") for k, t in items]
    b = spark.createDataFrame(items, "item_id bigint, text string")
    for rows, df in ((docs, spark.createDataFrame(docs, "doc_id bigint, text string")),
                     ([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()], odd)):
        found = decontam.scan(df, b, max_block_words=block)
        got = found.select("doc_id", "__n_words", "__n_hit", F.size("__items"), F.sha2(F.array_join("__items", ","), 256)).collect()
        assert sorted(map(tuple, got), key=str) == brute_hits(rows, items)


def test_spans_are_cut_and_limits_hold(spark, odd, empty):
    item = "one two three four five six seven eight nine ten"
    b = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    pad = " ".join(f"p{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"{pad}. {item}; {pad}"), (2, item), (3, pad), (4, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in decontam.decontaminate(docs, b).collect()}
    assert got == {1: f"{pad}. ; {pad}", 3: pad, 4: None}
    kept = {r.doc_id for r in decontam.decontaminate(docs, b, max_span=10, max_coverage=1.0).collect()}
    assert kept == {1, 2, 3, 4}
    assert decontam.decontaminate(empty, b).columns == odd.columns
    assert decontam.scan(odd, b.where("1 = 0")).where("__n_hit > 0").count() == 0


def test_top_level_names():
    assert [k.split("_")[0] for k in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_long_words_like_short_ones(vocab, monkeypatch):
    path = vocab("piece_bpe_32k.model")
    counts = np.ones(lm._processor(path).get_piece_size())
    model = lm.Lattice(path, counts, 10)
    rnd = random.Random(6)
    words = ["".join(rnd.choice("abcdeé") for _ in range(n)).encode() for n in (1, 30, 200, 700)] + [b"x" * 300, "日本語".encode() * 40]
    monkeypatch.setattr(lm, "LONG_WORD", 1 << 30)
    want = model.words(words)
    monkeypatch.setattr(lm, "LONG_WORD", 0)
    monkeypatch.setattr(lm, "_POSITIONS", 64)
    assert np.allclose(model.words(words), want, rtol=1e-12, atol=1e-9)


def test_a_very_long_word_takes_seconds(vocab):
    import time

    path = vocab("piece_bpe_32k.model")
    model = lm.Lattice(path, np.ones(lm._processor(path).get_piece_size()), 10)
    rnd = random.Random(7)
    word = "".join(rnd.choice("ABCDEFghijklmnop0123456789+/") for _ in range(100_000)).encode()
    began = time.time()
    (score,) = model.words([word])
    assert np.isfinite(score) and time.time() - began < 20


def test_automata_come_from_tasks(spark):
    """Many blocks, a window that very many items share, an item over the limit."""
    shared = "a b c d e f g h i j"
    items = [(f"i{k:04d}", shared + f" x{k}") for k in range(500)] + [("long", " ".join(f"w{k}" for k in range(300))), ("none", " . ")]
    table = spark.createDataFrame(items, "item_id string, text string").repartition(3)
    paths = decontam.write_blocks(table, max_words=100)
    assert len(paths) > 40 and len(set(paths)) == len(paths)
    got = [decontam._load(p) for p in paths]
    assert sorted(i for b in got for i in b.ids) == sorted(i for i, _ in items if i != "none")
    docs = spark.createDataFrame([(1, f"{shared} y {shared} z {shared}"), (2, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 b"), (3, "a b c")], "doc_id bigint, text string")
    rows = {r.doc_id: (r["__n_hit"], len(r["__items"])) for r in decontam.scan(docs, table, max_block_words=100).collect()}
    assert rows == {1: (30, 500), 2: (10, 1), 3: (0, 0)}
