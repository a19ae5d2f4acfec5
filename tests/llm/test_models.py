"""Operators 3, 5, 6, 7, 8 and 10: brute force, round trips and held-out accuracy."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from noteflow.llm import decontam, langid, licences, lm, packing, quality
from noteflow.llm.util import crc_mod, table

SF = "/root/testdata/sf0.001"
SF_MORE = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- 3

def test_language_held_out_accuracy(spark):
    got = langid.op3_language_bitmask(spark, SF_MORE).join(table(spark, SF_MORE, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and held
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_texts(spark, frame):
    labelled = spark.createDataFrame([(1, "der die das und nicht", "de"), (2, "der die das oder", "de"), (3, "the and of this that", "en"),
                                      (4, "the and of these", "en"), (5, None, "fr"), (6, "rien", None)], "doc_id long, text string, lang string")
    model = langid.fit_filters(labelled, "text", "lang")
    assert model["langs"] == ["de", "en"]                  # fr has no text to learn from
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "the"), (5, "DER und DIE"), (6, "漢字"), (None, "this of that"), (4, "the")],
                                "doc_id long, text string")
    got = [tuple(r) for r in langid.identify(odd, model).collect()]
    by = collections.defaultdict(list)
    for i, lang, score in got:
        by[i].append((lang, score))
    assert [by[i][0] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert by[4][0][0] == "en" and len(by[4]) == 2 and by[5][0][0] == "de" and by[None][0][0] == "en"
    assert by[6][0] == ("de", 0.0) or by[6][0] == ("en", 0.0)
    assert langid.identify(frame, model).count() == frame.count()


def test_language_without_labels(spark, empty, frame):
    model = langid.fit_filters(empty, "text", "lang")
    assert {r["lang_pred"] for r in langid.identify(frame, model).collect()} == {"und"}
    assert langid.identify(empty, model).count() == 0


def test_trigrams_of_long_texts_are_whole(monkeypatch):
    text = "abc def " * 50
    whole = np.concatenate([g for g, _ in langid.trigrams([text, "x"])])
    monkeypatch.setattr(langid, "BLOCK_CHARS", 37)
    parts = [(g, r) for g, r in langid.trigrams([text, "x"])]
    assert len(parts) > 5 and sorted(np.concatenate([g for g, _ in parts]).tolist()) == sorted(whole.tolist())


# ---------------------------------------------------------------- 5

def test_tokens_equal_the_tokenizer_library(documents):
    from tokenizers import Tokenizer
    path, pattern = packing.tokenizer_file()
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    texts = [x or "" for _, x in documents]
    got = packing.Encoder(path, pattern).encode(pa.array(texts))
    want = t.encode_batch(texts, add_special_tokens=False)
    assert all(g.tolist() == w.ids for g, w in zip(got, want))


def test_added_tokens_equal_the_unmodified_library(documents):
    from tokenizers import Tokenizer
    path, pattern = packing.tokenizer_file()
    end = "<|endoftext|>"
    texts = [f"hello {end} world", end, end * 3, f" {end} ", f"a{end}b  {end}\n{end} c", f"{end} lead", f"trail {end}", "<|endoftext|", "<|endof text|>",
             "<|<|endoftext|>|>", f"two  {end}  spaces\n\n{end}\n", "plain"] + [x or "" for _, x in documents[:30]]
    texts += [f"{x[:40]}{end}{x[40:90]} {end} {x[90:]}" for x in texts[-20:]]
    got = packing.Encoder(path, pattern).encode(pa.array(texts))
    want = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [g.tolist() for g in got] == [w.ids for w in want] and got[0].tolist() == [31373, 220, 50256, 995]


def test_packing_round_trip(spark, documents, frame):
    from tokenizers import Tokenizer
    path, pattern = packing.tokenizer_file()
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    rows = packing.pack(frame, path, pattern, max_tokens=64).collect()
    ids = {i: np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4") for i, x in documents}
    seen = collections.defaultdict(list)
    bins = collections.defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] <= 64 and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        seen[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, x in ids.items():
        pieces = sorted(seen[i])
        assert [p for p, _, _ in pieces] == list(range(-(-len(x) // 64)))
        assert sum(n for _, _, n in pieces) == len(x) and all(n == 64 for _, _, n in pieces[1:])
    for parts in bins.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= 64


def naive_best_fit(sizes, cap):
    room = []
    for s in sorted(sizes, reverse=True):
        fits = [k for k, r in enumerate(room) if r >= s]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= s
        else:
            room.append(cap - s)
    return sorted(room)


@pytest.mark.parametrize("seed", range(8))
def test_plan_equals_best_fit_piece_by_piece(seed):
    rng = np.random.default_rng(seed)
    cap = int(rng.integers(5, 60))
    sizes = rng.integers(1, cap + 1, 400).tolist()
    steps = packing.best_fit_plan(collections.Counter(sizes), cap)
    used, placed = collections.defaultdict(list), collections.Counter()
    for s, rank, n, per, first, at in steps:
        for k in range(n):
            used[first + k // per].append((at + k % per * s, s))
            placed[s] += 1
    assert placed == collections.Counter(sizes)
    for parts in used.values():
        end = 0
        for at, s in sorted(parts):
            assert at == end
            end += s
    assert sorted(cap - sum(s for _, s in p) for p in used.values()) == naive_best_fit(sizes, cap)


def test_packing_empty_and_repeated(spark, empty):
    path, pattern = packing.tokenizer_file()
    assert packing.pack(empty, path, pattern).count() == 0
    df = spark.createDataFrame([(1, None), (1, None), (None, "a b")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["length"]) for r in packing.pack(df, path, pattern).collect())
    assert got == [("1", 1), ("1", 1), ("None", 3)]


# ---------------------------------------------------------------- 6

def test_licences_by_pattern(spark):
    import re
    got = licences.op6_licence_paragraphs(spark, SF_MORE).collect()
    names = {"Apache-2.0": "Apache", "MIT": "MIT", "GPL": "GNU General", "CC-BY-NC": "BY-NC"}
    docs = {r["doc_id"]: r["text"].split("\n") for r in table(spark, SF_MORE, "documents").collect()}
    want = {(i, k) for i, ls in docs.items() for k, x in enumerate(ls) if re.search("licen[sc]e", x, re.I)}
    assert {(r["doc_id"], r["line"]) for r in got} == want and len(want) > 20
    assert all(names[r["family"]] in docs[r["doc_id"]][r["line"]] and r["probability"] > 0.5 and r["overlap"] >= 0.6 for r in got)


def test_licences_odd_texts(spark, frame, empty):
    model = licences.fit(frame)
    df = spark.createDataFrame([
        (1, "text before\nThis file is licensed under the Mozilla Public License, version 2.0, see below.\nafter"), (2, None), (3, ""),
        (4, "The license plate of the MIT student"), (5, "All rights reserved. No part of this publication may be reproduced without prior written permission of the publisher."),
        (None, "Released under the MIT License."), (6, "released under\n the mit license"), (7, "Licensed under the BSD 3-Clause License."),
        (7, "Licensed under the BSD 3-Clause License.")], "doc_id long, text string")
    got = sorted({(str(r["doc_id"]), r["line"], r["family"]) for r in licences.scan(df, model).collect()})
    assert got == [("1", 1, "MPL-2.0"), ("5", 0, "proprietary"), ("7", 0, "BSD"), ("None", 0, "MIT")]
    assert licences.scan(empty, model).count() == 0
    plan = licences.scan(df, model)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_licences_in_a_small_table(spark):
    docs = table(spark, SF_MORE, "documents").where(F.col("text").rlike("(?i)licen[sc]e")).orderBy("doc_id").limit(10).select("doc_id", "text").collect()
    few = spark.createDataFrame(docs, "doc_id long, text string")
    want = {(r["doc_id"], k) for r in docs for k, x in enumerate(r["text"].split("\n")) if "licen" in x.lower()}
    got = {(r["doc_id"], r["line"]) for r in licences.scan(few, licences.fit(few)).collect()}
    assert got == want and len(want) >= 10


def test_licences_stay_when_frequent(spark):
    lines = ["Released under the MIT License", "Licensed under the Apache License, Version 2.0", "Licensed under the BSD 3-Clause License",
             "SPDX-License-Identifier: MPL-2.0"]
    family = ["MIT", "Apache-2.0", "BSD", "MPL-2.0"]
    rows = [(i, f"plain words {i} about item{i}\n" + (f"{lines[i // 3 % 4]}, see note{i}." if i % 3 == 0 else f"other text {i}")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["line"], r["family"]) for r in licences.scan(docs, licences.fit(docs)).collect()}
    assert got == {(i, 1, family[i // 3 % 4]) for i in range(0, 600, 3)}


def test_licences_wrapped_over_lines(spark, frame):
    gpl = ("    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU General Public License as published by\n"
           "    the Free Software Foundation, either version 3 of the License, or\n    (at your option) any later version.")
    lgpl = (" * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n"
            " * License as published by the Free Software Foundation; either\n * version 2.1 of the License")
    bsd = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\n"
           "are met:\n1. Redistributions of source code must retain the above copyright")
    rows = [(1, f"code\n\n{gpl}\n\nmore"), (2, f"/*\n{lgpl}\n */"), (3, bsd), (4, f"{bsd}\n\n{gpl}"), (None, "released under\nthe MIT license."),
            (5, "released under the\n\nMIT license"), (6, "Released under the MIT License.\nplain words"), (7, "plain\nwords under\nthe software"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = licences.scan(docs, licences.fit(frame), wrapped=True)
    got = {(r["doc_id"], r["line"], r["last_line"], r["family"]) for r in found.collect()}
    assert got == {(1, 2, 4, "GPL"), (2, 1, 3, "LGPL"), (3, 0, 2, "BSD"), (4, 0, 2, "BSD"), (4, 5, 7, "GPL"), (None, 0, 1, "MIT"), (6, 0, 0, "MIT")}
    plan = found._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_anchors_miss_no_confirmed_paragraph(spark):
    rows = licences.template_rows(spark)
    for share in (0.3, 0.6, 0.9):
        anchors = set(licences.anchor_words(rows, share))
        for r in rows.collect():
            pairs = set(zip(r["_words"], r["_words"][1:]))
            assert sum(not anchors & {*p} for p in pairs) / len(pairs) < share


# ---------------------------------------------------------------- 7

def test_base_scores_by_brute_force_and_model_beats_them(spark):
    docs = table(spark, SF_MORE, "documents").select("doc_id", "text").collect()
    got = lm.op7_log_bilinear(spark, SF_MORE).collect()
    count = collections.Counter()
    for d in docs:
        if zlib.crc32(str(d["doc_id"]).encode()) % 10:
            count.update((d["text"] or "").encode().lower().split())
            count[None] += 1
    n, v = sum(count.values()), len(count)
    text = {d["doc_id"]: (d["text"] or "").encode().lower().split() + [None] for d in docs}
    for r in got:
        w = text[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(count[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), rel=1e-9)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_model_is_normalised():
    rng = np.random.default_rng(0)
    pairs = rng.integers(0, 5, (lm.CLASSES, lm.CLASSES)).astype(float)
    pairs[3, 7] = 5000
    table_ = lm.fit_nce(pairs, steps=60)
    assert np.allclose((10 ** table_).sum(1), 1) and table_[3].argmax() == 7
    classes = lm.Classes([(5, 2, 100)], {2: (150, 11), 9: (30, 4)}, 8)
    words = lm.Words([b"a bb ccc"])
    cls = classes.of(words)
    assert classes.tokens == 188 and classes.words == 16
    assert np.all(classes.share(words, cls, np.zeros(3)) <= 0)


def test_scores_of_odd_texts(spark, frame, empty):
    got = {r["doc_id"]: r for r in lm.score_texts(frame, crc_mod("doc_id", 10) != 0).collect()}
    assert len(got) == frame.count()
    for r in frame.collect():
        assert got[r["doc_id"]]["n_tokens"] == len((r["text"] or "").encode().split()) + 1
        assert got[r["doc_id"]]["score"] < 0
    assert lm.score_texts(empty, F.lit(True)).count() == 0
    one = spark.createDataFrame([(None, "x y"), (None, None)], "doc_id long, text string")
    assert [r["n_known"] for r in lm.score_texts(one, crc_mod("doc_id", 10) != 0).collect()] == [0, 0]


# ---------------------------------------------------------------- 8

def test_quality_of_labelled_documents(spark):
    got = quality.op8_hierarchical_quality(spark, SF_MORE).join(table(spark, SF_MORE, "labels"), "doc_id").collect()
    good = [r["kept"] for r in got if r["quality"] == 1 and not r["toxic"]]
    bad = [r["kept"] for r in got if r["quality"] == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.1


def test_toxic_words_are_learned(spark):
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(600):
        text = rng.choice(words, 60).tolist()
        if i % 5 == 0:
            text[3], text[40] = "nastyword", "uglyterm"
        rows.append((i, " ".join(text), f"h{i % 7}", "p"))
        if i < 400:
            labels.append((i, 1, int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    model = quality.fit_classifier(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert "nastyword" in model["terms"]
    kept = {r["doc_id"]: r["kept"] for r in quality.classify(docs, model).collect()}
    assert all(kept[i] == (i % 5 != 0) for i in range(400, 600))


def test_sparse_sites_stay_near_their_parent(spark):
    rows = [("big", "a", 0.1)] * 200 + [("big", "b", 0.9)] * 200 + [("small", "a", 0.0)] + [(None, None, 0.5)] * 3 + [("other", "a", 0.8)] * 100
    got = {(r["_host"], r["_path"]): r for r in quality.site_posteriors(spark.createDataFrame(rows, "_host string, _path string, _p double")).collect()}
    base = got["small", "a"]["_base"]
    assert got["big", "a"]["_path_rate"] < 0.2 and got["big", "b"]["_path_rate"] > 0.8
    assert 0 < got["small", "a"]["_path_rate"] < base and (None, None) in got


def test_quality_odd_texts(spark, frame, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit_classifier(frame, labels)
    got = quality.classify(frame, model).collect()
    assert len(got) == frame.count() and all(r["kept"] for r in got)
    model = quality.fit_classifier(frame, table(spark, SF, "labels"))
    null_hosts = frame.withColumn("source", F.lit(None).cast("string"))
    assert quality.classify(null_hosts, model).count() == frame.count()
    assert quality.classify(empty, model).count() == 0


# ---------------------------------------------------------------- 10

def test_tiling_finds_reordered_passages():
    item = np.arange(1, 31)
    doc = np.concatenate([np.zeros(9, int), item[20:], np.zeros(3, int), item[:10], [0, 0], item[10:20], [7, 7, 7]])
    got = decontam.tiles(item, doc, 5)
    assert sorted((i, n) for i, _, n in got) == [(0, 10), (10, 10), (20, 10)]
    assert decontam.tiles(item, item[::-1].copy(), 5) == []
    assert decontam.tiles(item, np.concatenate([item[:4], [0], item[4:8]]), 5) == []


def test_tiles_do_not_overlap():
    rng = np.random.default_rng(2)
    for _ in range(30):
        a, b = rng.integers(1, 4, 40), rng.integers(1, 4, 60)
        ua, ub, last = np.zeros(40, int), np.zeros(60, int), 99
        for i, j, n in decontam.tiles(a, b, 3):
            assert (a[i:i + n] == b[j:j + n]).all() and n <= last
            ua[i:i + n] += 1
            ub[j:j + n] += 1
            last = n
        assert ua.max(initial=0) <= 1 and ub.max(initial=0) <= 1


def test_contamination_of_the_table(spark):
    docs, items = table(spark, SF_MORE, "documents").collect(), table(spark, SF_MORE, "benchmark").collect()
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in decontam.op10_greedy_tiling(spark, SF_MORE).collect()}
    whole = {(d["doc_id"], x["item_id"]) for d in docs for x in items if x["text"] in d["text"]}
    assert whole and whole <= set(got) and all(got[k] == 1.0 for k in whole)


def test_contamination_small_cases(spark, monkeypatch):
    words = [f"q{k}" for k in range(40)]
    bench = spark.createDataFrame([(1, " ".join(words[:20])), (2, " ".join(words[20:])), (2, " ".join(words[20:])), (3, None), (None, "a b c d e f"),
                                   (4, "a b c")], "item_id long, text string")
    docs = spark.createDataFrame([
        (10, "x " + " ".join(words[10:20] + ["y"] + words[:10]).upper() + "!"), (11, " ".join(words[:9])), (12, None), (13, ""),
        (14, ", ".join(words)), (14, ", ".join(words)), (None, " ".join(words[20:])), (15, "a b c a b c")], "doc_id long, text string")
    want = sorted([("10", 1, 1.0), ("14", 1, 1.0), ("14", 1, 1.0), ("14", 2, 1.0), ("14", 2, 1.0), ("None", 2, 1.0)])
    for block in (1000, 10):                               # one block, then one item a block
        got = sorted((str(r["doc_id"]), r["item_id"], r["coverage"]) for r in decontam.contamination(docs, bench, block_words=block).collect())
        assert got == want
    left = decontam.without_contaminated(docs, bench).collect()
    assert sorted(str(r["doc_id"]) for r in left) == ["11", "12", "13", "15", "None"]
    assert decontam.contamination(docs, bench.limit(0)).count() == 0


def test_partial_quotes_of_long_items(spark):
    words = [f"w{k}" for k in range(200)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(f"v{k}" for k in range(59)))], "item_id long, text string")
    docs = spark.createDataFrame([(10, "x " + " ".join(words[50:149]) + " y"), (11, "x " + " ".join(f"v{k}" for k in range(20, 49))),
                                  (12, "x " + " ".join(words[7:20]) + " y"), (13, "x " + " ".join(words[7:19]) + " y")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["longest"]) for r in decontam.contamination(docs, bench).collect())
    assert got == [(10, 1, 99), (11, 2, 29), (12, 1, 13)]
    assert [r["doc_id"] for r in decontam.without_contaminated(docs, bench).collect()] == [13]


def test_every_benchmark_text_is_searched(spark):
    bench = spark.createDataFrame([(1, "a b c d e f"), (1, "z y x w v u"), (None, "k l m n o p"), (None, "g h i j g i"), (None, None)],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(10, "a b c d e f"), (11, "z y x w v u"), (12, "k l m n o p"), (13, "g h i j g i"), (14, "q r s t u v")],
                                 "doc_id long, text string")
    for block in (1000, 6):
        got = sorted((r["doc_id"], r["item_id"]) for r in decontam.contamination(docs, bench, block_words=block).collect())
        assert got == [(10, 1), (11, 1), (12, None), (13, None)]
    assert [r["doc_id"] for r in decontam.without_contaminated(docs, bench).collect()] == [14]
