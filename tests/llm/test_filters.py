import brute
import numpy as np
from brute import ordered
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import decontam as D
from tidemark.llm import language as G
from tidemark.llm import licences as I
from tidemark.llm import quality as Q
from tidemark.llm import warc as W

BENCH = [(1, "a b"), (2, "b c d e f g h i j k l m n"), (3, "zz"), (4, "zz y zz"), (5, None), (6, "..."),
         (None, "a b c"), (8, "A-B"), (9, "b a b a"), (2, "again the same id")]


def test_contamination_whole_table(spark, documents):
    df, docs = documents
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute.contamination(docs, [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert ordered(D.window_report(df, bench).collect()) == ordered(want) and any(r[-1] for r in want)


def test_contamination_edge(spark, edge, empty):
    df, docs = edge
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert ordered(D.window_report(df, bench).collect()) == ordered(brute.contamination(docs, BENCH))
    assert D.window_report(empty, bench).count() == 0
    assert not any(r["contaminated"] for r in D.window_report(df, bench.limit(0)).collect())
    kept = D.decontaminate(df, bench)
    assert kept.columns == df.columns
    clean = {d: t for d, t in docs if d not in (5, 10, 12)}
    assert {r["doc_id"]: r["text"] for r in kept.collect() if r["doc_id"] in clean} == clean


def test_benchmark_in_shards(spark):
    docs = [(1, "a b c d zz"), (2, "A, b! x a b"), (3, "b c d e f g h i j k l m n b c d e f g h i j k")]
    df, bench = (spark.createDataFrame(x, "id long, text string").toDF(n, "text") for x, n in
                 ((docs, "doc_id"), (BENCH, "item_id")))
    whole, parts = ({r["doc_id"]: (r["spans"], r["items"]) for r in D.benchmark_windows(df, bench, shard_words=n).collect()}
                    for n in (D.SHARD_WORDS, 6))
    assert {k: v[1] for k, v in whole.items()} == {k: v[1] for k, v in parts.items()}
    assert {k: sum(e - s for s, e in v[0]) for k, v in whole.items()} == {k: sum(e - s for s, e in v[0]) for k, v in parts.items()}


def test_passages_are_cut_out(spark):
    passage = " ".join(f"Item{i}," for i in range(12))
    docs = [(1, f"Keep this ñ part of it all. {passage} And keep what comes behind, all of it."), (2, passage)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    rows = D.decontaminate(df, bench).collect()
    assert [(r["doc_id"], r["text"]) for r in rows] == [
        (1, "Keep this ñ part of it all. , And keep what comes behind, all of it.")]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=7), max_size=4), st.lists(st.integers(0, 3), max_size=12),
       st.integers(1, 4))
def test_automaton_finds_every_window(items, text, window):
    automaton = D.Automaton(window)
    for words in items:
        automaton.add(words)
    for k, words in enumerate(items):
        automaton.mark(str(k), words)
    got = {(s, e, i) for s, e, found in automaton.scan(text) for i in found}
    want = {(j, j + n, str(k)) for k, words in enumerate(items) if words
            for n in [min(window, len(words))] for a in range(len(words) - n + 1)
            for j in range(len(text) - n + 1) if text[j:j + n] == words[a:a + n]}
    assert got == want


def test_quality_whole_table(documents, edge, empty):
    for df, docs in (documents, edge):
        got = [(r[0], *r[1:7]) for r in Q.judge_documents(df).collect()]
        assert ordered(got) == ordered((d, *brute.quality(t)) for d, t in docs)
    assert Q.judge_documents(empty).count() == 0


def test_host_verdicts(spark):
    good, bad = " ".join(f"w{i}" for i in range(20)), "too short"
    rows = [(i, good if i % 10 else bad, "clean") for i in range(100)]
    rows += [(1000 + i, bad if i % 10 else good, "spam") for i in range(100)]
    rows += [(2000, bad, "tiny"), (3001, None, None)] + [(3000 + 10 * i, good, None) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in Q.judge_documents(df).collect()}
    assert sum(kept[i] for i in range(100)) == 90 and not any(kept[1000 + i] for i in range(100))
    assert kept[3000] and not kept[3001]
    hosts = spark.createDataFrame([("a", 1000, 100), ("b", 10, 9), ("c", 1, 1)], "host string, n_docs long, n_failed long")
    mean, strength = Q.beta_prior(hosts)
    assert abs(mean - 110 / 1011) < 1e-12 and strength > 0
    rate = {r["host"]: r["host_rate"] for r in Q.host_verdicts(hosts).collect()}
    assert rate["c"] < rate["b"] < 0.9 and abs(rate["a"] - 0.1) < 0.01
    assert Q.beta_prior(hosts.limit(0)) == (0.0, 0.0)
    same = spark.createDataFrame([("a", 10, 1), ("b", 10, 1)], "host string, n_docs long, n_failed long")
    assert Q.beta_prior(same) == (0.1, 20)


def test_archives_round_trip(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert ordered(W.archive_round_trip(pages).collect()) == ordered(brute.archives(rows))


def test_archives_edge(spark):
    big = "x\r\n\r\nWARC/1.1 é" * 100
    rows = [(1, "u", big), (2, "u", big), (2, "u", big), (None, None, big), (4, "a%0A\nb\r", None), (5, "", ""),
            (6, "v", "WARC/1.1\r\n\r\n"), (7, "v", "\x00\x85z"), (None, None, None), (None, None, None),
            (8, "w", "y" * 1000), (9, "w", "y" * 1000), (10, "w", "y" * 999), (11, "w", "y" * 999)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as n", "2 as capture")
    assert ordered(W.archive_round_trip(df).collect()) == ordered(brute.archives(rows))
    assert W.archive_round_trip(df.limit(0)).count() == 0


def test_captures_are_nested(spark):
    from tidemark.session import scratch_path
    path = scratch_path(spark, "archives")
    big = "page " * 300
    df = spark.createDataFrame([(1, "http://a/1", big), (2, "http://a/2", big)], "page_id long, url string, html string")
    W.write_archives(df, path)
    rows = {r["page_id"]: r for r in W.captures(spark, path, with_payload=True).collect()}
    assert rows[2]["response"]["payload"] == big.encode() and rows[1]["refers_to"] == 2
    assert rows[1]["request"]["fields"] == "GET http://a/1 HTTP/1.1\r\n\r\n" and rows[1]["url"] == "http://a/1"
    records = W.read_records(spark, path)
    kinds = {r["kind"]: r["n"] for r in records.groupBy("kind").count().toDF("kind", "n").collect()}
    assert kinds == {"request": 2, "metadata": 2, "response": 1, "revisit": 1}


def test_records_of_other_writers():
    import gzip
    one = (b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 5\r\n\r\n"
           b"a\r\n\r\n\r\n\r\n")
    members = gzip.compress(one) + gzip.compress(one)  # one gzip stream per record
    assert [block for _, block in W.parse_records(gzip.decompress(members))] == [b"a\r\n\r\n"] * 2


def test_licences_whole_table(documents, edge, empty):
    for df, docs in (documents, edge):
        rows = I.scan_licences(df).collect()
        assert ordered(r[:6] for r in rows) == ordered((d, *brute.licence_base(t, I.BASE_PHRASES)) for d, t in docs)
        assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in rows)
    assert I.scan_licences(empty).count() == 0


def test_licence_templates(spark):
    filler = " ".join(f"word{i}" for i in range(300))
    docs = [(i, f"{filler} {t.text}. {filler}") for i, t in enumerate(I.TEMPLATES)]
    docs += [(100 + i, filler) for i in range(60)]
    broken = I.TEMPLATES[7].text.replace("binary", "other")
    docs.append((50, f"{filler} {broken}"))  # a key phrase is not there
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in I.scan_licences(df).collect()}
    for i, t in enumerate(I.TEMPLATES):
        assert t.label in rows[i]["labels"].split(",") and rows[i]["score"] > 0.99
    assert rows[50]["labels"] == "" and rows[50]["score"] == 0 and rows[100]["labels"] == ""


def test_licences_side_by_side(spark):
    """Each template is found beside any other, and in a text that holds the whole vocabulary."""
    filler = " ".join(f"word{i}" for i in range(300))
    pairs = [(a, b) for a in I.TEMPLATES for b in I.TEMPLATES if a.label < b.label]
    docs = [(i, f"{filler} {a.text}. {filler} {b.text}.") for i, (a, b) in enumerate(pairs)]
    vocabulary = " ".join(f"{w} word{i}" for i, w in enumerate(sorted({w for w, *_ in I.postings()})))
    docs += [(100 + i, f"{vocabulary} {filler} {t.text}. {vocabulary}") for i, t in enumerate(I.TEMPLATES)]
    docs += [(200 + i, filler) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in I.scan_licences(df).collect()}
    for i, found in enumerate(pairs):
        assert {t.label for t in found} <= set(rows[i]["labels"].split(",")) and rows[i]["score"] > 0.99
    for i, t in enumerate(I.TEMPLATES):
        assert t.label in rows[100 + i]["labels"].split(",") and rows[100 + i]["score"] > 0.99


#: Opening words of real licences and notices, and the templates that stand in them.
REAL_LICENCES = [
    ("""MIT License

Copyright (c) 2020 A. Writer

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""", {"mit", "mit-notice", "mit-text"}),
    ("""ISC License

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""", {"isc-text"}),
    ("""Permission to use, copy, modify, and distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""", {"isc-text"}),
    ("""Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0""", {"apache", "apache-2.0-notice", "apache-2.0-text"}),
    ("""This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""", {"gpl", "gpl-text"}),
    ("""GNU GENERAL PUBLIC LICENSE
Version 3, 29 June 2007""", {"gpl", "gpl-3.0-notice"}),
    ("""Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:""", {"bsd-text"}),
    ("""This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""", {"mpl-2.0-text"}),
    ("This work is licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0-notice"}),
    ("""Permission to use, copy, modify, and distribute this software and its
documentation for any purpose and without fee is hereby granted, provided that
the above copyright notice appear in all copies""", set()),
]


def test_real_licences(spark):
    docs = [(i, text) for i, (text, _) in enumerate(REAL_LICENCES)] + [(100 + i, f"word{i}") for i in range(60)]
    rows = {r["doc_id"]: r for r in I.scan_licences(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, (_, labels) in enumerate(REAL_LICENCES):
        assert set(filter(None, rows[i]["labels"].split(","))) == labels


def test_language_gradients():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in G._start(3, 1).items()}
    x, label = rng.integers(0, 256, (6, 4)), rng.integers(0, 3, 4)
    _, grad = G.gradients(w, x, label)
    for key in w:
        at = (int(x[2, 1]), 5) if key[0] == "x" else tuple(int(rng.integers(0, n)) for n in w[key].shape)
        own, sides = w[key][at], []
        for step in (1e-3, -1e-3):
            w[key][at] = own + step
            sides.append(G.gradients(w, x, label)[0])
        w[key][at] = own
        assert abs((sides[0] - sides[1]) / 2e-3 - grad[key][at]) < 1e-4


def test_language_held_out_accuracy(documents):
    import zlib
    df, docs = documents
    rows = {r["doc_id"]: r for r in G.identify(df).collect()}
    lang = {r["doc_id"]: r["lang"] for r in df.select("doc_id", "lang").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in rows.items())
    held = [k for k, r in rows.items() if r["held_out"] and lang[k]]
    assert np.mean([rows[k]["lang_pred"] == lang[k] for k in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_language_batches_read_alike():
    """Windows, batches and slices do not change what a text gets, and every byte counts."""
    rng = np.random.default_rng(1)
    model = G.Model(["a", "b"], G._start(2, 5))
    texts = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (1, 127, 128, 129, 1000, 0)]
    body = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = G.document_probabilities(model, body, offsets)
    for k, t in enumerate(texts[:-1]):
        own = np.frombuffer(t, np.uint8)
        assert np.allclose(G.document_probabilities(model, own, np.array([0, len(t)]))[0], together[k], atol=1e-5)
        w, p = model.weights, np.zeros(2)
        for at in range(0, len(own), G.WINDOW):
            x = own[at:at + G.WINDOW][:, None]
            p += G._window_probabilities(w, x, np.array([len(x)]))[0]
        assert np.allclose(p / len(own), together[k], atol=1e-5)
    assert not together[-1].any()


def test_language_edge(spark, edge, empty):
    df, docs = edge
    rows = G.identify(df).collect()  # no language is given, so nothing is learned
    assert len(rows) == len(docs) and all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows)
    assert G.identify(empty).count() == 0
    mixed = spark.createDataFrame(
        [(i, ("der die das und " if i % 2 else "le la les et ") * 20, "de" if i % 2 else "fr") for i in range(40)]
        + [(50, None, None), (51, "123 !?", "de"), (None, "der die das", "de")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in G.identify(mixed).collect()}
    assert got[50]["lang_pred"] == got[51]["lang_pred"] == "und" and not got[None]["held_out"]
    assert got[None]["lang_pred"] == "de" and got[5]["lang_pred"] == "de" and got[6]["lang_pred"] == "fr"
    assert {r["doc_id"] for r in G.keep_identified(mixed).collect()} == {*range(40), None}


def test_language_predictions_against_a_scalar_network(spark):
    """Every prediction of a trained model against plain Python, one byte and unit at a time."""
    texts = [("de" if i % 2 else "fr", ("der die das und " if i % 2 else "le la les et ") * 20) for i in range(20)]
    model = G.train([*texts, ("es", "el la los y que " * 10)])
    given = ["der die das", "le la les et " * 30, "x", "ñandú el los é", "a" * 300]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "doc_id long, text string")
    for r in G.predict(df, model).collect():
        p = brute.language_probabilities(model.weights, r["text"])
        best, second = sorted(p)[::-1][:2]
        assert model.languages[p.index(best)] == r["lang_pred"]
        assert abs(best - r["score"]) < 1e-4 and abs(best / second - r["odds"]) < 1e-2 * r["odds"]


def test_language_shared_ids_and_repeated_rows(spark):
    """Rows that share an id do not pass or fall together: both languages are learned."""
    rows = [(7, f"der die das und {i} ist nicht", "de") for i in range(3000)] + [(i, f"le la les et {i} pas que", "fr") for i in range(400)]
    rows += [(9, "el la los y que es", "es")] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = G.training_sample(df)
    assert {lang for lang, _ in sample} == {"de", "fr", "es"}
    assert sum(lang == "es" for lang, _ in sample) == 3 and sum(lang == "de" for lang, _ in sample) == 1500
    kept = G.keep_identified(df).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in kept} == {"de": 3000, "fr": 400, "es": 3000}


def test_many_languages(spark, monkeypatch):
    """250 languages, each with letters of its own: all are learned, and most documents are named right
    (after a tenth of the steps)."""
    monkeypatch.setattr(G, "STEPS", 25)
    rows = [(5 * (k * 12 + i) + 1, "".join(chr(0x4E00 + 40 * k + (7 * i + j * j) % 40) for j in range(60)), f"l{k:03d}")
            for k in range(250) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = G.train(G.training_sample(df))
    assert len(model.languages) == 250
    right = sum(r["lang"] == r["lang_pred"] for r in G.predict(df, model).collect())
    assert right > 0.7 * len(rows)
    few = G.training_sample(df, texts=250)
    assert len({lang for lang, _ in few}) == 250 and len(few) <= 250 * G.EXCERPTS
