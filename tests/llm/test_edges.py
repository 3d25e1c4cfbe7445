"""Nulls, empty and very long texts, ties, repeated rows, empty tables, and extra
columns whose names clash, for every operator."""

import hashlib
import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hearth.llm import bpe, html_text, lattice_dedup, license_scan, mixing, simhash
from hearth.llm import substring_dedup as sub
from hearth.llm import token_files, toxicity
from hearth.llm.components import components
from hearth.llm.exact_dedup import drop_exact_copies, exact_groups
from hearth.llm.queries import BYTE_RANKS, END_ID, WORD_TOKENIZER
from hearth.session import fresh_subdir
from tests.llm import brute

LONG = " ".join(f"word{k % 997} idiot{k % 31}," for k in range(20_000))
SOLID = "x" * 3000 + "é" * 2000 + "\U0001f600" * 300
TEXTS = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "one"), (5, "one  two"), (6, "one\ttwo"),
    (7, "One two"), (8, LONG), (9, LONG + " tail"), (10, SOLID), (11, "the " * 200),
    (12, "a b c d e f g h i j k l m"), (13, "z a b c d e f g h i j k l m y"),
    (14, "a b c d e f g h i j k l"), (None, "one two"), (None, None), (15, "one two"),
    (15, "one two"), (15, "other text under the same identifier"), (16, "é     \x85x"),
    (17, "don't we'll <|endoftext|> İΣς Å ﬁ"), (-3, "a b c d e f g h i j k l m n"),
]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _id string, fp string, "
          "score double, _sha string, `a.b` string, x0__ string, ids string, _size string")


def documents(spark, texts=TEXTS):
    rows = [(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t), "x", "y",
             0.5, "z", "d", "e", "f", "g") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def expected(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def with_late_nulls(rows):
    """Brute force over rows whose null identifiers are larger than all."""
    last = 10**18
    out = [tuple(None if x == last else x for x in r)
           for r in rows([(last if i is None else i, t) for i, t in TEXTS])]
    return expected(out)


def test_exact(spark):
    found = rows_of(exact_groups(documents(spark), fan_in=2), "doc_id", "keep_id", "group_size", "kept",
                    "text_sha256")
    assert found == with_late_nulls(brute.exact)


def test_exact_over_many_runs(spark):
    many = documents(spark, [(k, f"t{k % 7}") for k in range(300)]).repartition(37)
    found = rows_of(exact_groups(many, fan_in=3), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert found == expected(brute.exact([(k, f"t{k % 7}") for k in range(300)]))


def test_drop_exact_keeps_columns(spark):
    docs = documents(spark)
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(
        str(None if i == 10**18 else i) for i, _, _, k, _ in
        brute.exact([(10**18 if i is None else i, t) for i, t in TEXTS]) if k)


def test_simhash(spark):
    for tile in (4096, 3):                       # 3: keys are dealt as tile pairs
        found = simhash.simhash_components(documents(spark), tile=tile)
        found = rows_of(found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("f"),
                                     "component_id"), "doc_id", "f", "component_id")
        assert found == with_late_nulls(brute.near_components)


def test_simhash_of_a_large_near_group(spark):
    """Thousands of fingerprints within a few bits, in tiles, against all pairs."""
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, 3)
    prints = sorted({int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centre
                     for a, b in rng.integers(0, 63, (400, 2))})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = simhash.near_links(frame, 3, 5, tile=50)
    assert links.count() < 40 * 10 * len(prints)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    x = np.array(prints, np.uint64)
    near = [(a, b) for a in range(len(x)) for b in np.flatnonzero(
        np.bitwise_count(x[:a] ^ x[a]) <= 3).tolist()]
    least = brute.least_reachable(prints, near)
    assert [roots.get(p, p) for p in prints] == least


def test_drop_near_keeps_one_row_of_each_component(spark):
    docs = documents(spark)
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    groups = {c for _, _, c in brute.near_components([(10**18 if i is None else i, t) for i, t in TEXTS])}
    assert len(kept.collect()) >= len(groups - {10**18})


def test_toxicity(spark):
    toxic = [(k, ("you are a blorg " if k % 3 == 0 else "what a fine day ") + f"w{k}") for k in range(300)]
    docs = documents(spark, toxic + [(1000, None), (1001, ""), (1002, LONG)])
    labels = spark.createDataFrame(
        [(k, int(k % 3 == 0)) for k in range(300)] + [(None, 1), (5, None), (7, 0), (7, 0), (9999, 1)],
        "doc_id long, toxic int")
    weights = toxicity.train_toxicity(docs, labels, learn=F.col("doc_id") % 5 != 0, l1=1.0)
    score = toxicity.toxicity_score(weights, F.col("text"))
    scored = {r[0]: r[1] for r in docs.select("doc_id", score.alias("s")).collect()}
    assert len(scored) == 303
    held = [k for k in range(300) if k % 5 == 0]
    assert all((scored[k] >= 0.5) == (k % 3 == 0) for k in held)
    assert scored[1000] == scored[1001]
    again = toxicity.train_toxicity(docs, labels, learn=F.col("doc_id") % 5 != 0, l1=1.0)
    assert rows_of(weights, "index", "weight") == rows_of(again, "index", "weight")
    nothing = toxicity.train_toxicity(docs, labels.limit(0))
    none = docs.select(toxicity.toxicity_score(nothing, F.col("text")).alias("s")).collect()
    assert {r["s"] for r in none} == {0.0}


def test_byte_bpe(spark):
    docs = documents(spark)
    encoded = bpe.encode_texts(docs, BYTE_RANKS, public_tokenizers.PATTERN)
    assert encoded.columns == [c for c in docs.columns if c not in ("text", "ids")] + ["ids"]
    back = bpe.decode_ids(encoded, BYTE_RANKS)
    found = sorted(repr((r["doc_id"], len(r["ids"]),
                         hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest(),
                         hashlib.sha256(bytes(r["decoded"])).hexdigest())) for r in back.collect())
    assert found == sorted(repr((i, *x)) for (i, _), x in zip(
        TEXTS, brute.byte_bpe([t for _, t in TEXTS]), strict=True))


def test_long_pieces_merge_like_rows():
    vocab = bpe.read_ranks(BYTE_RANKS)
    encoder = bpe.Encoder(vocab, bpe.PairTable(vocab))
    rng = np.random.default_rng(5)
    pieces = [bytes(rng.choice(list(b"thereaint "), n).tolist()) for n in (2, 3, 17, 64, 65, 300, 512)]
    matrix = encoder.encode(pieces)
    for piece, ids in zip(pieces, matrix, strict=True):
        if piece not in encoder.whole:
            assert encoder._long(piece).tolist() == ids.tolist()
        assert b"".join(vocab[i] for i in ids) == piece


def test_token_files(spark):
    path = fresh_subdir(spark, "token-test")
    docs = documents(spark).repartition(5)
    token_files.write_token_files(docs, path, WORD_TOKENIZER, END_ID)
    all_ = token_files.read_token_files(spark, path)
    found = rows_of(all_.select("doc_id", "n_tokens", F.crc32("ids").alias("c")), "doc_id", "n_tokens", "c")
    assert found == expected((i, n, c) for i, _, n, c in brute.token_starts(TEXTS))
    placed = sorted((r["start"], r["n_tokens"]) for r in all_.collect())
    assert [a for a, _ in placed] == [sum(n for _, n in placed[:k]) for k in range(len(placed))]
    order = [r["doc_id"] for r in sorted(all_.collect(), key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    some = token_files.read_token_files(spark, path, [8, 12]).collect()
    whole = {r["doc_id"]: r for r in all_.collect()}
    assert {r["doc_id"] for r in some} == {8, 12}
    assert all(tuple(r) == tuple(whole[r["doc_id"]]) for r in some)


def test_mixing(spark):
    docs = documents(spark)
    for _ in range(2):
        mixed = mixing.mix_sources(docs)
        rows = [r.asDict() for r in mixed.collect()]
        assert len(rows) == len(TEXTS)
        assert all(r["taken"] <= 3 * r["size"] for r in rows)
        assert rows_of(mixed, *mixed.columns) == rows_of(mixing.mix_sources(docs.repartition(7)),
                                                        *mixed.columns)
    by_source = {}
    for r in rows:
        by_source.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    sizes = {}
    for k, (_, t) in enumerate(TEXTS):
        s = None if k % 5 == 0 else f"s{k % 3}"
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    levels = brute.water_levels([sizes[s] for s in order])
    assert sorted(round(t, 3) for _, t in by_source) == sorted(round(x, 3) for x in levels)
    assert all(abs(sum(taken) - target) <= 2 for (_, target), taken in by_source.items())


def test_mixed_documents_hold_the_words_that_the_plan_takes(spark):
    docs = documents(spark)
    plan = mixing.mix_sources(docs).groupBy("doc_id").agg(F.sum("taken").alias("t")).collect()
    mixed = mixing.mixed_documents(docs, length_col="n_chars")
    assert mixed.columns == docs.columns
    words = {}
    for r in mixed.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(brute.words(r["text"]))
        assert r["n_chars"] is None or r["n_chars"] == len(r["text"])
    assert words == {r["doc_id"]: r["t"] for r in plan if r["doc_id"] in words}
    assert sum(words.values()) == sum(r["t"] for r in plan)


def test_substring(spark):
    docs = documents(spark)
    for parts in (1, 7):                         # settled inside one batch, and between batches
        found = sub.substring_dedup(docs.repartition(parts))
        found = found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("k"))
        assert rows_of(found, *found.columns) == expected(brute.repeats(TEXTS))


def test_substring_of_many_rows_without_identifier(spark):
    # 600 texts: 15 bits would take some of them for one
    texts = [(None, " ".join(f"u{k}x{j}" for j in range(k % 40)) + " a b c d e f g h i j k l m" * (k % 3))
             for k in range(600)] + [(1, "a b c d e f g h i j k l m")]
    found = sub.substring_dedup(documents(spark, texts).repartition(5))
    found = found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("k"))
    assert rows_of(found, *found.columns) == expected(brute.repeats(texts))


def test_substring_spans(spark):
    docs = documents(spark, [(1, "p q " + " ".join(f"w{k}" for k in range(20)) + " r"),
                             (2, "x " + " ".join(f"w{k}" for k in range(20)) + " y z"), (3, "short")])
    rows = {r["doc_id"]: r for r in sub.substring_dedup(docs).collect()}
    assert [tuple(s) for s in rows[2]["repeats"]] == [(1, 21)]
    assert rows[2]["kept"] == "x y z" and rows[1]["n_removed"] == 0 and rows[3]["repeats"] == []


def vectors():
    rng = np.random.default_rng(7)
    base = rng.normal(size=(12, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(100 + k, (base[k % 4] + rng.normal(size=16) * 0.05).tolist()) for k in range(60)]
    rows += [(200, base[0].tolist()), (200, base[0].tolist()), (201, (base[0] * 1e30).tolist()),
             (None, base[1].tolist()), (None, None), (300, None), (301, []), (302, [0.0] * 16),
             (303, [math.nan] + [1.0] * 15), (304, [math.inf] + [1.0] * 15),
             (305, [None] + [1.0] * 15), (306, [1.0, 2.0]), (307, [2.0, 4.0]), (308, (-base[0]).tolist())]
    return rows


def test_lattice(spark):
    rows = vectors()
    frame = spark.createDataFrame([(i, v, "n", 1, "h") for i, v in rows],
                                  "vec_id long, embedding array<double>, node string, copies int, home string")
    last = 10**18
    exp = expected(tuple(None if x == last else x for x in r) for r in brute.embedding_links(
        [(last if i is None else i, v) for i, v in rows]))
    for tile in (2048, 9):                       # 9: cells are dealt as tile pairs
        found = lattice_dedup.embedding_groups(frame, tile=tile)
        assert rows_of(found, "vec_id", "n_links", "component_id") == exp


@pytest.mark.parametrize("cosine", [0.95, 0.97, 0.99])
def test_lattice_recall(cosine):
    """Share of pairs at a given cosine that meet in a cell, with the defaults."""
    rng = np.random.default_rng(11)
    n, dim = 4000, 64
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=(n, dim))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = cosine * x + math.sqrt(1 - cosine**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    cells = lattice_dedup.Cells(dim, tables=8, probes=4, blocks=2, width=1.7, seed=42)
    (hx, px), (hy, py) = cells.of(x), cells.of(y)
    px, py = px.reshape(n, 8, 4), py.reshape(n, 8, 4)
    met = ((hx == hy) | (py == hx[:, :, None]).any(axis=2) | (px == hy[:, :, None]).any(axis=2)).any(axis=1)
    assert met.mean() > 0.98


def test_e8_decoding_is_nearest():
    rng = np.random.default_rng(13)
    y = rng.normal(size=(500, 8)) * 2
    near = lattice_dedup.nearest_e8(y)
    d = ((y - near) ** 2).sum(axis=1)
    for v in lattice_dedup.e8_neighbours():
        assert (d <= ((y - near - v) ** 2).sum(axis=1) + 1e-9).all()
    assert d.max() <= 1 + 1e-9                   # the covering radius of E8


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h2>Site</h2></header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies, yes.</div>
<div id="content"><h1>Head &amp; tail</h1><p>First, a paragraph&nbsp;with <b>bold
 text</b>, commas, and&#8212;length enough to count as one.<p>Second<br>line, unclosed, still long enough here.
<ul><li>item one<li>item two</ul><form><p>Write to us, please, now.</p></form><script>var a = "</p>";</script>
<table><tr><td>cell 1<td>cell 2</table><!-- <p>gone</p> --></div>
<aside>Also read, this, that, and more.</aside><section id="comments"><p>Nice, very nice, thanks, friend.</p></section>
<div class="ad-slot"><p>Buy, buy, buy, now, today, cheap.</p></div><footer>&copy; all</footer></body></html>"""


@pytest.mark.parametrize("page, text", [
    (PAGE, "Head & tail\nFirst, a paragraph with bold text, commas, and—length enough to count as one.\n"
           "Second line, unclosed, still long enough here.\nitem one\nitem two\ncell 1\ncell 2"),
    (None, ""), ("", ""), ("   \n", ""), ("just text, no tags", "just text, no tags"),
    ("<p>a < b & c &lt; d", "a < b & c < d"), ("<article><p>short</article><p>out", "short"),
    ("<!-- never closed <p>x</p>", ""), ("<script>never closed", ""), ("<" * 5000, "<" * 5000),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ("<p>a " + "<b>" * 20_000 + "deep" + "</b>" * 20_000 + "</p>", "a deep"),
    ('<article><p class="a" ">one</p><p title="a>b">two</p><p title=\'it\'s\'>three</p></article>',
     "one\ntwo\nthree"),
    ("<p>x</p>" + "<p a='y " * 50_000, "x\n" + ("<p a='y " * 50_000).strip()),
    ("<p>x</p><!-- y", "x"), ("<p>x</p>y <? z", "x\ny"),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_pages_keep_other_columns(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "old", "z"), (2, None, None, None, None)],
                                  "page_id long, url string, html string, text string, `x.y` string")
    out = html_text.extract_main_text(pages)
    assert out.columns == ["page_id", "url", "x.y", "text"]
    assert {r["page_id"]: r["text"][:4] for r in out.collect()} == {1: "Head", 2: ""}


@pytest.mark.parametrize("text, ids, names, left", [
    ("Licensed under the Apache License, Version 2.0.\nX", ["ApacheShort"], ["Apache-2.0"], []),
    ("x. This work is licensed under the GNU General Public License, version 3. All rights reserved.",
     ["Gpl3Work", "AllRights"], ["GPL-3.0-only"], ["AllRights"]),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation; either version 2 of the "
     "License, or (at your option) any later version.", ["LaterThan2"], [], ["LaterThan2"]),
    ("Released under the MIT License.\nLicensed under the MIT license!", ["MitShort", "MitShort"],
     ["MIT"], []),
    (None, [], [], []), ("", [], [], []),
])
def test_licenses(spark, text, ids, names, left):
    row = license_scan.scan_licenses(documents(spark, [(1, text)])).first()
    if "free software" in (text or ""):          # the colon cuts the sentence
        assert row["sentence_ids"][-1:] == ids
        return
    assert (row["sentence_ids"], row["licenses"], row["unmatched"]) == (ids, names, left)


def test_every_rule_names_known_sentences():
    assert {i for _, ids in license_scan.RULES for i in ids} <= set(license_scan.SENTENCES.values())


def test_components_of_a_long_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(1, 120)]
    star = [(1000, 1000 + k) for k in range(1, 200)]
    frame = spark.createDataFrame([*path, *star, (5, 5), (None, 3)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(frame).collect()}
    assert found == {k: 1 for k in range(2, 121)} | {1000 + k: 1000 for k in range(1, 200)}


def test_empty_tables(spark):
    none = documents(spark).limit(0)
    path = fresh_subdir(spark, "token-test")
    token_files.write_token_files(none, path, WORD_TOKENIZER, END_ID)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    weights = toxicity.train_toxicity(none, labels)
    for df in (exact_groups(none), drop_exact_copies(none), simhash.simhash_components(none),
               simhash.drop_near_copies(none), mixing.mix_sources(none), mixing.mixed_documents(none),
               bpe.decode_ids(bpe.encode_texts(none, BYTE_RANKS, public_tokenizers.PATTERN), BYTE_RANKS),
               token_files.read_token_files(spark, path), sub.substring_dedup(none),
               none.select(toxicity.toxicity_score(weights, F.col("text")).alias("s")),
               lattice_dedup.embedding_groups(empty), license_scan.scan_licenses(none),
               html_text.extract_main_text(none, html_col="text", text_col="main")):
        assert df.collect() == []


def test_pipeline_stages_over_awkward_rows(spark):
    docs = documents(spark)
    folder = fresh_subdir(spark, "edge-tables")
    spark.createDataFrame([(4, 0), (8, 1), (None, None)], "doc_id long, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    for source in (docs, docs.limit(0)):
        kept = source
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, folder)
            if name != "byte_bpe":
                assert kept.columns == docs.columns
        assert len(kept.collect()) <= 3 * len(TEXTS)


def test_words_encode_as_whole_texts_do():
    from tokenizers import Tokenizer

    texts = [t or "" for _, t in TEXTS] + [
        "Don't stop, OK?! (really...) it's 3.14; e.g., U.S.A. x.y é, É. é. İ! ..., a.b.c.",
        "<|ENDOFTEXT|>. <|endoftext|>, x<|startoftext|>y", "ß, ǅ.  z . 한국어. Ａ１. ²³.", "a\x00. b\x1c, c",
        "H\u0331 T\u0308 J\u030c I\u0307 E\u0301, h\u0331 t\u0308. e\u0301! x.\u0301 y"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        with open(public_tokenizers.path(name), encoding="utf-8") as f:
            encoder = token_files.WordTokens(f.read())
        assert encoder.by_word == (name == "word_bpe_49k.json")
        whole = Tokenizer.from_file(public_tokenizers.path(name))
        for got, text in zip(encoder.encode(pa.array(texts)), texts, strict=True):
            ids = np.frombuffer(got, "<u4").tolist()
            assert ids == whole.encode(text, add_special_tokens=False).ids, text[:80]
