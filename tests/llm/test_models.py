"""Dropout encoding, licences and the compression classifier."""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import sentencepiece
import xxhash
from conftest import SMALL
from farelake.llm import compression, licences, piece_dropout
from farelake.llm.common import table
from farelake.llm.queries import held_out
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import awkward, empty

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
TEXT = st.text(st.sampled_from("abcdet hinos  \n\té日\U0001f600\x00.,<s>▁"), max_size=80)


def encoder(rate, seed=1):
    return piece_dropout.remembered(MODEL, rate, seed, 0)


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_without_dropout_as_the_library(text):
    if piece_dropout.MARK not in text:
        assert encoder(0.0).encode(text).tolist() == LIBRARY.encode(text)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.sampled_from([0.0, 0.1, 0.7, 1.0]), st.integers(0, 3))
def test_lossless(text, rate, seed):
    assert piece_dropout.open_model(MODEL).decode(encoder(rate, seed).encode(text)) == text


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("thendiong"), min_size=1, max_size=40), st.integers(0, 9))
def test_both_agendas_agree(stretch, seed):
    pieces = piece_dropout.open_model(MODEL)

    def skipped(place, piece):
        return (place * 7 + len(piece) * 3 + seed) % 10 < 3

    assert pieces.merge_short(stretch, skipped) == pieces.merge_long(stretch, skipped)


def test_dropout_varies_by_seed_and_not_by_run():
    text = "the intention of the ordering was to be whatever it is " * 20
    once = encoder(0.1, 1).encode(text).tolist()
    piece_dropout.remembered.cache_clear()
    assert encoder(0.1, 1).encode(text).tolist() == once
    assert encoder(0.1, 2).encode(text).tolist() != once
    assert len(encoder(1.0).encode("the")) == 4


def test_words_vary_within_and_between_documents(spark):
    text = "intention ordering whatever " * 40 + "intention"
    rows = [(1, text), (2, text), (2, text), (None, text), (None, text[10:])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    encoded = piece_dropout.encode(frame, MODEL, rate=0.1, seed=1, check=True).collect()
    assert all(r.lossless for r in encoded)
    by_id = {}
    for row in encoded:
        by_id.setdefault(row.doc_id, set()).add(tuple(row.ids))
    assert len(by_id[1]) == len(by_id[2]) == 1 and by_id[1] != by_id[2] and len(by_id[None]) == 2
    pieces = piece_dropout.open_model(MODEL)
    words = b"|".join(pieces.surface[i] for i in next(iter(by_id[1]))).decode().split("| ")
    spellings = {w for w in words if w.replace("|", "") == "ordering"}
    assert len(spellings) > 3


def test_a_tenth_of_the_draws_skips():
    # A part of two characters draws once.
    ids = encoder(0.1).encode(" ".join("a" for _ in range(40_000)), "x").tolist()
    whole = LIBRARY.encode("a")
    assert len(whole) == 1 and abs(ids.count(whole[0]) / 40_000 - 0.9) < 0.01


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=5), st.sampled_from([0.0, 0.1, 0.5, 1.0]), st.integers(0, 3))
def test_batches_are_as_merging_one_by_one(texts, rate, seed):
    """Every candidate merge draws by a hash of seed, document, place and length, whatever else is encoded."""
    texts = [*texts, "intention" * 9 + " ordering"]
    names = [f"doc/{i}" for i in range(len(texts))]
    pieces, made = piece_dropout.open_model(MODEL), encoder(rate, seed).encode_all(texts, names)
    assert len(made) == len(texts)
    for text, name, ids in zip(texts, names, made):
        spelled = piece_dropout.MARK + text.replace(piece_dropout.MARK, piece_dropout.OWN_MARK).replace(" ", piece_dropout.MARK)
        plain, at, key = [], 0, xxhash.xxh64_intdigest(f"{seed}/{name}")
        for stretch in re.findall(f"{piece_dropout.MARK}+[^{piece_dropout.MARK}]*", spelled) if text else ():

            def skipped(place, piece, start=at, key=key):
                x = (key + (start + place) * 0x9E3779B97F4A7C15 + len(piece) * 0xC2B2AE3D27D4EB4F) % (1 << 64)
                x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % (1 << 64)
                x = (x ^ (x >> 27)) * 0x94D049BB133111EB % (1 << 64)
                return (x ^ (x >> 31)) < rate * (1 << 64)

            plain += pieces.ids(pieces.merge_short(stretch, skipped))
            at += len(stretch)
        assert ids.tolist() == plain
        assert encoder(rate, seed).encode(text, name).tolist() == plain


def test_encode_documents(spark):
    docs = awkward(spark, "ids lossless").union(
        table(spark, SMALL, "documents").selectExpr("doc_id + 100", "text", "lang", "source", "n_chars", "''", "''")
    )
    encoded = piece_dropout.encode(docs, MODEL, rate=0.2, seed=3, variants=2, check=True)
    assert encoded.where("NOT lossless").count() == 0 and encoded.count() == docs.count()
    decoded = piece_dropout.decode(encoded, MODEL).select("doc_id", "text")
    assert sorted(map(repr, decoded.collect())) == sorted(map(repr, docs.select("doc_id", "text").collect()))
    assert piece_dropout.encode(empty(spark), MODEL).count() == 0


MIT = """
 * Copyright (c) 2020 Some Body. All rights reserved.
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software, and to permit persons to whom the Software is
 * furnished to do so, subject to the following conditions:
 *
 * The above copyright notice and this permission notice shall be included in all
 * copies or substantial portions of the Software.
 *
 * THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
 * IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
 * FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
"""


def test_licences(spark):
    texts = {
        1: MIT,
        2: "Prose here. Licensed under the Apache License, Version 2.0.\nMore prose.",
        3: "x\nReleased under the MIT License.\ny",
        4: "This work is licensed under the GNU General Public Licence, version 3.",
        5: "Licensed under CC BY-NC 4.0.",
        6: "# SPDX-License-Identifier: BSD-3-Clause\ncode",
        7: "A licence to print money, with permission.",
        8: None,
        9: "",
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: [x.name for x in r.licences] for r in licences.scan(frame).collect()}
    assert got == {
        1: ["MIT"],
        2: ["Apache-2.0"],
        3: ["MIT"],
        4: ["GPL-3.0-only"],
        5: ["CC-BY-NC-4.0"],
        6: ["BSD-3-Clause"],
        7: [],
        8: [],
        9: [],
    }
    assert all(licences.normalised(s) == s for s in licences.SENTENCES.values())
    assert {n for _, rule in licences.RULES for n in rule} <= set(licences.SENTENCES)
    rows = licences.scan(awkward(spark, "sentences licences")).collect()
    assert len(rows) == awkward(spark).count() and not any(r.licences for r in rows)
    assert licences.scan(empty(spark)).count() == 0


BSD = """Copyright (c) {holder}
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
THIRD = """
3. Neither the name of {holder} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
NOTICE = """
# This {what} is free software; you can redistribute it and/or modify
# it under the terms of the GNU {kind} Public License as published by
# the Free Software Foundation{mark} either version {version} of the License, or
# (at your option) any later version.
#
# This {what} is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU {kind} Public License for more details.
"""
ZLIB = """
This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications,
and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
"""
BOOST = """
Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:
"""


def licences_of(text):
    return [name for _, _, name in licences.match([found[2] for found in licences.sentences(text)])]


def test_official_wordings():
    for holder in ("the copyright holder", "Some Body, Inc."):
        assert licences_of((BSD + THIRD).format(holder=holder)) == ["BSD-3-Clause"]
    assert licences_of(BSD.format(holder="X")) == ["BSD-2-Clause"]
    for kind, licence, version in (
        ("General", "GPL", "2"),
        ("General", "GPL", "3"),
        ("Lesser General", "LGPL", "2.1"),
        ("Lesser General", "LGPL", "3"),
        ("Affero General", "AGPL", "3"),
    ):
        for mark in ";,":
            text = NOTICE.format(what="library", kind=kind, version=version, mark=mark)
            assert licences_of(text) == [f"{licence}-{version if '.' in version else version + '.0'}-or-later"]
    assert licences_of(ZLIB) == ["Zlib"] and licences_of(BOOST) == ["BSL-1.0"]
    assert licences_of("Eclipse Public License - v 2.0\n\nTHE ACCOMPANYING PROGRAM") == ["EPL-2.0"]
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not"
    assert licences_of(mpl) == ["MPL-2.0"]
    title = "GNU GENERAL PUBLIC LICENSE\n  Version 2, June 1991\n\nHow to Apply These Terms to Your New Programs\n"
    assert licences_of(title + NOTICE.format(what="program", kind="General", version="2", mark=";")) == ["GPL-2.0-only"]


def test_every_known_sentence_is_found_alone():
    for name, sentence in licences.SENTENCES.items():
        assert [found[2] for found in licences.sentences(sentence)] == [name]
    for text in ("All rights reserved.", "all rights\n * reserved", "(c) 2020 X", "SPDX-License-Identifier: MIT"):
        assert licences.CUE.search(text)
    assert [found[2] for found in licences.sentences("Prose.\nAll rights reserved.")] == ["rights"]


def test_rules_are_ordered():
    names = ["copyright", "mit-grant", "rights", "mit-keep", "mit-asis", "mit-grant", "spdx:ISC"]
    assert licences.match(names) == [(1, 4, "MIT"), (5, 5, "MIT"), (6, 6, "ISC")]
    far = ["mit-grant", *["rights"] * 5, "mit-keep", "mit-asis"]
    assert licences.match(far) == [(0, 0, "MIT")]


NOTICES = {
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
    "This project is licensed under the MIT License.": "MIT",
    "MIT License": "MIT",
    "Our little tool for big files is licensed under the Apache License 2.0.": "Apache-2.0",
    "Released under the Apache License, Version 2.0.": "Apache-2.0",
    "Distributed under the terms of the GNU General Public License v2": "GPL-2.0-only",
    "This library is distributed under the GNU GPL v3 or later.": "GPL-3.0-or-later",
    "Available under the terms of the GNU Lesser General Public License version 2.1.": "LGPL-2.1-only",
    "All code here is released under the 3-clause BSD license.": "BSD-3-Clause",
    "SPDX-License-Identifier: GPL-2.0-only OR MIT": "GPL-2.0-only OR MIT",
    "// SPDX-License-Identifier: (GPL-2.0 WITH Linux-syscall-note)": "GPL-2.0 WITH Linux-syscall-note",
    "/* SPDX-License-Identifier: (MIT OR GPL-2.0) AND ISC */": "(MIT OR GPL-2.0) AND ISC",
    "Copyright (c) 2019 " + "and ".join(f"Person Number{i} " for i in range(30)) + "\nMIT License": "MIT",
}
DENIED = [
    "This project is not licensed under the MIT License.",
    "It was never released under the Apache License 2.0.",
    "We cannot say that it is licensed under the GNU GPL v3.",
    "Licensed under the moon.",
    "The intention is under the ordering of them.",
]


def test_notices_with_blanks():
    for text, licence in NOTICES.items():
        names = [name for _, _, name in licences.match([f[2] for f in licences.sentences(text)])]
        assert names == [licence], text
    for text in DENIED:
        assert not licences.match([f[2] for f in licences.sentences(text)]), text


def test_compression_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = compression.learn(docs.where(~held_out()), labels.where(~held_out()))
    rows = compression.score(docs.where(held_out()), model).join(labels, "doc_id").toPandas()
    good, bad = (rows.loc[rows["quality"] == k, "score"].to_numpy() for k in (1, 0))
    above = (good[:, None] > bad[None, :]).mean() + (good[:, None] == bad[None, :]).mean() / 2
    assert len(bad) > 50 and above >= 0.95
    assert rows["score"].between(0, 1).all()


def test_compression_of_awkward_rows(spark):
    docs = awkward(spark, "score quality")
    labels = spark.createDataFrame([(8, 1), (9, None), (10, 0), (None, 1), (6, 0), (4, 1)], "doc_id long, quality int")
    model = compression.learn(docs, labels)
    for fitted in (model, compression.learn(empty(spark), labels.limit(0))):
        rows = compression.score(docs, fitted).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert compression.score(empty(spark), model).count() == 0
    assert np.isclose(compression.feature(model, ""), 0) and np.isclose(compression.feature(model, None), 0)


def test_sample_is_bounded(spark):
    docs = table(spark, SMALL, "documents")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    model = compression.learn(docs, labels, sample=4)
    assert 0 < len(model.good) <= 4 * (compression.PART + 1) and len(model.good) == len(model.bad)
