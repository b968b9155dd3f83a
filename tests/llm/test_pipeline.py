"""Every stage of the pipeline against what it has to do to the one before, on awkward and given rows."""

from __future__ import annotations

import random
import struct
import zlib

import corpus_pipeline
from conftest import SMALL
from farelake.llm.common import stored, table
from samples import awkward, empty
from test_minhash import brute as near_copies
from test_pii import brute as spans
from test_substrings import brute as without_passages


def stages(spark, docs):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SMALL), name))
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect() if r.doc_id is not None}


def test_given_documents(spark):
    raw, spoken, single, cleaned, redacted, packed = stages(spark, table(spark, SMALL, "documents"))
    for frame in (spoken, single, cleaned, redacted):
        assert frame.schema.simpleString() == raw.schema.simpleString()
    before = texts(raw)
    assert texts(spoken) == {i: t for i, t in before.items() if any(c.isalpha() for c in t or "")}
    component = near_copies(list(texts(spoken).items()), 5, 80, 100)
    assert texts(single) == {i: t for i, t in texts(spoken).items() if component[i][1] == i}
    passages = without_passages(list(texts(single).items()), 20)
    after = texts(cleaned)
    assert set(after) == {i for i, (n, gone, _) in passages.items() if gone < n or not n}
    for i, text in after.items():
        assert len(text.split()) <= passages[i][0]
        assert text == texts(single)[i] or len(text.encode().split()) == passages[i][0] - passages[i][1]
    clean = texts(redacted)
    assert set(clean) == set(after)
    for i, text in after.items():
        assert (clean[i] == text) if not spans(text) and "[" not in clean[i] else not spans(clean[i])
    assert {r.doc_id for r in packed.collect()} == set(clean)


def test_awkward_rows(spark):
    extra = "pii copy runs bucket label number"
    raw, *rest = stages(spark, awkward(spark, extra).selectExpr("* EXCEPT (lang)", "'xx' AS lang"))
    for frame in rest[:-1]:
        assert frame.columns == raw.columns
    assert {r.doc_id for r in rest[0].collect()} == {None, 4, 5, 6, 8, 9, 10, 2**62 + 1}
    assert 9 not in texts(rest[1]) and 8 in texts(rest[1])
    for frame in stages(spark, empty(spark)):
        assert frame.count() == 0


def test_run_is_registered(spark):
    import __spark_entry__ as contract

    assert contract.queries()["pipeline"] is corpus_pipeline.run
    columns = "doc_id piece start length ids_crc32 ids sequence_id offset".split()
    frame = corpus_pipeline.run(spark, SMALL)
    assert frame.columns == columns
    # The ids are what is delivered: a sequence of them can be written as it is.
    for row in frame.collect():
        assert len(row.ids) == row.length and zlib.crc32(struct.pack(f"<{row.length}I", *row.ids)) == row.ids_crc32


def test_foreign_texts_go(spark):
    """Languages that nobody taught, and random letters, are not taken for one that is known."""
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = " ".join("".join(rng.choices(letters, k=rng.randrange(2, 9))) for _ in range(400))
    italian = (
        "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, ché la diritta via era smarrita. "
        "Ahi quanto a dir qual era è cosa dura esta selva selvaggia e aspra e forte che nel pensier rinova la paura. "
    )
    polish = (
        "Litwo, ojczyzno moja, ty jesteś jak zdrowie; ile cię trzeba cenić, ten tylko się dowie, kto cię stracił. "
        "Dziś piękność twą w całej ozdobie widzę i opisuję, bo tęsknię po tobie. "
    )
    foreign = [(-1, noise), (-2, italian * 8), (-3, polish * 8)]
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    more = spark.createDataFrame([(i, t, None, None, None) for i, t in foreign], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs.union(more), SMALL).select("doc_id").collect()}
    assert not kept & {-1, -2, -3}
    clean = {r.doc_id for r in docs.where("lang IS NOT NULL AND text RLIKE '[a-z]'").select("doc_id").collect()}
    assert len(clean - kept) <= len(clean) // 500
