"""What workers hold and what stays in the shared folder while an operator runs."""

from __future__ import annotations

import os
import weakref
from urllib.parse import urlparse

import pyarrow as pa
import public_tokenizers

from cardloom.llm import bpe, jaccard_join


def test_a_batch_is_let_go_before_the_next_one_is_read():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        encoder = bpe.Encoder(file.read(), bpe.packed(bpe.compile_lexicon({})))
    held = []

    def batches():
        for i in range(3):
            assert all(batch() is None for batch in held)
            batch = pa.RecordBatch.from_pydict({"id": [i], "text": [f"some text {i}"]})
            held.append(weakref.ref(batch))
            yield batch
            del batch

    # the caller keeps no part of the output
    made = bpe.coded_batches(encoder, _one_by_one(batches()))
    assert [part["decoded"].to_pylist() for part in made] == [["some text 0"], ["some text 1"], ["some text 2"]]


def _one_by_one(batches):
    while True:
        try:
            yield next(batches)
        except StopIteration:
            return


def test_prefixes_are_gone_before_pairs_are_verified(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"one two three four five six seven {i % 2}") for i in range(6)] + [(9, None)], "doc_id long, text string")
    seen, verified = {}, jaccard_join._verified

    def spied(pairs, classes, rows, size, percent, folder, name):
        links = verified(pairs, classes, rows, size, percent, folder, name)
        seen[name] = set(os.listdir(urlparse(folder).path))
        assert "prefix" not in classes.columns
        return links

    monkeypatch.setattr(jaccard_join, "_verified", spied)
    found = {(r.id, r.n_shingles, r.component_id) for r in jaccard_join.near_components(docs, percent=50).collect()}
    assert found == {(i, 6, 0) for i in range(6)} | {(9, 0, 9)}
    assert not {"heads", "wide"} & seen["star"] and not {"heads", "wide", "blocks"} & seen["cross"]
