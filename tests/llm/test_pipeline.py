import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from windrose.llm import decontaminate, language_id, simhash_dedup, source_mix, token_files
from windrose.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_is_registered():
    numbers = Counter(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == dict.fromkeys(range(1, 11), 1)
    assert QUERIES.items() <= driver.queries().items()
    assert driver.queries()["pipeline"] is corpus_pipeline.run


def test_stages_against_plain_steps(spark):
    """Each stage's decisions, taken from the operators' own results on its input."""
    tokenizers = pytest.importorskip("tokenizers")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    inputs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, inputs[-1], SF)
        inputs.append(corpus_pipeline.stored(made, f"test-{name}")[0])
    assert all(df.columns == COLUMNS for df in inputs[:-1])
    rows = [df.collect() for df in inputs]

    filters = language_id.trained(docs.where(~language_id.held_out(docs.doc_id)))
    names, scores = filters.predicted([r.text or "" for r in rows[0]])
    kept = [r for r, n, s in zip(rows[0], names, scores, strict=True) if n != "und" and s >= language_id.LEAST_SCORE]
    assert sorted(rows[1]) == sorted(kept)

    groups = {r.doc_id: r.component_id for r in simhash_dedup.near_duplicates(inputs[1]).collect()}
    assert sorted(r.doc_id for r in rows[2]) == sorted(i for i, c in groups.items() if i == c)

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    block = decontaminate.Items(items, decontaminate.PRODUCTION)
    assert sorted(rows[3]) == sorted(r for r in rows[2] if not block.found(r.text))

    copies = {r.doc_id: len(r.copies) for r in source_mix.mix_sources(inputs[3]).collect()}
    assert Counter(r.doc_id for r in rows[4]) == {i: n for i, n in copies.items() if n}

    library = tokenizers.Tokenizer.from_str(token_files.public_tokenizer())
    texts = {r.doc_id: r.text for r in rows[4]}
    start = 0
    for r in sorted(rows[5], key=lambda r: r.start):
        ids = np.array([*library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert [r.doc_id for r in sorted(rows[5], key=lambda r: r.start)] == sorted(r.doc_id for r in rows[4])

    assert sorted(corpus_pipeline.run(spark, SF).collect()) == sorted(rows[5])
