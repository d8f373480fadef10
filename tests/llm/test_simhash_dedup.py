import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from windrose.llm import simhash_dedup
from windrose.llm.components import components

SF = "/root/testdata/sf0.001"


def fingerprint(text, n=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    if not shingles and words:
        shingles = [" ".join(words)]
    counts = [0] * 64
    for shingle in shingles:
        digest = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for bit in range(64):
            counts[bit] += digest >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def union(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def linked(prints, max_bits):
    """The smallest linked fingerprint of each, by comparing all."""
    values, union = np.array(sorted(set(prints)), np.uint64), Union()
    for i, value in enumerate(values):
        union.find(i)
        for j in np.nonzero(np.bitwise_count(values[i + 1 :] ^ value) <= max_bits)[0]:
            union.union(i, int(i + 1 + j))
    return {int(v): int(values[union.find(i)]) for i, v in enumerate(values)}


TEXTS = [
    None, "", " \t\n\x0b\x0c\r", "One", "one  TWO", "a b c", "a b c a b c", "É Ä\x1c x y z", "ß q r s t",
    "x" * 3_000_000 + " y z", "w v u " * 400_000, "last\x85one two three",
]


def test_fingerprints(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = docs.select("doc_id", simhash_dedup.fingerprint(F.col("text")).alias("f")).collect()
    for r in rows:
        assert r.f % (1 << 64) == fingerprint(TEXTS[r.doc_id])


def test_pieces_do_not_change_fingerprints(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \n") for _ in range(rng.randrange(60))) for _ in range(300)]
    monkeypatch.setattr(simhash_dedup, "_PIECE", 3)
    assert [simhash_dedup.simhash(t) % (1 << 64) for t in texts] == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("max_bits", [0, 1, 2])
@pytest.mark.parametrize("most_in_list", [2, 24])
def test_links_against_all_pairs(spark, max_bits, most_in_list):
    rng = random.Random(max_bits)
    prints = [0, (1 << 64) - 1, 3, 12, 1 << 63]
    for centre in [rng.getrandbits(64) for _ in range(12)] + [0]:
        for _ in range(60):
            value = centre
            for _ in range(rng.randrange(5)):
                value ^= 1 << rng.randrange(64)
            prints.append(value)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    docs = spark.createDataFrame(rows, "doc_id long, fingerprint long")
    found = simhash_dedup.grouped(docs, max_bits, most_in_list).collect()
    root = linked(prints, max_bits)
    first = {}
    for i, p in enumerate(prints):
        first[root[p]] = min(first.get(root[p], i), i)
    assert {r.doc_id: r.component_id for r in found} == {i: first[root[p]] for i, p in enumerate(prints)}


def test_query_against_all_pairs(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = simhash_dedup.op4_simhash_dedup(spark, SF).collect()
    prints = {i: fingerprint(t) for i, t in docs.items()}
    root = linked(prints.values(), 2)
    first = {}
    for i in sorted(prints):
        first.setdefault(root[prints[i]], i)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{p:016x}", first[root[p]]) for i, p in prints.items()
    }


SCHEMA = "doc_id long, text string, fingerprint string, component_id int, _h long, kept_h int, rank int"


def test_one_row_of_each_group_stays(spark):
    clash = ("f", 1, 2, 3, 4)
    rows = [
        (5, "a b c d", *clash), (2, "A b c d", *clash), (2, "A b c d", *clash), (9, "other words in here", *clash),
        (None, None, *clash), (None, "", *clash), (None, "alone without id", *clash),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = simhash_dedup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert found[:2] == [(2, "A b c d"), (9, "other words in here")]
    assert len(found) == 4
    assert simhash_dedup.without_near_duplicates(docs.limit(0)).collect() == []
    assert simhash_dedup.near_duplicates(docs.limit(0)).collect() == []


def test_components_of_chains_hubs_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 400)] + [(7, 7), (500, 500)]
    edges += [(rng.randrange(600, 900), rng.randrange(600, 900)) for _ in range(120)] + [(None, 3), (4, None)]
    union = Union()
    for a, b in edges:
        if a is not None and b is not None:
            union.union(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {n: union.find(n) for n in union.parent}
    assert components(df.limit(0)).collect() == []
