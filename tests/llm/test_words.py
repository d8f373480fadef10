import random
import re

import numpy as np
import pyarrow as pa
import pytest

from windrose.llm.words import ByteRule, merged_keys, word_chunks

RULE = ByteRule(b" \t", b".,\n")


def plain(texts):
    return [
        [[w.lower() for w in re.findall(r"[^ \t]+", piece)] for piece in re.split(r"[.,\n]", text or "")] for text in texts
    ]


@pytest.mark.parametrize("limit", [1, 7, 64, 1 << 20])
def test_words_rows_and_pieces(limit):
    rng = random.Random(limit)
    texts = ["".join(rng.choices(["a", "B", "é", "中", " ", "\t", ".", "\n", "xyz"], k=rng.randrange(60))) for _ in range(80)]
    texts += [None, "", " ", "end", "start", "a" * 500]
    column = pa.array(["skipped", *texts, "also"]).slice(1, len(texts))
    found, last_piece, last_row = {}, None, None
    for words in word_chunks(column, RULE, limit):
        assert words.continued == (last_row is not None and words.rows[0] == last_row) or words.rows[0] != last_row
        terms = words.terms.to_pylist()
        for i, row, piece in zip(words.ids, words.rows, words.pieces, strict=True):
            assert last_piece is None or piece >= last_piece
            found.setdefault(int(row), {}).setdefault(int(piece), []).append(terms[i])
            last_piece = piece
        last_row = words.rows[-1]
    for row, pieces in enumerate(plain(texts)):
        lowered = [[re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in p] for p in pieces if p]
        assert list(found.get(row, {}).values()) == lowered
    assert sum(len(p) for p in found.values()) == len({(r, q) for r, ps in found.items() for q in ps})


def test_no_rows():
    assert list(word_chunks(pa.array([], pa.string()), RULE)) == []
    assert list(word_chunks(pa.array([None, ""], pa.string()), RULE)) == []


def test_merged_keys():
    keys, n = merged_keys(np.array([5, 1, 5, 2]), np.array([1, 2, 3, 4]))
    assert keys.tolist() == [1, 2, 5] and n.tolist() == [2, 4, 4]
    keys, n = merged_keys(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert len(keys) == len(n) == 0
