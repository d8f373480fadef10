import random

import pytest

from windrose.llm import decontaminate
from windrose.llm.decontaminate import Items, Matching, normalised

SF = "/root/testdata/sf0.01"


def fewest_edits(item, words):
    """Fewest word edits between an item and any run of words, by the table of all prefixes."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def expected(text, items, how=decontaminate.PRODUCTION):
    words, found = normalised(text), {}
    for item_id, item in items:
        own = normalised(item)
        if words and item_id is not None and own and len(own) >= how.least_words:
            edits = fewest_edits(own, words)
            if edits <= int(how.error_share * len(own)):
                found[item_id] = min(found.get(item_id, edits), edits)
    return found


def edited(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = rng.choice(vocabulary)
        elif kind == 1 and len(words) > 1:
            del words[at]
        else:
            words.insert(at, rng.choice(vocabulary))
    return words


def test_against_all_alignments():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(25)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40)))) for i in range(30)]
    items += [(0, "w1 w2 w3 w4 w5 w6 w7"), (40, None), (None, "w1 w2 w3 w4 w5 w6"), (41, ""), (42, "a a a a a a a a a a")]
    block = Items(items, decontaminate.PRODUCTION)
    for _ in range(300):
        words = rng.choices(vocabulary, k=rng.randrange(0, 30))
        for item_id, item in rng.sample(items[:31], 2):
            own = item.split()
            words += edited(rng, own, rng.randrange(len(own) // 4 + 2), vocabulary) + rng.choices(vocabulary, k=3)
        text = rng.choice([" ", ", ", " -- "]).join(words).upper()
        assert {i: e for i, e, _ in block.found(text)} == expected(text, items)


def test_query_against_all_alignments_of_planted_items(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = decontaminate.op5_benchmark_decontamination(spark, SF).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    joined = {d.doc_id: f" {' '.join(normalised(d.text))} " for d in docs}
    held = {(d, i) for d, t in joined.items() for i, item in items if f" {' '.join(normalised(item))} " in t}
    assert held
    assert held <= found
    texts = {d.doc_id: d.text for d in docs}
    chosen = sorted(found)[:5] + [(d, i) for d in sorted(texts)[:6] for i, _ in items[:4]]
    for doc_id, item_id in chosen:
        near = expected(texts[doc_id], [(item_id, dict(items)[item_id])])
        assert (item_id in near) == ((doc_id, item_id) in found)


SCHEMA = "doc_id long, text string, item_id string, found int, edits string"


def test_odd_rows_blocks_and_columns(spark):
    clash = ("i", 1, "e")
    passage = "one two three four five six seven eight nine ten"
    rows = [
        (1, f"start {passage} end", *clash), (1, f"start {passage} end", *clash), (2, None, *clash), (3, "", *clash),
        (None, passage.upper().replace(" ", "\n"), *clash), (4, "clean " * 200_000, *clash),
        (5, "one two three four five six six eight nine ten", *clash), (6, "one two three four five", *clash),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    items = spark.createDataFrame(
        [(1, passage), (1, "nothing of this is anywhere to be found"), (2, passage), (3, None), (4, "one two")],
        "item_id int, text string",
    )
    for chars in (1 << 20, 10):
        how = Matching(least_words=5, block_chars=chars)
        found = decontaminate.contaminated(docs, items, how).collect()
        assert sorted((r.doc_id or 0, r.item_id, r.edits) for r in found) == [
            (0, 1, 0), (0, 2, 0), (1, 1, 0), (1, 1, 0), (1, 2, 0), (1, 2, 0), (5, 1, 1), (5, 2, 1),
        ]
        kept = decontaminate.decontaminated(docs, items, how)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6]
    assert decontaminate.decontaminated(docs, items.limit(0)).count() == len(rows)
    assert decontaminate.contaminated(docs.limit(0), items).collect() == []


def test_short_items_are_found_exactly(spark):
    docs = spark.createDataFrame(
        [(1, "so: Alpha, beta gamma\ndelta!"), (2, "alpha beta gamma"), (3, "alpha beta delta gamma"), (4, "one"), (5, "ones")],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "ONE"), (3, "?!")], "item_id long, text string")
    found = decontaminate.contaminated(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in found) == [(1, 1, 0), (4, 2, 0)]


def test_characters_of_unspaced_scripts_are_words():
    item = "我们今天在北京的大学里学习，明天去上海工作。"
    own = normalised(item)
    assert len(own) == 20
    assert normalised("東京Tower2へ ไทย") == ["東", "京", "tower2", "へ", "ไ", "ท", "ย"]
    block = Items([(1, item)], decontaminate.PRODUCTION)
    rng = random.Random(3)
    for edits in (0, 1, 4, 8):
        for _ in range(20):
            text = "前面的话，" + "".join(edited(rng, own, edits, list("天地人和"))) + "后面的话"
            assert {i: e for i, e, _ in block.found(text)} == expected(text, [(1, item)])
    assert [e for _, e, _ in block.found("说：" + item.replace("北京", "南京") + "完")] == [1]


def test_more_blocks_than_a_worker_keeps(spark):
    passages = {i: " ".join(f"p{i}x{j}" for j in range(10)) for i in range(12)}
    items = spark.createDataFrame(list(passages.items()), "item_id long, text string")
    docs = spark.createDataFrame([(i, f"a {passages[i]} b") for i in passages], "doc_id long, text string")
    how = Matching(block_chars=60)
    assert len(list(decontaminate._blocks(items, how))) > decontaminate._MOST_BUILT
    found = decontaminate.contaminated(docs, items, how).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(i, i) for i in passages]


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5])
def test_error_share(share):
    item = " ".join(f"w{i}" for i in range(20))
    block = Items([(1, item)], Matching(error_share=share))
    for wrong in range(12):
        words = [f"x{i}" if i < wrong else f"w{i}" for i in range(20)]
        assert bool(block.found(" ".join(words))) == (wrong <= int(share * 20))
