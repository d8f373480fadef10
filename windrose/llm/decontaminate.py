"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as lower-cased words: runs of letters and digits, and single characters of scripts that
are written without spaces. An item of n words may differ
from a passage by k = floor(error_share * n) inserted, deleted or changed words. It is cut into k + 1
pieces; a passage within k edits holds at least one piece unchanged. One automaton finds all exact
piece hits in a text, and each hit's surroundings are verified with Myers' bit-parallel distance,
which lets the passage start and end anywhere.

Documents are read once for each block of items and never shuffled: a passage that a third of them
share is only work for the tasks that hold them. The items go to the executors in blocks of at most
about `block_chars` characters, as many as it takes.

Items of fewer than five words have no budget and are found where all their words stand in a row.
`least_words` leaves out shorter items, if a benchmark has some that are no passages.

Defined results: null and wordless texts hold nothing; items that are null, wordless or shorter than
`least_words` words are not searched; items that repeat are all
reported, an item id that repeats with its nearest text; rows that repeat are judged alike; without
items nothing matches.
"""

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.llm.common import prepare, table

_WORDS = re.compile(r"[^\W_]+")
#: Blocks of Thai, Lao, Tibetan, Burmese, Khmer, Japanese and Chinese characters.
_BLOCKS = (
    "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
_UNSPACED = re.compile(f"[{_BLOCKS}]")
_UNITS = re.compile(f"[{_BLOCKS}]|[^{_BLOCKS}]+")
_FOUND = "array<struct<item_id: bigint, edits: int, word: bigint>>"


@dataclass(frozen=True)
class Matching:
    error_share: float = 0.2
    least_words: int = 1
    block_chars: int = 2 << 20


PRODUCTION = Matching()


def normalised(text: str | None) -> list[str]:
    words = _WORDS.findall((text or "").lower())
    if not text or text.isascii() or not _UNSPACED.search(text):
        return words
    return [unit for word in words for unit in _UNITS.findall(word)]


def nearest(pattern: dict[str, int], size: int, words: list[str]) -> int:
    """Fewest edits between the pattern and any run of `words`.

    `pattern` has for each word of the item the bits of its places; `size` is the item's length.
    """
    everything, last = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score, best = everything, 0, size, size
    for word in words:
        same = pattern.get(word, 0)
        across = same | minus
        down = ((((same & plus) + plus) ^ plus) | same) & everything
        up = (minus | ~(down | plus)) & everything
        dropped = plus & down
        if up & last:
            score += 1
        elif dropped & last:
            score -= 1
        if score < best:
            best = score
        up, dropped = (up << 1) & everything, (dropped << 1) & everything
        plus = (dropped | ~(across | up)) & everything
        minus = up & across
    return best


class Items:
    """A block of items ready to be searched; built once in each Python worker."""

    def __init__(self, rows: list[tuple[int, str]], how: Matching) -> None:
        self.items: list[tuple[int, int, int, dict[str, int]]] = []
        self.pieces = ahocorasick.Automaton()
        for item_id, text in rows:
            words = normalised(text)
            if item_id is None or len(words) < max(1, how.least_words):
                continue
            budget = int(how.error_share * len(words))
            places: dict[str, int] = {}
            for i, word in enumerate(words):
                places[word] = places.get(word, 0) | 1 << i
            number = len(self.items)
            self.items.append((item_id, len(words), budget, places))
            cuts = [len(words) * i // (budget + 1) for i in range(budget + 2)]
            for start, end in zip(cuts, cuts[1:], strict=False):
                piece = f" {' '.join(words[start:end])} "
                self.pieces.get(piece, None) or self.pieces.add_word(piece, [])
                self.pieces.get(piece).append((number, start, len(piece)))
        if self.items:
            self.pieces.make_automaton()

    def found(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item_id, edits, first word) of each item in the text, at its nearest passage."""
        words = normalised(text) if self.items else []
        if not words:
            return []
        joined = f" {' '.join(words)} "
        hits = set()
        starts: list[int] = []
        for end, entries in self.pieces.iter(joined):
            if not starts:
                place = 0
                for word in words:
                    starts.append(place)
                    place += len(word) + 1
            for number, offset, length in entries:
                hits.add((number, bisect_right(starts, end - length + 1) - 1 - offset))
        best: dict[int, tuple[int, int]] = {}
        for number, first in hits:
            item_id, size, budget, places = self.items[number]
            window = words[max(0, first - budget) : max(0, first + size + budget)]
            edits = nearest(places, size, window)
            if edits <= budget:
                place = (edits, max(0, first))
                best[item_id] = min(best.get(item_id, place), place)
        return sorted((item_id, edits, first) for item_id, (edits, first) in best.items())


#: The last blocks built in this worker, by the broadcast they came in.
_BUILT: dict[int, Items] = {}
_MOST_BUILT = 4


def _built(block) -> Items:
    if block.value["id"] not in _BUILT:
        while len(_BUILT) >= _MOST_BUILT:
            del _BUILT[next(iter(_BUILT))]
        _BUILT[block.value["id"]] = Items(block.value["rows"], block.value["how"])
    return _BUILT[block.value["id"]]


def _blocks(items: DataFrame, how: Matching) -> Iterator[list[tuple[int, str]]]:
    rows = items.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // how.block_chars)
    for block in range(blocks):
        own = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        yield [(r["item_id"], r["text"]) for r in rows.where(own).collect()]


def passages(text: Column, items: DataFrame, how: Matching = PRODUCTION) -> Column:
    """array<struct<item_id, edits, word>>: the items of which `text` holds a passage."""
    context = prepare(items.sparkSession).sparkContext

    def search(number: int, rows: list[tuple[int, str]]) -> Column:
        sent = context.broadcast({"id": hash((number, tuple(rows), how)), "rows": rows, "how": how})

        @F.pandas_udf(_FOUND)
        def found(texts: pd.Series) -> pd.Series:
            block = _built(sent)
            return pd.Series([block.found(t) for t in texts], dtype=object)

        return found(text)

    found = [search(number, rows) for number, rows in enumerate(_blocks(items, how))]
    none = F.expr(f"CAST(array() AS {_FOUND})")
    return reduce(lambda a, b: F.concat(a, b), found) if found else none


def contaminated(docs: DataFrame, items: DataFrame, how: Matching = PRODUCTION) -> DataFrame:
    """(doc_id, item_id, edits, word) for each document and each item that it holds."""
    found = docs.select("doc_id", F.explode(passages(F.col("text"), items, how)).alias("f"))
    return found.select("doc_id", "f.item_id", "f.edits", "f.word")


def decontaminated(docs: DataFrame, items: DataFrame, how: Matching = PRODUCTION) -> DataFrame:
    """The rows of `docs` that hold no item."""
    return docs.where(F.size(passages(F.col("text"), items, how)) == 0)


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return contaminated(documents, table(spark, folder, "benchmark"))


QUERIES = {"op5_benchmark_decontamination": op5_benchmark_decontamination}
ORACLE_SQL: dict[str, str] = {}
