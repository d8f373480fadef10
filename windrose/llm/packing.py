"""Packs tokenised documents into few sequences of bounded length by swap-based local search.

Documents become pieces: at most `length` token ids, only longer documents being cut. Full pieces are
sequences of their own. The others are dealt over blocks by hash; a block starts from best fit over falling
lengths and is then improved by local search: the least filled bin is drained step by step. A step moves one
of its pieces to another underfull bin, exchanges one for one, or two for one, and is the one that raises
the sum of squared fills most; so fuller bins fill up and the drained one empties and goes. Bins are drained
in order of their fill until none empties any more or their number is the least possible.

Bins with a gap of more than `open_gap` go on, whole, to a round with fewer blocks, where they meet those
of other blocks, until one block is left or a round closes less than half of its pieces. The number of
bins never rises from round to round. A block has about `pieces_per_block` pieces, whatever the table's
size, so rounds grow with the logarithm of the table and no task holds more.

Token ids are those of the library. Tokenizers whose words never hold white space are given each distinct
word of a chunk of texts once; ids are then gathered by arithmetic. Others are given whole texts.

Defined results: a null text is empty and consists of the end id. Rows that repeat a doc_id, or have none,
are documents of their own with equal doc_id. A piece of length 0 shares sequences like others. An empty
table gives no rows. Further columns of a piece table stay; columns `sequence_id` and `offset` are replaced.
"""

import json
import os
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.llm.common import free_name, prepare, stored, table
from windrose.llm.token_files import _FIRST_UNSURE as FIRST_UNSURE
from windrose.llm.token_files import _byte_characters, public_tokenizer
from windrose.llm.words import ByteRule, Words, word_chunks

_KEPT_RUNS = 500_000
_KEPT_OTHERS = 50_000
_PIECES_PER_BATCH = 2048
#: White space of every definition of it; what else counts as white space is left to the library.
_SPACES = ByteRule(b" \t\n\r", lower=False)


@dataclass(frozen=True)
class Packing:
    length: int = 2048
    end_id: int = 0
    pieces_per_block: int = 8192
    open_gap: int = 16


PRODUCTION = Packing()


class WordIds:
    """Token ids of texts by a tokenizer of the tokenizers library, given as its JSON."""

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        parts = json.loads(definition)
        self.by_word = _spaceless(parts)
        self.by_run = self.by_word and _run_wise(parts)
        self._characters = _byte_characters()
        self._runs: dict[str, bytes] = {}
        self._others: dict[str, bytes] = {}

    def _encoded(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, run: str) -> bytes | None:
        """The ids of a run of letters, which the pattern takes whole and whose bytes go straight to the
        merges; None if it is none, also after normalising."""
        if not run.isalpha():
            return None
        plain = run.lower() if run.isascii() else self.tokenizer.normalizer.normalize_str(run)
        if not (plain.isalpha() and max(plain) < FIRST_UNSURE):
            return None
        if not plain.isascii():
            plain = plain.encode().decode("latin-1").translate(self._characters)
        found = array("I", [t.id for t in self.tokenizer.model.tokenize(plain)]).tobytes()
        if len(self._runs) < _KEPT_RUNS:
            self._runs[run] = found
        return found

    def _other(self, text: str) -> bytes:
        found = self._others.get(text)
        if found is None:
            found = self._encoded(text)
            if len(self._others) < _KEPT_OTHERS:
                self._others[text] = found
        return found

    def _word(self, word: str) -> bytes:
        run = word.rstrip(_MARKS) if self.by_run else ""
        ids = self._runs.get(run) or self._letters(run)
        if ids is None:
            return self._other(word)
        return ids if len(run) == len(word) else ids + self._other(word[len(run) :])

    def _chunk(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        known, others = self._runs.get, self._word
        ids = [known(term) or others(term) for term in words.terms.to_numpy(zero_copy_only=False).tolist()]
        ends = np.append(0, np.cumsum(np.fromiter(map(len, ids), np.int32, len(ids)) // 4)).astype(np.int32)
        every = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.uint32)))
        return every.take(pa.array(words.ids)).flatten().to_numpy(), np.diff(ends)[words.ids]

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        counts, parts = np.zeros(len(texts), np.int64), []
        if self.by_word:
            for words in word_chunks(texts, _SPACES):
                ids, sizes = self._chunk(words)
                parts.append(ids)
                counts += np.bincount(words.rows, sizes, len(texts)).astype(np.int64)
        else:
            for row, text in enumerate(pc.fill_null(texts, "").to_pylist()):
                parts.append(np.frombuffer(self._encoded(text), np.uint32))
                counts[row] = len(parts[-1])
        return np.concatenate([np.zeros(0, np.uint32), *parts]), counts


_MARKS = ".,;:!?"
#: A pattern that takes runs of letters, single digits, and runs of anything else, after some contractions.
_RUNS = [r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"]


def _spaceless(definition: dict) -> bool:
    """Whether words between spaces are encoded each by itself.

    So it is if the pattern drops all white space and nothing before it works across white space.
    """
    normal = definition.get("normalizer") or {}
    steps = normal.get("normalizers", [normal] if normal else [])
    local = all(s["type"] in ("NFC", "Lowercase") or s.get("pattern") == {"Regex": "\\s+"} for s in steps)
    before = definition.get("pre_tokenizer") or {}
    first = (before.get("pretokenizers") or [before])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    dropped = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    runs = all(p in _RUNS or p.replace("'", "").isalpha() for p in pattern.split("|"))
    added = definition.get("added_tokens") or []
    plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or " " in t["content"] for t in added)
    return bool(local and dropped and runs and plain)


def _run_wise(definition: dict) -> bool:
    """Whether besides that letters and marks are lower-cased and merged as bytes, run by run."""
    normal, before = definition.get("normalizer") or {}, definition.get("pre_tokenizer") or {}
    kinds = [s["type"] for s in normal.get("normalizers", [])]
    steps = before.get("pretokenizers", [])
    bytewise = len(steps) == 2 and steps[1].items() >= {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}.items()
    pattern = steps[0]["pattern"]["Regex"].split("|") if bytewise else []
    contractions = all(p.startswith("'") for p in pattern if p not in _RUNS)
    added = [t["content"] for t in definition.get("added_tokens") or []]
    other = all(any(not c.isalpha() and c not in _MARKS for c in a) for a in added)
    return "Lowercase" in kinds and bytewise and contractions and set(_RUNS) <= set(pattern) and other


@lru_cache(maxsize=2)
def _word_ids(definition: str) -> WordIds:
    return WordIds(definition)


_PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"


def token_pieces(docs: DataFrame, definition: str, how: Packing = PRODUCTION) -> DataFrame:
    """(doc_id, piece, start, length, ids) of doc_id and text; ids are little-endian 32-bit integers."""
    spark = prepare(docs.sparkSession)
    sent = spark.sparkContext.broadcast(definition)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _word_ids(sent.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, counts = encoder.column(batch.column("text"))
            ids = np.insert(ids, np.cumsum(counts), how.end_id).astype("<u4")
            counts += 1
            pieces = -(-counts // how.length)
            row = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * how.length
            length = np.minimum(how.length, counts[row] - start)
            at = np.append((np.cumsum(counts) - counts)[row] + start, len(ids))
            doc_ids = batch.column("doc_id").take(pa.array(row))
            for first in range(0, len(row), _PIECES_PER_BATCH):
                some = slice(first, first + _PIECES_PER_BATCH)
                places = at[first : first + _PIECES_PER_BATCH + 1]
                content = ids[places[0] : places[-1]].tobytes()
                offsets = ((places - places[0]) * 4).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids[some],
                        pa.array(piece[some], pa.int32()),
                        pa.array(start[some]),
                        pa.array(length[some]),
                        pa.BinaryArray.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(content)]),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(cut, _PIECE_SCHEMA)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bins of best fit over falling lengths."""
    bins, gaps, opened = np.zeros(len(lengths), np.int64), [], 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        at = bisect_left(gaps, (length, -1))
        if at < len(gaps):
            gap, chosen = gaps.pop(at)
        else:
            gap, chosen, opened = capacity, opened, opened + 1
        bins[i] = chosen
        insort(gaps, (gap - length, chosen))
    return bins


class Search:
    """Bins of pieces under local search; the sum of squared fills rises with each step."""

    def __init__(self, lengths: np.ndarray, bins: np.ndarray, capacity: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        _, self.bins = np.unique(bins, return_inverse=True)
        self.fill = np.bincount(self.bins, lengths).astype(np.int64)
        self.least = -(-int(lengths.sum()) // capacity)

    def in_use(self) -> int:
        return int((self.fill > 0).sum())

    def _step(self, donor: int) -> bool:
        """The best move, exchange or two-for-one exchange out of a bin; whether there is one."""
        mine = np.flatnonzero(self.bins == donor)
        mine = mine[np.argsort(self.lengths[mine], kind="stable")]
        # Pieces of one length are alike, so a bin offers few different ones, however many it holds.
        kinds, at, copies = np.unique(self.lengths[mine], return_index=True, return_counts=True)
        low, high = np.triu_indices(len(kinds), 1)
        twice = np.flatnonzero(copies > 1)
        none = np.full(len(kinds), -1)
        sums = np.concatenate([kinds, kinds[low] + kinds[high], 2 * kinds[twice]])
        one = mine[np.concatenate([at, at[low], at[twice]])]
        two = np.concatenate([none, mine[at[high]], mine[at[twice] + 1]])
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        others = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
        others = others[others != donor]
        taken = np.flatnonzero((self.fill[self.bins] < self.capacity) & (self.bins != donor))
        # Nothing, or one piece, comes back for what is given.
        back = np.concatenate([np.zeros(len(others), np.int64), self.lengths[taken]])
        into = np.concatenate([others, self.bins[taken]])
        choice = np.searchsorted(sums, back + self.capacity - self.fill[into], side="right") - 1
        gain = sums[choice] - back
        better = (choice >= 0) & (gain > 0) & (self.fill[into] + gain > self.fill[donor])
        if not better.any():
            return False
        raised = np.where(better, gain * (self.fill[into] - self.fill[donor] + gain), 0)
        best = int(np.argmax(raised))
        target, given = into[best], order[choice[best]]
        moved = [i for i in (one[given], two[given]) if i >= 0]
        if best >= len(others):
            self.bins[taken[best - len(others)]] = donor
        self.bins[moved] = target
        self.fill[target] += gain[best]
        self.fill[donor] -= gain[best]
        return True

    def run(self) -> np.ndarray:
        emptied = True
        while emptied and self.in_use() > self.least:
            emptied = False
            for donor in np.argsort(self.fill, kind="stable").tolist():
                if not 0 < self.fill[donor] < self.capacity:
                    continue
                while self.fill[donor] and self._step(donor):
                    pass
                if not self.fill[donor]:
                    emptied = True
                    if self.in_use() == self.least:
                        break
        return self.bins


def packed_block(lengths: np.ndarray, bins: np.ndarray | None, capacity: int) -> np.ndarray:
    """Bins for pieces, from given bins or from best fit, after local search.

    Pieces of length 0 fit everywhere: they join the first bin, or are one together.
    """
    found = np.zeros(len(lengths), np.int64)
    some = np.flatnonzero(lengths)
    if len(some):
        start = best_fit(lengths[some], capacity) if bins is None else bins[some]
        found[some] = Search(lengths[some], start, capacity).run()
        found[lengths == 0] = found[some[0]]
    return found


_PACKED = "_uid long, length long, sequence_id long, offset long, gap long"


def packed(pieces: DataFrame, how: Packing = PRODUCTION) -> DataFrame:
    """`pieces`, which have a `length` of at most the sequences', with sequence_id and offset."""
    spark = prepare(pieces.sparkSession)
    kept = pieces.drop("sequence_id", "offset")
    uid = free_name(kept, "_uid")
    keyed, _ = stored(kept.withColumn(uid, F.monotonically_increasing_id()), "pack-pieces")

    def pack(block: pa.Table) -> pa.Table:
        block = block.sort_by("_uid")
        ids, lengths, given = (block[c].to_numpy() for c in ("_uid", "length", "sequence_id"))
        bins = packed_block(lengths, None if given[0] < 0 else given, how.length)
        order = np.lexsort((ids, bins))
        ids, lengths, bins = ids[order], lengths[order], bins[order]
        first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
        which = np.cumsum(np.concatenate([[False], bins[1:] != bins[:-1]]))
        ends = np.cumsum(lengths)
        before = (ends - lengths)[first]
        fill = np.add.reduceat(lengths, first)
        return pa.table(
            {
                "_uid": ids,
                "length": lengths,
                "sequence_id": ids[first][which],
                "offset": ends - lengths - before[which],
                "gap": (how.length - fill)[which],
            }
        )

    pool = keyed.filter(F.col("length") < how.length)
    pool = pool.select(F.col(uid).alias("_uid"), F.col("length").cast("long"), F.lit(-1).cast("long").alias("sequence_id"))
    size, results, round_ = pool.count(), [], 0
    while size:
        blocks = -(-size // how.pieces_per_block)
        # A bin of an earlier round stays whole.
        together = F.when(F.col("sequence_id") < 0, F.col("_uid")).otherwise(F.col("sequence_id"))
        block = F.pmod(F.xxhash64(together, F.lit(round_)), F.lit(blocks))
        done, _ = stored(pool.groupBy(block.alias("block")).applyInArrow(pack, _PACKED), "packed")
        open_ = done.filter(F.col("gap") > how.open_gap)
        left = open_.count() if blocks > 1 else 0
        if left > size // 2:
            left = 0
        results.append(done.filter(F.col("gap") <= how.open_gap) if left else done)
        pool, size, round_ = open_.select("_uid", "length", "sequence_id"), left, round_ + 1

    placed = spark.createDataFrame([], _PACKED)
    for result in results:
        placed = placed.unionByName(result)
    placed = placed.select(F.col("_uid").alias(uid), "sequence_id", "offset")
    return (
        keyed.join(placed, uid, "left")
        .withColumns(
            {
                "sequence_id": F.coalesce("sequence_id", uid),
                "offset": F.coalesce("offset", F.lit(0).cast("long")),
            }
        )
        .drop(uid)
    )


def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    pieces = token_pieces(docs, public_tokenizer("word_bpe_49k.json"))
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packed(digests)


QUERIES = {"op11_best_fit_packing": op11_best_fit_packing}
ORACLE_SQL: dict[str, str] = {}
