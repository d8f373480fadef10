"""Phrases that are more frequent than their parts suggest, by dynamic itemset counting.

Texts are dealt evenly over `shards` folders, as numbers of words with the chunk's distinct words and their hashes:
texts are cut into words once, and every cycle reads the numbers. Each step scans one shard, in a cycle, and counts in it
all phrases that are active, of whatever length: words during the first cycle, and a longer phrase from
the step after both of its subphrases (without its last, without its first word) have reached `least`
occurrences, for one full cycle. Steps end when no phrase is left whose cycle is not complete.

Scanning tasks know reached phrases by two bit maps of fixed size, all of them and those of the last
cycle: a phrase is active if both subphrases are in the first and one is in the second. Bits that phrases
share can only make a task count a phrase too early. Nothing depends on that: counts are kept by shard, and
a shard's count of a phrase is the same in whichever step it was made. So what a phrase has in the
shards counted so far never exceeds its occurrences, and is all of them after its cycle; subphrases of a
frequent phrase are frequent, hence every frequent phrase gets its cycle. More phrases than the bit
maps suit cost more rows to count, not results.

A step counts in its tasks, then joins new counts to those of the phrases still in their cycle by one
shuffle, and writes them; words, bigrams and so on of one kind meet only as counts, so no frequent phrase is a
hot key. What is shuffled and written is blocks: a row holds many phrases of a language and of one bucket of a hash of
their bytes, with their counts, as packed columns; a bucket's blocks meet in one task, which merges them language by
language. The number of buckets grows with the texts. Frequent phrases become rows; they, their cuts and their containing
phrases are joined as tables. The driver holds the bit maps and step numbers only.

Defined results: a null text is empty, a null language is 'und'. Each row of the table counts, also
copies. Words are bytes other than space and tab, so anything else that is no separator belongs to a
word. Empty tables, and languages without frequent phrases, give no rows. `docs` may have more columns.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrose.llm.common import discard, prepare, stored, table
from windrose.llm.words import ByteRule, Words, word_chunks
from windrose.session import new_path

PIECES = ByteRule(b" \t", b".,;:!?\n\x0b\x0c\r")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PROBES = 3
_KEPT_ROWS = 800_000
_SENT_ROWS = 50_000
_READ_BYTES = 16 << 20
#: Phrases of a block that is kept, and bytes of text for each bucket.
_BLOCK_ROWS = 100_000
_BUCKET_BYTES = 8 << 20
_CHUNK = 6 << 20


@dataclass(frozen=True)
class Mining:
    shards: int = 3
    longest: int = 4
    least: int = 30
    covered_percent: int = 80
    top: int = 2000
    bits: int = 1 << 25


PRODUCTION = Mining()


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def joined(first: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of its words; that of a word is its own."""
    for h in more:
        first = (first ^ (first >> np.uint64(29)) ^ (h * _MIX)) * _MIX
    return first


def _probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.concatenate([(hashes + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(_PROBES)])


def holds(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a bit map of 64-bit words holds each hash."""
    last, found = np.uint64(len(bitmap) * 64 - 1), np.ones(len(hashes), bool)
    at = slice(None)
    for i in range(_PROBES):
        some = hashes[at]
        # Few are left after the first probe.
        probes = (some + np.uint64(i) * ((some >> np.uint64(32)) | np.uint64(1)) if i else some) & last
        words = bitmap[(probes >> np.uint64(6)).view(np.int64)]
        found[at] = (words >> (probes & np.uint64(63))) & np.uint64(1)
        at = np.flatnonzero(found)
    return found


_CODED = "lang string, shard int, carried int, count int, lengths binary, text binary, hashes binary, numbers binary"
_POWERS = (np.cumprod(np.full(256, _MIX)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_BLOCK = "lang string, bucket int, fresh boolean, lengths binary, text binary, sizes binary, counts binary, last binary"
_MERGED = f"{_BLOCK}, done array<string>, done_size array<int>, done_n array<long>, hit array<string>"


def _spelled(phrases: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each phrase starts and the last ends, and the bytes."""
    _, places, content = phrases.buffers()
    offsets = np.frombuffer(places, np.int64)[phrases.offset : phrases.offset + len(phrases) + 1]
    return offsets - offsets[0], np.frombuffer(content or b"", np.uint8)[offsets[0] : offsets[-1]]


def _strings(lengths: np.ndarray, text: bytes) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(text))


def buckets_of(phrases: pa.Array, buckets: int) -> np.ndarray:
    """A bucket for each phrase, by its bytes."""
    offsets, data = _spelled(phrases)
    place = (np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))).astype(np.uint8)
    sums = np.zeros(len(data) + 1, np.uint32)
    np.cumsum((data + np.uint32(1)) * _POWERS[place], dtype=np.uint32, out=sums[1:])
    mixed = (sums[offsets[1:]] - sums[offsets[:-1]]).astype(np.uint64) * _MIX
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int32)


def _narrow(numbers: np.ndarray) -> bytes:
    return numbers.astype(np.min_scalar_type(numbers.max(initial=0))).tobytes()


def _wide_again(packed: bytes, count: int) -> np.ndarray:
    """What `_narrow` packed; the width follows from how many there were."""
    return np.frombuffer(packed, f"u{len(packed) // count}").astype(np.int64)


def _block(lang: str, bucket: int, phrases: pa.Array, sizes: np.ndarray, counts: np.ndarray, last: np.ndarray | None = None) -> dict:
    """A row of phrases; `counts` has a number for each, or with `last` one for each and each shard."""
    offsets, data = _spelled(phrases)
    return {
        "lang": lang,
        "bucket": bucket,
        "fresh": last is None,
        "lengths": np.diff(offsets).astype(np.uint32).tobytes(),
        "text": data.tobytes(),
        "sizes": sizes.tobytes(),
        "counts": _narrow(counts),
        "last": b"" if last is None else last.tobytes(),
    }


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    kinds |= {f"array<{name}>": pa.list_(kind) for name, kind in kinds.items()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, ddl.split(", "))])


class _Counts:
    """Counts of phrases by language and size, merged whenever many rows have come together."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.parts: dict[tuple[str, int], list[tuple[pa.Array, np.ndarray]]] = {}
        self.rows = 0

    def add(self, lang: str, size: int, phrases: pa.Array, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.setdefault((lang, size), []).append((phrases, n))
        self.rows += len(phrases)
        if self.rows >= _KEPT_ROWS:
            self.merge()
            if self.rows > _KEPT_ROWS * 3 // 4:
                yield from self.drain()

    def merge(self) -> None:
        self.rows = 0
        for key, parts in self.parts.items():
            if len(parts) == 1:
                self.rows += len(parts[0][1])
                continue
            coded = pa.concat_arrays([p for p, _ in parts]).dictionary_encode()
            n = np.zeros(len(coded.dictionary), np.int64)
            np.add.at(n, coded.indices.to_numpy(), np.concatenate([n for _, n in parts]))
            self.parts[key] = [(coded.dictionary, n)]
            self.rows += len(n)

    def drain(self) -> Iterator[pa.RecordBatch]:
        """All counts as blocks, one for each language and bucket."""
        self.merge()
        schema = _arrow_schema(_BLOCK)
        for lang in sorted({lang for lang, _ in self.parts}):
            own = [(size, *parts[0]) for (name, size), parts in self.parts.items() if name == lang]
            phrases = pa.concat_arrays([p for _, p, _ in own])
            sizes = np.repeat(np.array([size for size, _, _ in own], np.uint8), [len(p) for _, p, _ in own])
            n = np.concatenate([n for _, _, n in own])
            parts = [buckets_of(phrases[i : i + _SENT_ROWS], self.buckets) for i in range(0, len(phrases), _SENT_ROWS)]
            bucket = np.concatenate(parts)
            order = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
            rows, held = [], 0
            for i in np.flatnonzero(np.diff(bounds)):
                some = order[bounds[i] : bounds[i + 1]]
                rows.append(_block(lang, int(i), phrases.take(pa.array(some)), sizes[some], n[some]))
                held += len(some)
                if held >= _SENT_ROWS:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
        self.parts, self.rows = {}, 0
        pa.default_memory_pool().release_unused()


@dataclass(frozen=True)
class Coded:
    """Words as numbers: 0 between pieces, else one more than the place in `terms`.

    The first `carried` words belong to the chunk before, and so do the last as many terms.
    """

    terms: pa.Array
    hashes: np.ndarray
    numbers: np.ndarray
    carried: int


class Coder:
    """Numbers the words in the chunks of a language's texts."""

    def __init__(self, lang: str, longest: int) -> None:
        self.lang, self.longest = lang, longest
        self.tail: list[tuple[str, int]] = []

    def _with_tail(self, chunk: Words) -> tuple[pa.Array, np.ndarray, np.ndarray, int]:
        """The chunk after the last words of the piece that it continues."""
        terms = [t for t, piece in self.tail if chunk.continued and piece == chunk.pieces[0]]
        if not terms:
            return chunk.terms, chunk.ids, chunk.pieces, 0
        ids = np.concatenate([len(chunk.terms) + np.arange(len(terms)), chunk.ids])
        pieces = np.concatenate([np.full(len(terms), chunk.pieces[0]), chunk.pieces])
        return pa.concat_arrays([chunk.terms, pa.array(terms, chunk.terms.type)]), ids, pieces, len(terms)

    def coded(self, chunk: Words) -> Coded:
        terms, ids, pieces, carried = self._with_tail(chunk)
        last = ids[-(self.longest - 1) :]
        self.tail = list(zip(terms.take(pa.array(last)).to_pylist(), pieces[-len(last) :].tolist(), strict=True))
        place = np.arange(len(ids))
        place[1:] += np.cumsum(pieces[1:] != pieces[:-1])
        numbers = np.zeros(place[-1] + 1, np.int64)
        numbers[place] = ids + 1
        return Coded(terms, word_hashes(self.lang, terms.cast(pa.large_binary()).to_pylist()), numbers, carried)


class Scanner:
    """Counts the active phrases in the chunks of a language's texts."""

    def __init__(self, lang: str, longest: int, words: bool, reached: np.ndarray, recent: np.ndarray) -> None:
        self.longest, self.words = longest, words
        self.reached, self.recent = reached, recent
        self.coder = Coder(lang, longest)

    def counts(self, chunk: Words) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        """(size, phrases, occurrences)"""
        return self.coded_counts(self.coder.coded(chunk))

    def coded_counts(self, coded: Coded) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        """(size, phrases, occurrences)"""
        terms, numbers, carried = coded.terms, coded.numbers, coded.carried
        if self.words:
            own = len(terms) - carried
            n = np.bincount(numbers[carried:], minlength=len(terms) + 1)[1 : own + 1]
            yield 0, pa.array([""], terms.type), np.array([n.sum()])
            yield 1, terms[:own], n
        if not self.recent.any():
            return
        # The place between pieces is never reached, so no phrase crosses it.
        known, new = (np.append(False, found) for found in self._states(coded.hashes))
        hashes = np.append(np.uint64(0), coded.hashes)
        # Where reached phrases of size - 1 words start, their hashes, and whether they were reached in the last cycle.
        at = np.flatnonzero(known[numbers])
        start, recent = hashes[numbers[at]], new[numbers[at]]
        for size in range(2, self.longest + 1):
            both = np.flatnonzero(at[1:] - at[:-1] == 1)
            active = at[both[recent[both] | recent[both + 1]]]
            active = active[active + size > carried]
            if len(active):
                yield size, *self._phrases(terms, numbers, active, size)
            if size == self.longest:
                return
            at = at[both]
            start = joined(start[both], hashes[numbers[at + size - 1]])
            known, recent = self._states(start)
            at, start, recent = at[known], start[known], recent[known]

    def _states(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which have been reached, and which of them in the last cycle."""
        known = holds(self.reached, hashes)
        new = np.zeros(len(hashes), bool)
        at = np.flatnonzero(known)
        new[at] = holds(self.recent, hashes[at])
        return known, new

    @staticmethod
    def _phrases(terms: pa.Array, numbers: np.ndarray, at: np.ndarray, size: int) -> tuple[pa.Array, np.ndarray]:
        """Distinct phrases at places, and how often."""
        bits = len(terms).bit_length()
        if bits * size <= 64:
            keys = numbers[at].view(np.uint64)
            for i in range(1, size):
                keys = keys << np.uint64(bits) | numbers[at + i].view(np.uint64)
            keys, n = np.unique(keys, return_counts=True)
            low = np.uint64((1 << bits) - 1)
            parts = [(keys >> np.uint64(bits * (size - 1 - i)) & low).view(np.int64) for i in range(size)]
        else:
            number = numbers[at]
            for i in range(1, size):
                if i > 1:
                    number = np.unique(number, return_inverse=True)[1]
                number = number * (len(terms) + 1) + numbers[at + i]
            _, first, n = np.unique(number, return_index=True, return_counts=True)
            parts = [numbers[at[first] + i] for i in range(size)]
        words = [terms.take(pa.array(p - 1)) for p in parts]
        return pc.binary_join_element_wise(*words, pa.scalar(" ", terms.type)), n


def _larger(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """The rows in tables of some `least` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= least:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _coded(texts: DataFrame, how: Mining) -> DataFrame:
    """Rows of `_CODED` from (lang, text, shard): the words of chunks of a shard's texts of one language."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema(_CODED)
        for batch in _larger(batches, _READ_BYTES * how.shards):
            langs = batch.column("lang").combine_chunks().dictionary_encode()
            for shard in range(how.shards):
                dealt = pc.equal(batch.column("shard").combine_chunks(), shard)
                for number, lang in enumerate(langs.dictionary.to_pylist()):
                    mine = batch.column("text").filter(pc.and_(dealt, pc.equal(langs.indices, number))).combine_chunks()
                    coder = Coder(lang, how.longest)
                    for chunk in word_chunks(mine, PIECES, _CHUNK):
                        yield pa.RecordBatch.from_pylist([_coded_row(lang, shard, coder.coded(chunk))], schema)

    return texts.mapInArrow(code, _CODED)


def _coded_row(lang: str, shard: int, coded: Coded) -> dict:
    offsets, data = _spelled(coded.terms)
    return {
        "lang": lang,
        "shard": shard,
        "carried": coded.carried,
        "count": len(coded.numbers),
        "lengths": np.diff(offsets).astype(np.uint32).tobytes(),
        "text": data.tobytes(),
        "hashes": coded.hashes.tobytes(),
        "numbers": _narrow(coded.numbers),
    }


def _decoded(row: dict) -> Coded:
    terms = _strings(np.frombuffer(row["lengths"], np.uint32), row["text"])
    return Coded(terms, np.frombuffer(row["hashes"], np.uint64), _wide_again(row["numbers"], row["count"]), row["carried"])


def _scan(coded: DataFrame, how: Mining, buckets: int, words: bool, reached: np.ndarray, recent: np.ndarray) -> DataFrame:
    """Blocks of the active phrases and their counts, a phrase in several of its bucket's."""
    sent = coded.sparkSession.sparkContext.broadcast((reached, recent))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(buckets)
        for row in _blocks(batches):
            scanner = Scanner(row["lang"], how.longest, words, *sent.value)
            for size, phrases, n in scanner.coded_counts(_decoded(row)):
                yield from counts.add(row["lang"], size, phrases, n)
        yield from counts.drain()

    return coded.mapInArrow(scan, _BLOCK)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}


def _opened(blocks: list[dict]) -> tuple[pa.Array, np.ndarray]:
    """The phrases of blocks, and their sizes."""
    lengths = np.concatenate([np.frombuffer(b["lengths"], np.uint32) for b in blocks])
    return _strings(lengths, b"".join(b["text"] for b in blocks)), np.frombuffer(b"".join(b["sizes"] for b in blocks), np.uint8)


def _kept_counts(block: dict, shards: int) -> np.ndarray:
    """A kept block's counts, a column for each shard."""
    return _wide_again(block["counts"], len(block["sizes"]) * shards).reshape(-1, shards)


def _merge(blocks: DataFrame, how: Mining, step: int) -> DataFrame:
    """Blocks of the phrases whose cycle goes on after a step, frequent phrases whose cycle is over, and those that became frequent.

    `blocks` has all of a bucket and language in a run of rows.
    """
    shard = step % how.shards

    def merged(lang: str, bucket: int, blocks: list[dict]) -> Iterator[dict]:
        blocks.sort(key=itemgetter("fresh"))  # kept phrases come first, and once each
        kept, fresh = [b for b in blocks if not b["fresh"]], [b for b in blocks if b["fresh"]]
        phrases, sizes_of = _opened(blocks)
        coded = phrases.dictionary_encode()
        phrases, number = coded.dictionary, coded.indices.to_numpy()
        known = sum(len(b["sizes"]) for b in kept)
        sizes = np.zeros(len(phrases), np.uint8)
        sizes[number] = sizes_of
        last, counts = np.full(len(phrases), step, np.int32), np.zeros((len(phrases), how.shards), np.int64)
        if kept:
            last[:known] = np.frombuffer(b"".join(b["last"] for b in kept), np.int32)
            counts[:known] = np.concatenate([_kept_counts(b, how.shards) for b in kept])
        last[number[known:]] = step
        new = np.zeros(len(phrases), np.int64)
        if fresh:
            np.add.at(new, number[known:], np.concatenate([_wide_again(b["counts"], len(b["sizes"])) for b in fresh]))
        before = counts.sum(axis=1)
        counts[:, shard] = np.maximum(counts[:, shard], new)
        total = counts.sum(axis=1)

        over = last <= step - how.shards + 1
        done = np.flatnonzero(over & ((total >= how.least) | (sizes == 0)))
        hit = np.flatnonzero((before < how.least) & (total >= how.least) & (sizes >= 1) & (sizes < how.longest))
        if len(done) or len(hit):
            none = np.zeros(0, np.int64)
            found = {"done": phrases.take(pa.array(done)).to_pylist(), "done_size": sizes[done].tolist(), "done_n": total[done].tolist()}
            yield _block(lang, bucket, phrases[:0], sizes[:0], none, none) | found | {"hit": phrases.take(pa.array(hit)).to_pylist()}
        going = np.flatnonzero(~over)
        for first in range(0, len(going), _BLOCK_ROWS):
            some = going[first : first + _BLOCK_ROWS]
            yield _block(lang, bucket, phrases.take(pa.array(some)), sizes[some], counts[some], last[some])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema(_MERGED)
        for (bucket, lang), run in groupby(_blocks(batches), itemgetter("bucket", "lang")):
            for row in merged(lang, bucket, list(run)):
                yield pa.RecordBatch.from_pylist([row], schema)
        pa.default_memory_pool().release_unused()

    return blocks.mapInArrow(merge, _MERGED)


def _counted(state: DataFrame, how: Mining) -> DataFrame:
    """(lang, size, phrase, n) of the frequent phrases in kept blocks."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            phrases, sizes = _opened([block])
            total = _kept_counts(block, how.shards).sum(axis=1)
            some = np.flatnonzero((total >= how.least) | (sizes == 0))
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.repeat(pa.scalar(block["lang"]), len(some)),
                    "size": pa.array(sizes[some], pa.int32()),
                    "phrase": phrases.take(pa.array(some)).cast(pa.string()),
                    "n": pa.array(total[some], pa.int64()),
                }
            )

    return state.mapInArrow(opened, "lang string, size int, phrase string, n long")


def _phrase_hashes(lang: str, phrases: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of phrases, those of one size together."""
    words = pc.split_pattern(phrases, " ")
    coded = words.flatten().dictionary_encode()
    hashes = word_hashes(lang, [w.encode() for w in coded.dictionary.to_pylist()])[coded.indices.to_numpy()]
    sizes = pc.list_value_length(words).to_numpy()
    first = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        at = first[sizes == size]
        yield joined(*[hashes[at + i] for i in range(size)])


def _marked(phrases: DataFrame, how: Mining) -> np.ndarray:
    """A bit map of (lang, phrase) rows; its words that have bits come to the driver."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            langs = batch.column("lang").dictionary_encode()
            for number, lang in enumerate(langs.dictionary.to_pylist()):
                found += _phrase_hashes(lang, batch.column("phrase").filter(pc.equal(langs.indices, number)))
            probes = np.unique(_probes(np.concatenate(found), how.bits))
            slot, start = np.unique(probes >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (probes & np.uint64(63)), start) if len(slot) else probes
            yield pa.RecordBatch.from_pydict({"slot": slot.astype(np.int64), "bits": bits.view(np.int64)})

    marks = phrases.mapInArrow(mark, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(how.bits // 64, np.uint64)
    bitmap[marks["slot"].to_numpy()] = marks["bits"].to_numpy().view(np.uint64)
    return bitmap


def frequent_phrases(docs: DataFrame, how: Mining = PRODUCTION) -> DataFrame:
    """(lang, size, phrase, n): phrases of 1 to `longest` words with `least` occurrences and more.

    Size 0 has a language's number of words.
    """
    spark = prepare(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(how.shards)).cast("int").alias("shard"),
    )
    shards = new_path(spark, "phrase-shards")
    coded = _coded(texts, how)
    coded.write.partitionBy("shard").parquet(shards)
    whole = spark.read.schema(coded.schema).parquet(shards)

    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(max(1, -(-size // _BUCKET_BYTES)), 1 << 20)
    state, state_path, found = None, None, []
    recent = []  # bit maps of what each of the last steps of a cycle reached
    reached = np.zeros(how.bits // 64, np.uint64)
    step = 0
    while step < how.shards or any(r.any() for r in recent):
        now = np.bitwise_or.reduce(recent) if recent else np.zeros_like(reached)
        blocks = _scan(whole.filter(F.col("shard") == step % how.shards), how, buckets, step < how.shards, reached, now)
        if state is not None:
            blocks = blocks.unionByName(state)
        dealt = blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket", "lang")
        merged, path = stored(_merge(dealt, how, step), "phrase-counts")
        if state_path:
            discard(spark, state_path)
        one = F.explode(F.arrays_zip("done", "done_size", "done_n")).alias("one")
        complete = merged.select("lang", one).select("lang", "one.done_size", "one.done", "one.done_n").toDF("lang", "size", "phrase", "n")
        complete, _ = stored(complete, "phrases")
        found.append(complete)
        marked = _marked(merged.select("lang", F.explode("hit").alias("phrase")), how)
        recent = [*recent, marked][-how.shards :]
        reached = reached | marked
        kept = merged.filter(F.octet_length("sizes") > 0)
        state, state_path = kept.select(*(name.split(" ")[0] for name in _BLOCK.split(", "))), path
        step += 1
    found.append(_counted(state, how))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    # A phrase counted again by chance, after its cycle, has fewer shards then.
    result, _ = stored(every.groupBy("lang", "size", "phrase").agg(F.max("n").alias("n")), "frequent-phrases")
    discard(spark, shards, state_path)
    return result


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def collocations(docs: DataFrame, how: Mining = PRODUCTION) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): see the module."""
    frequent = frequent_phrases(docs, how)
    phrases = frequent.filter(F.col("size") >= 2).select("lang", "size", "phrase", F.col("n").alias("a"))

    # Phrases inside longer ones that have nearly as many occurrences.
    words = F.split("phrase", " ")
    inner = phrases.filter(F.col("size") > 2).select(
        "lang",
        F.col("a").alias("longer"),
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("size") - 1),
                    lambda k: F.transform(
                        F.sequence(F.lit(1), F.col("size") - k + 1), lambda i: F.array_join(F.slice(words, i, k), " ")
                    ),
                )
            )
        ).alias("phrase"),
    )
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    contained = _wide("longer") * 100 >= _wide("a") * how.covered_percent
    free = phrases.join(inner, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | ~contained).drop("longer")

    cut = free.select("lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    parts = frequent.filter(F.col("size") >= 1)
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    score = F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0))) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    scored = (
        cut.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .withColumn("score", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    totals = frequent.filter(F.col("size") == 0).select("lang", "n")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= how.top)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_extract_all(text, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM docs
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sizes AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
), grams AS (
  SELECT lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM worded, (VALUES (1), (2), (3), (4)) AS v(k)
), f AS (
  SELECT lang, k, phrase, count(*)::HUGEINT AS n FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 30
), candidates AS (
  SELECT lang, k AS size, phrase, string_split(phrase, ' ') AS w, n AS a FROM f WHERE k >= 2
), inner_phrases AS (
  SELECT c.lang, c.a AS longer, unnest([array_to_string(c.w[i : i + v.k - 1], ' ') FOR i IN range(1, c.size - v.k + 2)]) AS phrase
  FROM candidates c, (VALUES (2), (3)) AS v(k) WHERE v.k < c.size
), contained AS (
  SELECT DISTINCT c.lang, c.phrase FROM candidates c
  JOIN inner_phrases i ON i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.longer >= 80 * c.a
), free AS (
  SELECT c.* FROM candidates c
  WHERE NOT EXISTS (SELECT 1 FROM contained x WHERE x.lang = c.lang AND x.phrase = c.phrase)
), cuts AS (
  SELECT c.lang, c.phrase, c.a, v.k, l.n AS l, r.n AS r, (2000000::HUGEINT * c.a) // (l.n + r.n) AS score
  FROM free c JOIN (VALUES (1), (2), (3)) AS v(k) ON v.k < c.size
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : v.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[v.k + 1 :], ' ')
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cuts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE place = 1
)
SELECT x.lang, x.rank::BIGINT AS rank, x.phrase, x.a::BIGINT AS a, x.l::BIGINT AS l, x.r::BIGINT AS r, s.n, x.score::BIGINT AS score
FROM ranked x JOIN sizes s ON s.lang = x.lang WHERE x.rank <= 2000
"""

QUERIES = {"op13_phrase_collocations": op13_phrase_collocations}
ORACLE_SQL = {"op13_phrase_collocations": _SQL}
