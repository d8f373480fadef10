"""Token ids in Arrow files of equal-length sequences with masks, and reading them back.

A folder holds numbered parts. `part-N.arrow` is an Arrow IPC file whose record batches have two
columns of fixed-size lists: `ids`, one sequence of `length` token ids in the smallest unsigned type
that holds the vocabulary, and `mask`, a bit for each of them (least significant first, 1 for a token,
0 for the padding that ends a part). Sequences have equal length, so sequence i is found by arithmetic
and read from a memory map without a copy. `part-N.docs.arrow` says which tokens belong to which
document. Documents lie in ascending doc_id order within and across parts, each ended by `end_id`, and run
over sequence ends.

Documents are sorted by ranges of doc_id; each task encodes and writes one part in bounded batches under
a temporary name and moves it into place, so a task that runs again or twice leaves the same files. Only
one row for each part goes through one task, to sum up the parts before it.

The encoder cuts texts at single spaces between two characters that are no white space, where the
tokenizer's own pattern always cuts. It takes texts in groups of bounded size: Arrow splits them and
numbers their distinct pieces, the library encodes those it has not met yet, many to a call, and the ids
of all pieces are gathered by their numbers. Texts with other white space around spaces go one by one.
Strings of added tokens, special ones too, become those tokens' ids, as the library does by default; the
text between them is cut.

Defined results: a null text is empty and consists of the end id alone; a null doc_id comes first; rows
that repeat an id are documents of their own, in the order of a hash of their texts; an empty table gives
no parts. `docs` may have more columns.
"""

import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrose.llm.common import prepare, stored, table
from windrose.session import new_path

_MANIFEST = "part int, path string, documents long, tokens long"
_PIECE = 1 << 20
_KEPT_PIECES = 150_000
#: Characters of a group of texts, and pieces that one call of the library encodes.
_GROUP = 2 << 20
_JOINED = 500
_CUT = re.compile(r"(?<=\S) (?=\S)")
_CLOSE = re.compile(r" \s|\s ")
_ASCII_CLOSE = [x for c in "\t\n\v\f\r\x1c\x1d\x1e\x1f" for x in (f" {c}", f"{c} ")] + ["  "]
#: Within a piece the pattern also cuts between an ASCII letter and a mark, and around a line feed
#: between ASCII characters that are no white space.
_INNER = re.compile(r"(?<=[A-Za-z])(?=[,.!?;:%*#$&])|(?<=[!-~])(?=\n[!-~])|(?<=[!-~]\n)(?=[!-~])")


@dataclass(frozen=True)
class TokenFiles:
    length: int = 2048
    sequences_per_batch: int = 256
    part_bytes: int = 16 << 20
    end_id: int = 0


PRODUCTION = TokenFiles()


#: Byte-level pre-tokenizers whose pattern allows the cuts below.
_CUTTABLE = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
#: All letters before this character have long been letters in every Unicode version.
_FIRST_UNSURE = "\u0530"


def _byte_characters() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: a byte's own character if it can be seen.

    The others are numbered on from 256.
    """
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    unseen = [b for b in range(256) if b not in seen]
    return {b: chr(256 + i) for i, b in enumerate(unseen)}


class _Pieces(dict):
    """Ids of pieces that follow a space; new ones are encoded when they are asked for."""

    def __init__(self, encode, word) -> None:
        super().__init__()
        self._encode, self._word, self._inner = encode, word, {}

    def __missing__(self, piece: str) -> bytes:
        first, *rest = _INNER.split(piece)
        ids = self.get(first) if rest else None
        if ids is None:
            ids = self._word(first) if first.isalpha() and max(first) < _FIRST_UNSURE else self._encode(" " + first)
        if len(self) >= _KEPT_PIECES:
            return ids + b"".join(map(self._encode, rest))
        self[first] = ids
        for run in rest:
            known = self._inner.get(run)
            if known is None:
                known = self._encode(run)
                if len(self._inner) < _KEPT_PIECES:
                    self._inner[run] = known
            ids += known
        self[piece] = ids
        return ids


class Encoder:
    """Text to ids with a tokenizer of the tokenizers library, given as its JSON.

    Cuts texts into pieces only if the tokenizer is a byte-level one with the usual pattern. Without
    `added_tokens` special tokens' strings are ordinary text.
    """

    def __init__(self, definition: str, added_tokens: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = not added_tokens
        self.type = np.dtype(np.min_scalar_type(max(1, self.tokenizer.get_vocab_size() - 1)))
        parts = json.loads(definition)
        before = parts.get("pre_tokenizer") or {}
        self.cuttable = not parts.get("normalizer") and before.items() >= _CUTTABLE.items()
        added = parts.get("added_tokens") or [] if added_tokens else []
        # Tokens that also take white space beside them, or whole words only, are left to the library.
        plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
        self.cuttable = self.cuttable and plain
        self._added = {t["content"]: t["id"] for t in added if t["content"]}
        longest_first = sorted(self._added, key=len, reverse=True)
        self._at_added = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.pieces = _Pieces(self._encode, self._word)
        self._known: dict[str, bytes] = {}
        self._characters = _byte_characters()
        self._space = self._characters[ord(" ")]
        # No piece holds a space but as its first character: a token that starts with one opens a piece.
        names = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size() if self.cuttable else 0))
        self._opens = np.array([n is not None and n.startswith(self._space) for n in names], bool)
        self._joinable = self.cuttable and not any(" " in content for content in self._added)
        self._code = "B" if self.type == np.uint8 else "H" if self.type == np.uint16 else "I"

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self._code}", *ids)

    def _encode(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, letters: str) -> bytes:
        """A space and a run of letters are one piece of the pattern: straight to the merges."""
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(self._characters)
        return self._packed([t.id for t in self.tokenizer.model.tokenize(self._space + letters)])

    def _parts(self, text: str) -> Iterator[str]:
        """Runs of the text that end before a cut, of about `_PIECE` characters."""
        start = 0
        while len(text) - start > 2 * _PIECE:
            cut = _CUT.search(text, start + _PIECE)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def encoded(self, text: str) -> bytes:
        """The ids as an array's bytes."""
        if not text:
            return b""
        if not self.cuttable:
            return self._encode(text)
        if not any(map(text.__contains__, self._added)):
            return b"".join(map(self._part, self._parts(text)))
        runs = self._at_added.split(text)
        return b"".join(
            self._packed([self._added[run]]) if i % 2 else b"".join(map(self._part, self._parts(run)))
            for i, run in enumerate(runs)
            if run
        )

    def _part(self, part: str) -> bytes:
        close = any(map(part.__contains__, _ASCII_CLOSE)) if part.isascii() else _CLOSE.search(part)
        pieces = _CUT.split(part) if close else part.split(" ")
        # A part after a cut starts with its space.
        first = pieces.pop(0) if pieces[0] else " " + pieces.pop(0) + pieces.pop(0)
        return b"".join([self._encode(first), *map(self.pieces.__getitem__, pieces)])


    def encoded_each(self, texts: Iterable[str]) -> Iterator[bytes]:
        """`encoded` of every text, in order."""
        units = chain.from_iterable(map(self._units, texts))
        pending: list[bytes] = []
        while group := self._group(units):
            for ids, (_, ends, _) in zip(self._encoded_group(group), group, strict=True):
                pending.append(ids)
                if ends:
                    yield b"".join(pending)
                    pending = []

    def _units(self, text: str) -> Iterator[tuple[str, bool, bool]]:
        """(part of the text, whether it is the last, whether it may be split at spaces)."""
        if not text or not self._joinable or any(map(text.__contains__, self._added)):
            yield text, True, False
            return
        *parts, last = self._parts(text)
        for part in parts:
            yield part, False, True
        yield last, True, True

    @staticmethod
    def _group(units: Iterator[tuple[str, bool, bool]]) -> list[tuple[str, bool, bool]]:
        group, size = [], 0
        for unit in units:
            group.append(unit)
            size += len(unit[0])
            if size >= _GROUP:
                break
        return group

    def _encoded_group(self, units: list[tuple[str, bool, bool]]) -> list[bytes]:
        """Splits units at all spaces; those where not every space is a cut go the other way."""
        heads = [unit.partition(" ") if plain else ("", "", "") for unit, _, plain in units]
        tails = [tail for _, _, tail in heads]
        lists = pc.split_pattern(pa.array(tails, pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found, opens_blank, ends_blank = self._pieces_ids(pieces)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.type.itemsize
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(found), self.type)
        codes, bounds = coded.indices.to_numpy(), lists.offsets.to_numpy()
        results = []
        for (unit, _, _), (head, space, _), first, last in zip(units, heads, bounds[:-1], bounds[1:], strict=True):
            some = codes[first:last]
            # White space that ends the last piece ends the unit.
            if not space or head[-1:].isspace() or opens_blank[some].any() or ends_blank[some[:-1]].any():
                results.append(self.encoded(unit))
                continue
            counts = lengths[some]
            ends = np.cumsum(counts)
            at = np.repeat(starts[some] - ends + counts, counts) + np.arange(ends[-1])
            results.append((self._encode(head) if head else b"") + flat[at].tobytes())
        return results

    def _pieces_ids(self, pieces: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The ids of distinct pieces that each follow a space, and which begin or end with white space.

        Empty pieces count as such and, like all that begin with white space, get no ids. Only pieces
        without white space at either end are kept for later groups.
        """
        found = list(map(self._known.get, pieces))
        opens_blank, ends_blank = np.zeros((2, len(pieces)), bool)
        new = []
        for i in (i for i, ids in enumerate(found) if ids is None):
            if not pieces[i] or pieces[i][0].isspace():
                found[i] = b""
                opens_blank[i] = ends_blank[i] = True
            elif pieces[i][-1].isspace():
                found[i] = self._encode(" " + pieces[i])
                ends_blank[i] = True
            else:
                new.append(i)
        for start in range(0, len(new), 64 * _JOINED):
            some = new[start : start + 64 * _JOINED]
            runs = [some[i : i + _JOINED] for i in range(0, len(some), _JOINED)]
            joined = [" " + " ".join(pieces[i] for i in run) for run in runs]
            for run, encoding in zip(runs, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
                ids = np.array(encoding.ids, self.type)
                opens = np.flatnonzero(self._opens[ids])
                if len(opens) == len(run) and opens[0] == 0:
                    packed = ids.tobytes()
                    bounds = [*(opens * self.type.itemsize).tolist(), len(packed)]
                    for i, a, b in zip(run, bounds[:-1], bounds[1:], strict=True):
                        found[i] = packed[a:b]
                else:
                    for i in run:
                        found[i] = self._encode(" " + pieces[i])
            room = max(0, _KEPT_PIECES - len(self._known))
            self._known.update((pieces[i], found[i]) for i in some[:room])
        return found, opens_blank, ends_blank


@lru_cache(maxsize=2)
def _encoder(definition: str) -> Encoder:
    return Encoder(definition, added_tokens=True)


def _sequence_schema(kind: np.dtype, length: int) -> pa.Schema:
    return pa.schema(
        [
            ("ids", pa.list_(pa.from_numpy_dtype(kind), length)),
            ("mask", pa.list_(pa.uint8(), -(-length // 8))),
        ]
    )


_DOCUMENT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class _PartWriter:
    """Collects ids and writes a batch whenever enough sequences are full."""

    def __init__(self, file, kind: np.dtype, how: TokenFiles) -> None:
        self.kind, self.how = np.dtype(kind), how
        self.schema = _sequence_schema(self.kind, how.length)
        self.writer = pa.ipc.new_file(file, self.schema)
        self.buffer, self.tokens = bytearray(), 0

    def add(self, ids: bytes) -> None:
        self.buffer += ids
        self.tokens += len(ids) // self.kind.itemsize
        batch = self.how.length * self.how.sequences_per_batch * self.kind.itemsize
        while len(self.buffer) >= batch:
            self._write(np.frombuffer(bytes(self.buffer[:batch]), self.kind))
            del self.buffer[:batch]

    def _write(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.how.length)
        padded = np.zeros(rows * self.how.length, self.kind)
        padded[: len(ids)] = ids
        mask = (np.arange(len(padded)) < len(ids)).reshape(rows, self.how.length)
        mask = np.packbits(mask, axis=1, bitorder="little").ravel()
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), type=field.type)
            for values, field in zip((padded, mask), self.schema, strict=True)
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.buffer:
            self._write(np.frombuffer(bytes(self.buffer), self.kind))
        self.writer.close()


def write_token_files(docs: DataFrame, definition: str, folder: str, how: TokenFiles = PRODUCTION) -> DataFrame:
    """Writes doc_id and text of all rows; the manifest (part, path, documents, tokens)."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // how.part_bytes))
    tie = F.xxhash64("text")
    order = [F.col("doc_id").asc_nulls_first(), tie.asc()]
    sent = spark.sparkContext.broadcast(definition)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        encoder = _encoder(sent.value)
        task = TaskContext.get()
        place, root = fs.FileSystem.from_uri(folder)
        place.create_dir(root, recursive=True)
        end = np.array([how.end_id], encoder.type).tobytes()
        paths = [f"{root}/part-{task.partitionId():06d}{kind}.arrow" for kind in ("", ".docs")]
        drafts = [f"{p}.{task.taskAttemptId()}.tmp" for p in paths]
        documents = 0
        with place.open_output_stream(drafts[0]) as out, place.open_output_stream(drafts[1]) as out2:
            writer = _PartWriter(out, encoder.type, how)
            index = pa.ipc.new_file(out2, _DOCUMENT_SCHEMA)
            for batch in chain([first], batches):
                starts, counts = [], []
                for ids in encoder.encoded_each(text.as_py() or "" for text in batch.column("text")):
                    starts.append(writer.tokens)
                    writer.add(ids + end)
                    counts.append(writer.tokens - starts[-1])
                index.write_batch(
                    pa.RecordBatch.from_arrays(
                        [batch.column("doc_id"), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())],
                        schema=_DOCUMENT_SCHEMA,
                    )
                )
                documents += batch.num_rows
            writer.close()
            index.close()
        for draft, path in zip(drafts, paths, strict=True):
            place.move(draft, path)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([task.partitionId()], pa.int32()),
                "path": pa.array([f"{folder.rstrip('/')}/{os.path.basename(paths[0])}"]),
                "documents": pa.array([documents], pa.int64()),
                "tokens": pa.array([writer.tokens], pa.int64()),
            }
        )

    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stored(ordered.mapInArrow(write, _MANIFEST), "token-manifest")[0]


class TokenFile:
    """One part: sequences by number, tokens by place, and its documents."""

    def __init__(self, path: str) -> None:
        place, name = fs.FileSystem.from_uri(path)
        mapped = isinstance(place, fs.LocalFileSystem)
        source = pa.memory_map(name) if mapped else place.open_input_file(name)
        self._file = pa.ipc.open_file(source)
        self.length = self._file.schema.field("ids").type.list_size
        self._batches = [self._file.get_batch(i) for i in range(self._file.num_record_batches)]
        self._rows = max((len(b) for b in self._batches), default=1)
        self._documents = name.removesuffix(".arrow") + ".docs.arrow"
        self._place = place

    def __len__(self) -> int:
        return sum(map(len, self._batches))

    def _values(self, column: str, sequence: int) -> np.ndarray:
        lists = self._batches[sequence // self._rows].column(column)
        size, row = lists.type.list_size, sequence % self._rows
        return lists.values.to_numpy(zero_copy_only=True)[row * size : (row + 1) * size]

    def sequence(self, number: int) -> np.ndarray:
        return self._values("ids", number)

    def mask(self, number: int) -> np.ndarray:
        return np.unpackbits(self._values("mask", number), count=self.length, bitorder="little")

    def tokens(self, start: int, count: int) -> np.ndarray:
        """Tokens by their place in the part, over sequence ends."""
        size = self.length * self._rows
        runs = [
            batch.column("ids").values.to_numpy(zero_copy_only=True)[max(0, start - i * size) : max(0, start + count - i * size)]
            for i, batch in enumerate(self._batches[start // size : (start + count - 1) // size + 1], start // size)
        ]
        return np.concatenate(runs)

    def documents(self) -> Iterator[pa.RecordBatch]:
        with self._place.open_input_file(self._documents) as source:
            reader = pa.ipc.open_file(source)
            for i in range(reader.num_record_batches):
                yield reader.get_batch(i)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True):
            part = TokenFile(path)
            for documents in part.documents():
                starts, counts = (documents.column(c).to_numpy() for c in ("start", "n_tokens"))
                digests = [
                    zlib.crc32(part.tokens(s, n).astype("<u4").tobytes())
                    for s, n in zip(starts, counts, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [documents.column("doc_id"), pa.array(starts + before), documents.column("n_tokens"), pa.array(digests, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents, from the files."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.select("part", "path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))
    parts, _ = stored(parts, "token-parts")
    count = max(1, parts.count())
    return (
        parts.repartition(min(count, 10_000), "part")
        .select("path", "before")
        .mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """The definition of an installed public tokenizer."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def tokenised(docs: DataFrame, definition: str, how: TokenFiles = PRODUCTION) -> DataFrame:
    """Writes token files for `docs` to the shared folder and returns what they hold per document."""
    folder = new_path(docs.sparkSession, "tokens")
    return read_documents(write_token_files(docs, definition, folder, how))


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenised(table(spark, folder, "documents").select("doc_id", "text"), public_tokenizer())


QUERIES = {"op6_token_files": op6_token_files}
ORACLE_SQL: dict[str, str] = {}
