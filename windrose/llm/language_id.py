"""Language identification with bit-sliced Bloom filters over letter trigrams.

A language is the set of trigrams that make up at least `least_share` of its training text, hence at
most 1 / least_share of them. All languages share one table of rows with a bit per language: adding a
trigram of a language sets that language's bit in a few hashed rows, and the conjunction of a trigram's
rows is the set of all languages that contain it. For a text, the trigrams in each language are
counted, corrected for the rate at which that language's filter answers yes by chance, and the
language with most of them is predicted; the score is its share of all trigrams. Equal counts go to the
language with more training text.

Trigrams lie within words; a word's ends count as a letter. Letters are Unicode letters, in lower
case. Whole texts are read, in pieces of bounded size.

Training takes at most about `rows_per_language` labelled rows of each language, chosen by a hash;
within them all text counts. The model is at most `most_languages` filters of fixed size.

Defined results: a text that is null or has no letter is `und` with score 0; a text whose trigrams are
in no language goes to the language with most training text with score 0; without any labelled row all
texts are `und`; a null doc_id is neither held out nor learned from; rows repeat as they come. Added
columns carry underscores in front if `docs` has one of that name.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.llm.common import free_name, prepare, table

UNKNOWN = "und"
_CODE_BITS = 21
_PIECE = 1 << 18
_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64
)


@dataclass(frozen=True)
class Training:
    rows_per_language: int = 5000
    least_share: float = 1e-4
    most_languages: int = 256
    table_bits: int = 18


PRODUCTION = Training()
#: Texts in which fewer of the trigrams belong to the predicted language are rejected by `recognised`.
LEAST_SCORE = 0.2


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _pieces(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """The texts as (number, part) in lists of bounded size; parts of a text overlap by two.

    No trigram is complete within the overlap, so each is seen once.
    """
    batch, size = [], 0
    for number, text in enumerate(texts):
        padded = f" {text.lower()} "
        for start in range(0, max(1, len(padded) - 2), _PIECE):
            part = padded[start : start + _PIECE + 2]
            batch.append((number, part))
            size += len(part)
            if size >= _PIECE:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def _trigrams(parts: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """All trigrams of the parts as numbers, and the number of the text of each."""
    codes = np.frombuffer("".join(p for _, p in parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = [len(p) for _, p in parts]
    part = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
    letter = _letters()[codes]
    first = np.zeros(len(codes), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    # One boundary stands for a run of other characters.
    keep = letter | first | np.roll(letter, 1)
    codes, part = np.where(letter, codes, 0)[keep].astype(np.int64), part[keep]
    whole = (codes[1:-1] != 0) & (part[:-2] == part[2:])
    grams = (codes[:-2] << (2 * _CODE_BITS)) | (codes[1:-1] << _CODE_BITS) | codes[2:]
    owner = np.fromiter((n for n, _ in parts), np.int64, len(parts))
    return grams[whole], owner[part[:-2][whole]]


def _rows_of(grams: np.ndarray, bits: int) -> np.ndarray:
    """The filter rows of each trigram, one line per hash."""
    mixed = grams.astype(np.uint64)[None, :] * _ODD[:, None]
    mixed ^= mixed >> np.uint64(32)
    return (mixed * _ODD[::-1, None]) >> np.uint64(64 - bits)


@dataclass(frozen=True)
class Filters:
    """Languages, most training text first; `slices[word][row]` holds 64 languages' bits."""

    languages: list[str]
    slices: np.ndarray
    by_chance: np.ndarray
    bits: int

    @staticmethod
    def of(languages: list[str], grams: list[np.ndarray], bits: int) -> "Filters":
        slices = np.zeros(((len(languages) + 63) // 64, 1 << bits), np.uint64)
        filled = []
        for i, own in enumerate(grams):
            rows = np.unique(_rows_of(own, bits))
            slices[i // 64, rows] |= np.uint64(1) << np.uint64(i % 64)
            filled.append(len(rows) / (1 << bits))
        return Filters(languages, slices, np.array(filled) ** len(_ODD), bits)

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams of each text, and how many of them each language contains."""
        total = np.zeros(len(texts))
        found = np.zeros((len(self.languages), len(texts)))
        for parts in _pieces(texts):
            grams, owner = _trigrams(parts)
            rows = _rows_of(grams, self.bits)
            total += np.bincount(owner, minlength=len(texts))
            for word, one in enumerate(self.slices):
                masks = np.bitwise_and.reduce(one[rows], axis=0)
                for bit, i in enumerate(range(64 * word, min(64 * word + 64, len(self.languages)))):
                    has = (masks >> np.uint64(bit)) & np.uint64(1)
                    found[i] += np.bincount(owner, weights=has, minlength=len(texts))
        return total, found

    def predicted(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        total, found = self.counts(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        chance = self.by_chance[:, None]
        likely = np.maximum(0, found - chance * total) / (1 - chance)
        best = likely.argmax(axis=0)
        score = np.clip(likely.max(axis=0) / np.maximum(total, 1), 0, 1)
        names = [self.languages[b] if n else UNKNOWN for b, n in zip(best, total, strict=True)]
        return names, score


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, languages = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        names = sorted(set(languages))
        place = np.array([names.index(n) for n in languages])
        for parts in _pieces(texts):
            grams, owner = _trigrams(parts)
            for i, name in enumerate(names):
                own, counts = np.unique(grams[place[owner] == i], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(own), pa.string()), pa.array(own), pa.array(counts)],
                    names=["lang", "gram", "n"],
                )


def trained(labelled: DataFrame, training: Training = PRODUCTION) -> Filters:
    """Learns from rows with doc_id, text and lang."""
    prepare(labelled.sparkSession)
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sizes = known.groupBy("lang").agg(F.count("*").alias("rows"))
    rows = sizes.orderBy(F.desc("rows"), "lang").limit(training.most_languages + 1).collect()
    if len(rows) > training.most_languages:
        raise ValueError(f"More than {training.most_languages} languages")
    if not rows:
        return Filters.of([], [], training.table_bits)
    # 2^31 places; a language's rows below its share of them are taken.
    place = F.shiftrightunsigned(F.xxhash64(F.lit(3), "doc_id"), 33)
    taken = [
        (F.col("lang") == r["lang"]) & (place < int(min(1, training.rows_per_language / r["rows"]) * (1 << 31)))
        for r in rows
    ]
    chosen = known.where(F.coalesce(*[F.when(t, True) for t in taken], F.lit(False)))
    counts = (
        chosen.select("text", "lang")
        .mapInArrow(_counted, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    common = counts.join(totals, "lang").where(F.col("n") >= F.col("total") * training.least_share)
    # At most 1 / least_share rows of each language.
    found = common.toPandas()
    order = found.groupby("lang")["total"].first().reset_index().sort_values(["total", "lang"], ascending=[False, True])
    languages = list(order["lang"])
    grams = [found.loc[found["lang"] == name, "gram"].to_numpy() for name in languages]
    return Filters.of(languages, grams, training.table_bits)


def with_language(docs: DataFrame, filters: Filters) -> DataFrame:
    """`docs` with lang_pred and score, from the column text alone."""
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(filters)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        names, scores = model.value.predicted([t or "" for t in texts])
        return pd.DataFrame({"lang_pred": names, "score": scores})

    found = free_name(docs, "_found")
    name, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    return docs.withColumn(found, predicted(F.col("text"))).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col(f"{found}.lang_pred").alias(name),
        F.col(f"{found}.score").alias(score),
    )


def recognised(docs: DataFrame, training: Training = PRODUCTION, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of `docs` whose text is in a learned language; columns as in `docs`."""
    filters = trained(docs.where(~held_out(F.col("doc_id"))), training)
    judged = with_language(docs, filters)
    name, score = judged.columns[-2:]
    kept = judged.where((F.col(name) != UNKNOWN) & (F.col(score) >= least_score))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    filters = trained(documents.where(~held_out(F.col("doc_id"))))
    return with_language(documents.select("doc_id", "text"), filters).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


QUERIES = {"op10_language_id": op10_language_id}
ORACLE_SQL: dict[str, str] = {}
