"""SimHash near-duplicates through an inverted index over the bytes of the fingerprint.

Fingerprints that differ in at most k bits agree in at least 8 - k of their 8 positional bytes, and
therefore in all bytes of at least one posting key: the positions are dealt into k + 2 groups, and a
key is the bytes of two of them. (A key of a single byte would put 1/256 of all rows in one list.)
Fingerprints under one key are paired, the positional bytes that they share are tallied, pairs below
8 - k are left out, and the rest is verified by counting bits. A key with more than
`most_in_list` fingerprints is not paired: its fingerprints are tied, without any loss, through all
values that differ from them in at most one bit, which two fingerprints share exactly if they
differ in at most two bits. So work grows with rows, not with the square of a group.

Only distinct fingerprints enter the index, so exact copies cost nothing. Links are resolved by
`components`. Texts never leave the first pass.

Defined results: a null or wordless text has the fingerprint zero and is linked like any other; a
repeated row belongs to the group of its copy; a null doc_id counts only if a group has no other; an
empty table gives no rows.
"""

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrose.llm.common import discard, free_name, prepare, stored, table
from windrose.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
_SEED = 42
_BYTES = 8
#: Texts are cut into words in pieces of so many bytes, so that a long text needs no long list.
_PIECE = 1 << 20
#: Longest list that is paired; longer ones are tied through their one-bit neighbours.
MOST_IN_LIST = 24


def _words(text: bytes):
    """Lists of lower-cased words of successive pieces of a text."""
    end = 0
    while end < len(text):
        start, end = end, min(len(text), end + _PIECE)
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1  # whole words only
        yield text[start:end].lower().split()


def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit fingerprint of a text."""
    counts, total, carried, shingles = np.zeros(64, np.int64), 0, [], []
    digest = xxhash.xxh64_intdigest
    for piece in _words((text or "").encode("utf-8", "surrogatepass")):
        words = carried + piece
        shingles = list(map(b" ".join, zip(*[words[i:] for i in range(shingle_words)], strict=False)))
        if shingles:
            hashes = np.fromiter((digest(s, _SEED) for s in shingles), np.uint64, len(shingles))
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
            total += len(shingles)
        carried = words[-(shingle_words - 1) :] if shingle_words > 1 else []
        if total == 0:
            carried = words
    if total == 0:
        if not carried:
            return 0
        return int(np.uint64(digest(b" ".join(carried), _SEED)).astype(np.int64))
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle_words) for t in texts], dtype="int64")

    return hashed(text)


def _byte(value: Column, place: int) -> Column:
    return F.shiftrightunsigned(value, 8 * place).bitwiseAND(F.lit(255))


def _masks(max_bits: int) -> list[int]:
    """Masks of two out of max_bits + 2 groups of positional bytes, as signed longs."""
    groups = np.array_split(np.arange(_BYTES), max_bits + 2)
    masks = []
    for chosen in combinations(groups, 2):
        mask = sum(255 << (8 * int(place)) for group in chosen for place in group)
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return masks


def _postings(prints: DataFrame, max_bits: int) -> DataFrame:
    """(key_no, key, print): a row for each fingerprint and posting key."""
    keys = [
        F.struct(F.lit(i).alias("key_no"), F.col("print").bitwiseAND(F.lit(mask)).alias("key"))
        for i, mask in enumerate(_masks(max_bits))
    ]
    return prints.select("print", F.explode(F.array(*keys)).alias("k")).select("k.*", "print")


def _pairs(lists: DataFrame, max_bits: int) -> DataFrame:
    """Verified links (a, b) inside lists of fingerprints."""
    shared = sum(
        ((_byte(F.col("a"), p) == _byte(F.col("b"), p)).cast("int") for p in range(_BYTES)), F.lit(0)
    )
    return (
        lists.select("prints", F.explode("prints").alias("a"))
        .select("a", F.explode(F.filter("prints", lambda p: p > F.col("a"))).alias("b"))
        .where(shared >= _BYTES - max_bits)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )


def _neighbour_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) between all given fingerprints within max_bits, chained to a smallest one.

    Two fingerprints within two bits share a value that is within one bit of both; within one bit,
    one of them is such a value itself. At most 65 fingerprints share a value.
    """
    one = F.lit(1).cast("long")

    def flipped(bit: Column) -> Column:
        value = F.col("print").bitwiseXOR(F.call_function("shiftleft", one, bit))
        return F.struct(value.alias("value"), F.lit(1).alias("bits"))

    near = F.transform(F.sequence(F.lit(0), F.lit(63)), flipped)
    own = F.array(F.struct(F.col("print").alias("value"), F.lit(0).alias("bits")))
    # The smallest centre must be near enough to tie the farthest member within max_bits.
    centre = F.min(F.when(F.col("v.bits") <= max_bits // 2, F.col("print")))
    return (
        prints.select("print", F.explode(F.concat(own, near)).alias("v"))
        .groupBy("v.value")
        .agg(centre.alias("b"), F.collect_list("print").alias("members"))
        .where(F.size("members") > 1)
        .select(F.explode("members").alias("a"), "b")
        .where("a <> b")
    )


def print_links(prints: DataFrame, max_bits: int = MAX_BITS, most_in_list: int = MOST_IN_LIST) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column print) within max_bits bits."""
    if max_bits not in (0, 1, 2):
        raise ValueError(f"max_bits must be 0, 1 or 2, not {max_bits}")
    if max_bits == 0:
        return prints.select(F.col("print").alias("a"), F.col("print").alias("b")).limit(0)
    spark = prints.sparkSession
    # Spark cuts long lists before the shuffle as it needs only the first ranks.
    rank = F.row_number().over(Window.partitionBy("key", "key_no").orderBy("print"))
    lists = (
        _postings(prints, max_bits)
        .withColumn("rank", rank)
        .where(F.col("rank") <= most_in_list + 1)
        .groupBy("key", "key_no")
        .agg(F.collect_list("print").alias("prints"))
        .where(F.size("prints") > 1)
    )
    lists, lists_path = stored(lists, "lists")
    long_keys = lists.where(F.size("prints") > most_in_list).select("key_no", "key")
    crowded = _postings(prints, max_bits).join(long_keys, ["key_no", "key"], "left_semi").select("print")
    short = _pairs(lists.where(F.size("prints") <= most_in_list), max_bits)
    links = short.unionByName(_neighbour_links(crowded.distinct(), max_bits)).distinct()
    links, _ = stored(links, "links")
    discard(spark, lists_path)
    return links


def grouped(docs: DataFrame, max_bits: int = MAX_BITS, most_in_list: int = MOST_IN_LIST) -> DataFrame:
    """Adds component_id, the smallest linked doc_id, and group, the smallest linked fingerprint.

    `docs` has doc_id and fingerprint (long). It is read several times; pass a stored table.
    """
    spark = docs.sparkSession
    prints, prints_path = stored(
        docs.groupBy(F.col("fingerprint").alias("print")).agg(F.min("doc_id").alias("first")), "prints"
    )
    links = print_links(prints.select("print"), max_bits, most_in_list)
    roots, roots_path = stored(components(links), "roots")
    rooted = prints.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "first", F.coalesce("component", "print").alias("root")
    )
    rooted, rooted_path = stored(rooted, "rooted")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    firsts, firsts_path = stored(firsts.withColumnRenamed("root", "_root"), "firsts")
    groups = rooted.join(firsts, F.col("root") == F.col("_root")).select(
        "print", "component_id", F.col("root").alias("group")
    )
    groups, _ = stored(groups, "groups")
    discard(spark, prints_path, roots_path, rooted_path, firsts_path)
    return docs.join(groups, F.col("fingerprint") == F.col("print")).drop("print")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint long, component_id) for every row of `docs` (doc_id, text)."""
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", fingerprint(F.col("text"), shingle_words).alias("fingerprint"))
    return grouped(stored(rows, "fingerprints")[0], max_bits).drop("group")


def without_near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of `docs`, that of the smallest doc_id; columns as in `docs`."""
    spark = prepare(docs.sparkSession)
    whole = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in docs.columns]
    # Rows are told apart by 128 bits over all their columns.
    key = F.struct(
        F.xxhash64(*whole, *[F.col(f"`{c}`").isNull() for c in docs.columns]).alias("h"),
        F.xxhash64(F.lit(1), *whole).alias("g"),
    )
    rows = docs.select(
        "doc_id", key.alias("row"), fingerprint(F.col("text"), shingle_words).alias("fingerprint")
    )
    rows, rows_path = stored(rows, "fingerprints")
    order = Window.partitionBy("group").orderBy(F.col("doc_id").asc_nulls_last(), "row")
    first = grouped(rows, max_bits).withColumn("rank", F.row_number().over(order)).where("rank = 1")
    h, g, kept_h, kept_g, rank = (free_name(docs, n) for n in ("_h", "_g", "_kept_h", "_kept_g", "_rank"))
    first, _ = stored(first.select(F.col("row.h").alias(kept_h), F.col("row.g").alias(kept_g)), "kept")
    discard(spark, rows_path)
    keyed = docs.withColumns({h: key["h"], g: key["g"]})
    kept = keyed.join(first, (F.col(h) == F.col(kept_h)) & (F.col(g) == F.col(kept_g)), "left_semi")
    same = Window.partitionBy(h, g).orderBy(h)
    return kept.withColumn(rank, F.row_number().over(same)).where(F.col(rank) == 1).drop(h, g, rank)


def op4_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


QUERIES = {"op4_simhash_dedup": op4_simhash_dedup}
ORACLE_SQL: dict[str, str] = {}
