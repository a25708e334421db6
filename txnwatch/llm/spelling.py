"""Spelling variants: words one edit apart, found in a bit-sliced index of the vocabulary.

The index of some words is a table of bitsets: for each position and letter, which words have
that letter there (a bit per word, 64 words to a number). A query reads its letters from left to
right and keeps sets of index words: those equal so far (zero errors), those with one letter
replaced, with one letter more, and with one less. Each step is a few whole-number operations on
all words at once; letters of the last two sets are looked up one position further or nearer.
Index words stand by falling count, so the lowest bit of the answer is the best form and the
number of bits is the number of near words.

One edit leaves the first half or the second half of a word as it is. Words are listed by length
class and first half, and by length class and second half (spelled backwards, so that it is the
beginning too); lengths ``c`` and ``c + 1`` meet in class ``c``. Only words with the same half are
in one index, so no word is compared with the whole vocabulary. The halves are read by the same
recurrence, so small lists share an index. A pair that both lists hold is left out of
the second. A list longer than ``TILE`` words is cut into blocks; each block of queries meets
each block of the index. What leaves a task is one row per query with a count and the best form,
never pairs.

Defined results: a null text has no words; lower-casing touches A-Z only; a null id counts as
empty text in the damage rule; rows that repeat count each; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import byte_list, written

LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 5, 3, 2
DAMAGE = 97
TILE = 2048
"""Words of one index at most; lists below it share one. Results don't depend on it."""
SHARED = 512
QUERIES = 256
HELD_WORDS = 400_000
"""Distinct words after which a task hands its counts on."""

#: Fixed: letters are A-Z, a-z and U+00C0 to U+00FF, which UTF-8 writes as C3 80 to C3 BF.
OTHERS = re.compile(rb"[\xc2\xc4-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def runs_of(text: bytes) -> list[bytes]:
    """The letter runs of a text, A-Z lower-cased."""
    return OTHERS.sub(b" ", text).translate(TABLE).split()


def damaged(doc_id: str, runs: list[bytes]) -> list[bytes]:
    """The runs, those whose CRC-32 (with the document's id) divides by 97 without one letter."""
    crc = np.fromiter(map(zlib.crc32, runs, repeat(zlib.crc32(f"{doc_id}:".encode()))), np.int64, len(runs))
    for i in np.flatnonzero(crc % DAMAGE == 0).tolist():
        word = runs[i].decode()
        at = int(crc[i]) % len(word)
        runs[i] = (word[:at] + word[at + 1 :]).encode()
    return runs


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        # bytes of a short word are no fewer than its letters
        kept = [(w, n) for w, n in counts.items() if len(w) >= LEAST_LENGTH]
        words = pa.array([w for w, _ in kept], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), byte_list(batch["text"])):
            counts.update(damaged(doc_id, runs_of(text)))
            if len(counts) >= HELD_WORDS:
                yield out()
                counts.clear()
    yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: every word of five letters or more that all documents hold three times or more."""
    slim = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return (
        slim.mapInArrow(_counted, "word string, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n"))
        .filter((F.col("n") >= LEAST_COUNT) & (F.char_length("word") >= LEAST_LENGTH))
    )


class Index:
    """Bitsets by position and letter over words that stand in the wanted order."""

    def __init__(self, words: list[str]):
        self.width = -(-len(words) // 64)
        self.letters = {c: i for i, c in enumerate(sorted(set("".join(words))), 1)}
        self.longest = max(map(len, words))
        codes, lengths = self.coded(words, self.longest)
        place = np.arange(len(words))
        self.bits, self.rows = [], []
        for position in range(self.longest):
            # row 0: no letter, or one that no index word has here
            present, row = np.unique(codes[:, position], return_inverse=True)
            ones = np.zeros((len(present) + 1, self.width * 64), bool)
            ones[row + 1, place] = codes[:, position] > 0
            rows = np.zeros(len(self.letters) + 1, np.int16)
            rows[present] = np.arange(1, len(present) + 1)
            rows[0] = 0
            self.bits.append(self.packed(ones))
            self.rows.append(rows)
        self.of_length = {}
        for length in set(lengths.tolist()):
            ones = np.zeros(self.width * 64, bool)
            ones[place] = lengths == length
            self.of_length[length] = self.packed(ones)

    @staticmethod
    def packed(ones: np.ndarray) -> np.ndarray:
        return np.packbits(ones, axis=-1, bitorder="little").view("<u8")

    def coded(self, words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.zeros((len(words), width), np.int16)
        flat = np.fromiter((self.letters.get(c, 0) for w in words for c in w), np.int16, int(lengths.sum()))
        codes[np.arange(width)[None, :] < lengths[:, None]] = flat
        return codes, lengths

    def has(self, position: int, letter: np.ndarray) -> np.ndarray:
        """Per query, the index words with its letter at a position."""
        if not 0 <= position < self.longest:
            return np.zeros((len(letter), self.width), np.uint64)
        return self.bits[position][self.rows[position][letter]]

    def of(self, length: int) -> np.ndarray:
        return self.of_length.get(length, np.zeros(self.width, np.uint64))

    def near(self, queries: list[str], half: int, other: bool) -> np.ndarray:
        """Per query (all of one length), the index words one edit away with the same first ``half`` letters.

        ``other``: without the pairs whose other halves are the same too.
        """
        n = len(queries[0])
        codes, _ = self.coded(queries, n)
        none = np.zeros((len(queries), self.width), np.uint64)
        zero = np.full_like(none, ~np.uint64(0))
        replaced = more = less = none  # one error: as long as the query, one letter longer, one shorter
        both_more = both_less = none  # the same with the odd letter right after the half
        for i in range(n):
            letter = codes[:, i]
            here = self.has(i, letter)
            if i < half:
                zero = zero & here
                continue
            if i == half:
                both_more, both_less = zero, none
            further, nearer = self.has(i + 1, letter), self.has(i - 1, letter)
            both_more, both_less = both_more & further, (zero if i == half else both_less & nearer)
            replaced = (replaced & here) | (zero & ~here)
            more = (more | zero) & further
            less = (less & nearer) | zero
            zero = zero & here
        longer = more | zero  # the odd letter may stand last
        if other:
            longer, less = longer & ~both_more, less & ~both_less
        return (replaced & self.of(n)) | (longer & self.of(n + 1)) | (less & self.of(n - 1))


def _lowest(rows: np.ndarray) -> np.ndarray:
    """Position of the lowest bit set in each row; every row has one."""
    first = (rows != 0).argmax(axis=1)
    word = rows[np.arange(len(rows)), first]
    lowest = word & (~word + np.uint64(1))
    return first * 64 + np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)


FOUND = "word string, n_near bigint, form string, form_n bigint"


def _compared(tile: pd.DataFrame) -> pd.DataFrame:
    """Near words of one tile's queries among its index words: those of class ``c`` and ``c + 1``."""
    backwards, size = bool(tile["backwards"].iloc[0]), int(tile["class"].iloc[0])
    half = size - size // 2 if backwards else size // 2
    index = tile[tile["indexed"]].sort_values(["n", "word"], ascending=[False, True])
    asked = tile[tile["asked"]]
    names, counts = index["word"].tolist(), index["n"].to_numpy()
    turn = (lambda w: w[::-1]) if backwards else (lambda w: w)
    out = []
    if names and len(asked):
        table = Index([turn(w) for w in names])
        # words of class c + 1 meet each other in their own class
        short = table.of(size)
        for length, words in asked["word"].groupby(asked["word"].str.len()):
            words = words.tolist()
            for start in range(0, len(words), QUERIES):
                part = words[start : start + QUERIES]
                sets = table.near([turn(w) for w in part], half, backwards)
                if length > size:
                    sets = sets & short
                n_near = np.bitwise_count(sets).sum(axis=1, dtype=np.int64)
                some = np.flatnonzero(n_near)
                if len(some):
                    best = _lowest(sets[some])
                    out += [
                        (part[i], int(n_near[i]), names[b], int(counts[b])) for i, b in zip(some.tolist(), best.tolist())
                    ]
    return pd.DataFrame(out, columns=["word", "n_near", "form", "form_n"])


def listings(words: DataFrame) -> DataFrame:
    """``word, n, class, backwards, key``: each word under both halves, in the class of its length and the one below."""
    spread = words.select("word", "n", F.char_length("word").alias("m"), F.expr("explode(array(0, 1)) AS down"))
    spread = spread.select(
        "word", "n", (F.col("m") - F.col("down")).alias("class"), F.expr("explode(array(false, true)) AS backwards")
    ).filter(F.col("class") >= LEAST_LENGTH)
    half = F.expr("IF(backwards, class - class div 2, class div 2)").cast("int")
    return spread.withColumn(
        "key", F.when(F.col("backwards"), F.right("word", half)).otherwise(F.left("word", half))
    )


def tiles(listed: DataFrame, tile: int, shared: int) -> DataFrame:
    """Deals listings to tiles: ``tile`` with ``asked`` and ``indexed``."""
    lists = listed.groupBy("class", "backwards", "key").agg(F.count("*").alias("size")).filter("size > 1")
    classes = lists.groupBy("class", "backwards").agg(
        F.ceil(F.sum(F.when(F.col("size") <= tile, F.col("size"))) / F.lit(shared)).alias("parts")
    )
    sized = written(
        lists.join(classes, ["class", "backwards"]).select(
            F.col("class").alias("_class"), F.col("backwards").alias("_backwards"), F.col("key").alias("_key"),
            F.when(F.col("size") <= tile, F.pmod(F.xxhash64("key"), F.col("parts"))).alias("part"),
            F.ceil(F.col("size") / F.lit(tile)).cast("int").alias("blocks"),
        ),
        "lists",
    )
    dealt = listed.join(
        sized,
        (F.col("class") == F.col("_class")) & (F.col("backwards") == F.col("_backwards")) & (F.col("key") == F.col("_key")),
    ).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    small = dealt.filter("blocks = 1").select(
        "word", "n", "class", "backwards", F.lit("").alias("list"), F.col("part").cast("int").alias("row"),
        F.lit(0).alias("column"), F.lit(True).alias("asked"), F.lit(True).alias("indexed"),
    )
    # a block as queries meets every block of the index, and the other way round
    asked = dealt.filter("blocks > 1").select(
        "word", "n", "class", "backwards", F.col("key").alias("list"), F.col("block").alias("row"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("column"),
        F.lit(True).alias("asked"), F.lit(False).alias("indexed"),
    )
    indexed = dealt.filter("blocks > 1").select(
        "word", "n", "class", "backwards", F.col("key").alias("list"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("row"), F.col("block").alias("column"),
        F.lit(False).alias("asked"), F.lit(True).alias("indexed"),
    )
    return small.unionByName(asked).unionByName(indexed)


def near(words: DataFrame, tile: int = TILE, shared: int = SHARED) -> DataFrame:
    """``word, n_near, form, form_n`` (largest count, ties by letters) of words that have a near word."""
    found = (
        tiles(listings(words), tile, shared)
        .groupBy("class", "backwards", "list", "row", "column").applyInPandas(_compared, FOUND)
    )
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for every word of ``word, form``: forms followed to the last, in doubled steps.

    A form has at least twice its word's count, so chains are short and have no cycle.
    """
    reached = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = reached.join(further, F.col("root") == F.col("_word"), "left")
        if moved.filter("_root IS NOT NULL").isEmpty():
            return reached
        reached = written(moved.select("word", F.coalesce("_root", "root").alias("root")), "roots")


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``."""
    words = written(vocabulary(docs), "vocabulary")
    found = near(words).withColumnRenamed("word", "_word")
    keeps = F.col("form_n") >= F.col("n") * FORM_FACTOR
    judged = written(
        words.join(found, F.col("word") == F.col("_word"), "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(keeps, F.col("form")).alias("form"), F.when(keeps, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(judged.filter("form IS NOT NULL")).withColumnRenamed("word", "_word")
    return judged.join(last, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
