"""Byte-pair encoding and decoding through a table of distinct words.

Texts are cut into words: before every space that follows a character which isn't white space,
where the tokenizer's own pattern always cuts too and what follows doesn't depend on what came
before. Cutting, numbering and joining words are array operations on a block's bytes, without an
object for each word. A block of documents keeps its texts as positions in the block's word list. The lists
are dealt out by word into buckets; a bucket encodes each of its distinct words once and decodes
the ids by a join with the vocabulary's table of ids and pieces, which every task makes once.
The results go back to the blocks, where ids and decoded bytes are put together by position.

Blocks hold about ``BLOCK_BYTES`` of text or one longer document. There are ``BUCKETS`` buckets
and one more for every ``BUCKET_WORDS`` distinct words, so their number grows with the words that
are new, not with the text. A bucket reads its lists as a stream: a task holds the bucket's
distinct words, one list, and a batch of results. Words above ``KEPT_BYTES`` are encoded once
for each list they are in and not held. The documents are cut up
twice, once for words and once for positions, which is cheaper than storing them cut up. Blocks
follow the table's partitions: ``docs`` must be a table read from files (``written`` makes one).
A check sum of each block's word list guards this; a block that differs fails the job.

Defined results: a null text counts as empty, and has no ids; special tokens in a text are
encoded as such and decoded again; rows that repeat are encoded each; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import give_back, then_given_back, written

BLOCK_BYTES = 16 << 20
BUCKETS = 16
BUCKET_WORDS = 1 << 19
KEPT_BYTES = 512
RESULT_BYTES = 8 << 20
MAX_PIECES = 2_000_000
ENCODED_AT_A_TIME = 4096
JOINED = 64
WORDS_AT_A_TIME = 1 << 18
SPACE = 0x20
WHITE = [c.encode() for c in map(chr, range(0x3001)) if c.isspace()]

WORDS = "bucket int, block string, word_sum bigint, words binary, sizes binary"
POSITIONS = "block string, word_sum bigint, doc_ids array<bigint>, lengths array<int>, positions binary, buckets binary"
ENCODED = "block string, bucket int, word_sum bigint, ids binary, n_ids binary, pieces binary, n_bytes binary"
RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
FULL = RESULT + ", ids array<int>, decoded string"


# --- vocabulary ---------------------------------------------------------------------------
def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary, and the byte.

    Printable bytes stand for themselves, the others for the characters from 256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def load(path: str) -> tuple[str, list[str]]:
    """The tokenizer file's text, without truncation and padding, and its special tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre = spec["pre_tokenizer"]
    if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
        raise ValueError("only byte-level tokenizers without a normalizer or prefix space can be cut at spaces")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
        raise ValueError("special tokens must stand for exactly their text")
    spec["truncation"] = spec["padding"] = None
    return json.dumps(spec), [t["content"] for t in spec["added_tokens"]]


class Vocabulary:
    """A tokenizer and the table of its ids and pieces: the bytes of an id lie at ``first``, ``size`` long."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        ids = self.tokenizer.get_vocab(with_added_tokens=True)
        if len(ids) > MAX_PIECES:
            raise ValueError("the vocabulary is larger than its bound")
        bytes_of = byte_characters()
        added = {t["id"]: t["content"].encode() for t in json.loads(spec)["added_tokens"]}
        pieces = [b""] * (1 + max(ids.values(), default=0))
        for token, i in ids.items():
            pieces[i] = added[i] if i in added else bytes(bytes_of[c] for c in token)
        self.size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.first = _starts(self.size)
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        return _gather(self.bytes, self.first[ids], self.size[ids])


# --- packing ------------------------------------------------------------------------------
def _squeezed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, their bytes sorted by place, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _packed(strings: pa.LargeBinaryArray) -> tuple[bytes, bytes]:
    data, ends = _bytes_of(strings)
    return zstandard.ZstdCompressor(level=3).compress(data), _squeezed(np.diff(ends))


def _unzipped(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)


def _strings(data: bytes, sizes: bytes) -> list[bytes]:
    return _sliced(zstandard.ZstdDecompressor().decompress(data), _ends(_numbers(sizes)))


def _sliced(data: bytes, ends: np.ndarray) -> list[bytes]:
    ends = ends.tolist()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


# --- strings as bytes in a row --------------------------------------------------------------
def _bytes_of(strings: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, and where each string ends in them, after a zero."""
    _, ends, data = strings.buffers()
    if not len(strings):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(ends, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    own = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
    return own, ends - ends[0]


def _strings_in(data: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    ends = np.ascontiguousarray(ends, np.int64)
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, buffers)


def _ends(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)])


WHITE_BYTE = np.isin(np.arange(256), [w[0] for w in WHITE if len(w) == 1])
WHITE_LONG = {n: [int.from_bytes(w, "big") for w in WHITE if len(w) == n] for n in (2, 3)}


def _white_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place is white space, as ``str.isspace`` has it."""
    last = data[at - 1]
    white = WHITE_BYTE[last]
    long = np.flatnonzero(last >= 0x80)
    code, places = last[long].astype(np.int64), at[long]
    for n in (2, 3):
        code |= data[np.maximum(places - n, 0)].astype(np.int64) << 8 * (n - 1)
        white[long] |= np.isin(code, WHITE_LONG[n]) & (places >= n)
    return white


# --- cutting ------------------------------------------------------------------------------
def cut(texts: pa.LargeBinaryArray, special: list[str]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The words of all texts in a row, with their leading spaces, and how many each text has."""
    data, ends = _bytes_of(texts)
    begins = np.zeros(len(data) + 1, bool)
    spaces = np.flatnonzero(data[1:] == SPACE) + 1
    begins[spaces[~_white_before(data, spaces)]] = True
    begins[ends] = True
    if special:
        pattern = re.compile(b"|".join(re.escape(s.encode()) for s in special))
        has = np.zeros(len(texts), bool)
        for s in special:
            has |= pc.match_substring(texts, s.encode()).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(has).tolist():
            for found in pattern.finditer(data[ends[i] : ends[i + 1]]):
                start, end = (ends[i] + found.span()).tolist()
                begins[start : end + 1] = False
                begins[[start, end]] = True
    starts = np.flatnonzero(begins[:-1])
    return _strings_in(data, np.append(starts, len(data))), np.diff(np.searchsorted(starts, ends))


def words_of(text: str) -> list[str]:
    """The words of a text without special tokens. All but the first have lost a leading space."""
    first, *rest = cut(pa.array([text.encode()], pa.large_binary()), [])[0].to_pylist()
    return [first.decode(), *[w[1:].decode() for w in rest]]


def _blocks(batches: Iterable[pa.RecordBatch], special: list[str], block_bytes: int):
    """Per block: its name, the ids of its documents, their numbers of words, the words' positions, and its word list."""
    part, count = TaskContext.get().partitionId(), 0
    ids, texts, size = [], [], 0

    def block():
        words, lengths = cut(pa.concat_arrays(texts), special)
        words = words.dictionary_encode()
        return f"{part}-{count}", pa.concat_arrays(ids).to_pylist(), lengths, words.indices.to_numpy(), words.dictionary

    for batch in batches:
        column, start = pc.fill_null(batch.column(1), "").cast(pa.large_binary()), 0
        for i, n in enumerate(pc.binary_length(column).to_pylist(), 1):
            size += n
            if size >= block_bytes or i == batch.num_rows:
                ids.append(batch.column(0).slice(start, i - start))
                texts.append(column.slice(start, i - start))
                start = i
            if size >= block_bytes:
                yield block()
                ids, texts, size, count = [], [], 0, count + 1
    if ids:
        yield block()


def _bucket_of(words: pa.LargeBinaryArray, buckets: int) -> np.ndarray:
    data, ends = _bytes_of(words)
    return np.fromiter(map(crc32, _sliced(data.tobytes(), ends)), np.uint32, len(words)) % np.uint32(buckets)


def _word_sum(words: pa.LargeBinaryArray) -> int:
    data, ends = _bytes_of(words)
    return crc32(ends, crc32(data))


def _lists(special: list[str], buckets: int, block_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _, _, words in _blocks(batches, special, block_bytes):
            of, total, rows = _bucket_of(words, buckets), _word_sum(words), []
            order = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(buckets + 1)).tolist()
            words = words.take(pa.array(order))
            for bucket in range(buckets):
                some = words.slice(cuts[bucket], cuts[bucket + 1] - cuts[bucket])
                if len(some):
                    rows.append((bucket, block, total, *_packed(some)))
            yield _batch(rows, WORDS)

    return lambda batches: then_given_back(run(batches))


def _positions(special: list[str], buckets: int, block_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, lengths, positions, words in _blocks(batches, special, block_bytes):
            of = _bucket_of(words, buckets)
            yield _batch([(block, _word_sum(words), ids, lengths, _squeezed(positions), _squeezed(of))], POSITIONS)

    return lambda batches: then_given_back(run(batches))


ARROW = {
    "int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], ARROW[kind]) for i, (_, kind) in enumerate(fields)],
        names=[name for name, _ in fields],
    )


# --- encoding and decoding ------------------------------------------------------------------
def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    shift = np.repeat(starts - (ends - sizes), sizes)
    return flat[shift + np.arange(len(shift))]


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _encoded(tokenizer, words: list[bytes], piece_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row, and how many each has.

    A word that starts with a space and ends without white space is encoded the same next to
    others like it, so these are joined; the bytes its ids stand for tell where a word ends.
    """
    data, ends = np.frombuffer(b"".join(words), np.uint8), _ends(np.fromiter(map(len, words), np.int64, len(words)))
    # the byte after a lone space is the next word's, but a lone space also ends with white space
    joined = (data[ends[:-1]] == SPACE) & (data[np.minimum(ends[:-1] + 1, len(data) - 1)] != SPACE) & ~_white_before(data, ends[1:])
    order = np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)])
    together = np.flatnonzero(joined).tolist()
    inputs = []
    for start in range(0, len(together), JOINED):
        inputs.append(b"".join(map(words.__getitem__, together[start : start + JOINED])).decode())
    alone = [words[i].decode() for i in np.flatnonzero(~joined).tolist()]
    ids = []
    for some, most in ((inputs, ENCODED_AT_A_TIME // JOINED), (alone, ENCODED_AT_A_TIME)):
        for start in range(0, len(some), most):
            ids += [np.array(e.ids, np.int64) for e in tokenizer.encode_batch_fast(some[start : start + most], add_special_tokens=False)]
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    sizes = np.diff(ends)[order]
    reached = np.cumsum(piece_sizes[flat])
    last = np.searchsorted(reached, np.cumsum(sizes)) + 1
    if len(words) and (reached[last - 1] != np.cumsum(sizes)).any():
        raise RuntimeError("ids that don't end where a word does")
    counts = np.diff(last, prepend=0)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return _gather(flat, _starts(counts)[back], counts[back]), counts[back]


class Grown:
    """Numbers in a row that grows at its end."""

    def __init__(self, kind):
        self.room, self.n = np.empty(1 << 10, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.room):
            room = np.empty(max(2 * len(self.room), self.n + len(more)), self.room.dtype)
            room[: self.n] = self.room[: self.n]
            self.room = room
        self.room[self.n : self.n + len(more)] = more
        self.n += len(more)


class Encodings:
    """Encoded words by number: their ids one after the other, and the bytes these ids stand for."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ids, self.n_ids, self.first_id = Grown(np.uint32), Grown(np.int32), Grown(np.int64)
        self.bytes, self.n_bytes, self.first_byte = Grown(np.uint8), Grown(np.int32), Grown(np.int64)

    def add(self, words: list[bytes]) -> None:
        ids, n_ids = _encoded(self.vocabulary.tokenizer, words, self.vocabulary.size)
        n_bytes = np.add.reduceat(self.vocabulary.size[ids], _starts(n_ids))
        self.first_id.add(self.ids.n + _starts(n_ids))
        self.first_byte.add(self.bytes.n + _starts(n_bytes))
        self.ids.add(ids)
        self.n_ids.add(n_ids)
        self.bytes.add(self.vocabulary.decoded(ids))
        self.n_bytes.add(n_bytes)

    def of(self, numbers: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
        """Ids, ids a word, bytes, bytes a word of the words with these numbers, packed."""
        n_ids, n_bytes = self.n_ids.room[numbers], self.n_bytes.room[numbers]
        own = _gather(self.bytes.room, self.first_byte.room[numbers], n_bytes)
        return (
            _squeezed(_gather(self.ids.room, self.first_id.room[numbers], n_ids)), _squeezed(n_ids),
            zstandard.ZstdCompressor(level=3).compress(own.tobytes()), _squeezed(n_bytes),
        )

    def marks(self) -> list[tuple[Grown, int]]:
        return [(g, g.n) for g in (self.ids, self.n_ids, self.first_id, self.bytes, self.n_bytes, self.first_byte)]


def _encoder(spec: str):
    loaded = []

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not loaded:  # once for all buckets of a task
            loaded.append(Vocabulary(spec))
        number, encodings = defaultdict(count().__next__), Encodings(loaded[0])  # numbers words as they come
        rows, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                words, known = _strings(row["words"], row["sizes"]), len(number)
                long = [w for w in words if len(w) > KEPT_BYTES]
                numbers = [number[w] if len(w) <= KEPT_BYTES else -1 for w in words] if long else [*map(number.__getitem__, words)]
                new = list(islice(reversed(number), len(number) - known))[::-1]
                if new:
                    encodings.add(new)
                marks = encodings.marks()
                if long:
                    encodings.add(long)
                places = np.array(numbers, np.int64)
                places[places < 0] = len(number) + np.arange(len(long))
                packed = encodings.of(places)
                for grown, n in marks:  # the long words go again
                    grown.n = n
                rows.append((row["block"], row["bucket"], row["word_sum"], *packed))
                held += sum(map(len, packed))
                if held > RESULT_BYTES:
                    yield _batch(rows, ENCODED)
                    rows, held = [], 0
        yield _batch(rows, ENCODED)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return then_given_back(results(batches))

    return run


def _joined(strings: pa.LargeBinaryArray, at: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """Each document's strings put together: those at ``at``, up to its end in ``ends``.

    About ``WORDS_AT_A_TIME`` are put together at a time, or those of one longer document.
    """
    stretch = ends[:-1] // WORDS_AT_A_TIME
    cuts = [0, *(np.flatnonzero(np.diff(stretch)) + 1).tolist(), len(stretch)]
    for a, b in zip(cuts, cuts[1:]):
        data, places = _bytes_of(strings.take(pa.array(at[ends[a] : ends[b]])))
        places = places[ends[a : b + 1] - ends[a]].tolist()
        for i, j in zip(places, places[1:]):
            yield data[i:j]


def _assembler(full: bool, n_pieces: int):
    names = pa.array([b"%d," % i for i in range(n_pieces)], pa.large_binary())

    def result(blocks: pa.Table, encoded: pa.Table) -> pa.Table:
        schema, rows = FULL if full else RESULT, []
        if not blocks.num_rows:
            raise RuntimeError("a block of words without its documents: read docs from files first")
        of = _numbers(blocks["buckets"][0].as_py())
        parts = sorted(encoded.to_pylist(), key=lambda r: r["bucket"])
        if any(r["word_sum"] != blocks["word_sum"][0].as_py() for r in parts):
            raise RuntimeError("a block's words changed between two reads: read docs from files first")
        join = lambda name: np.concatenate([np.zeros(0, np.int64), *[_numbers(r[name]) for r in parts]]).astype(np.int64)
        ids, n_ids = join("ids"), join("n_ids")
        if len(n_ids) != len(of):
            raise RuntimeError("words of a block are missing: read docs from files first")
        # the lists come by bucket: where each word of the block's list is among them
        place = np.empty(len(of), np.int32)
        place[np.argsort(of, kind="stable")] = np.arange(len(of))
        at = place[_numbers(blocks["positions"][0].as_py())]
        ends = _ends(np.array(blocks["lengths"][0].as_py(), np.int64))
        # every id's digits and a comma, joined by word, then by document
        digits, digit_ends = _bytes_of(names.take(pa.array(ids)))
        id_texts = _joined(_strings_in(digits, digit_ends[_ends(n_ids)]), at, ends)
        pieces = np.concatenate([np.zeros(0, np.uint8), *[_unzipped(r["pieces"]) for r in parts]])
        texts = _joined(_strings_in(pieces, _ends(join("n_bytes"))), at, ends)
        first = _starts(n_ids)
        for i, (doc_id, id_text, text) in enumerate(zip(blocks["doc_ids"][0].as_py(), id_texts, texts)):
            text = text.tobytes().decode("utf-8", "replace")
            own = at[ends[i] : ends[i + 1]]
            row = (
                doc_id, int(n_ids[own].sum()),
                hashlib.sha256(id_text[:-1]).hexdigest(), hashlib.sha256(text.encode()).hexdigest(),
            )
            rows.append((*row, _gather(ids, first[own], n_ids[own]).tolist(), text) if full else row)
        return pa.Table.from_batches([_batch(rows, schema)])

    def run(key, blocks: pa.Table, encoded: pa.Table) -> pa.Table:
        found = result(blocks, encoded)
        give_back()
        return found

    return run


def encode_and_decode(
    docs: DataFrame,
    path: str,
    full: bool = False,
    block_bytes: int = BLOCK_BYTES,
    buckets: int = BUCKETS,
    bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """Token counts and digests of ids and decoded text, a row per document; ``full`` adds both themselves.

    ``path``: a tokenizer file, read on the driver.
    """
    spec, special = load(path)
    n_pieces = len(Vocabulary(spec).size)
    rows = docs.select("doc_id", "text")
    distinct = rows.select(F.explode(F.split("text", " ")).alias("word")).agg(F.approx_count_distinct("word"))
    buckets += distinct.first()[0] // bucket_words
    lists = rows.mapInArrow(_lists(special, buckets, block_bytes), WORDS)
    encoded = lists.groupBy("bucket").applyInArrow(_encoder(spec), ENCODED)
    blocks = rows.mapInArrow(_positions(special, buckets, block_bytes), POSITIONS)
    return blocks.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(_assembler(full, n_pieces), FULL if full else RESULT)


def encode_any(docs: DataFrame, path: str, **options) -> DataFrame:
    """The same for rows that are not a table yet."""
    return encode_and_decode(written(docs.select("doc_id", "text"), "texts"), path, **options)
