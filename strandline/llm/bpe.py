"""BPE encoding and decoding through a distinct-word table."""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandline.llm.lineage import map_arrow

#: Characters of text in a block, in which words are told apart before they are shuffled.
BLOCK = 1 << 24
#: Parts that the distinct words are dealt to; a task holds the table of one part at a time.
BUCKETS = 4096
#: Documents of a block whose ids and decoded texts are held as Python objects at a time.
SLICE = 256
#: Begins what stands for a special token among the words' bytes; no UTF-8 has it.
MARK = b"\xff"
#: Unicode's White_Space characters, as a regular expression class.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class WordTable:
    """The tokenizer's rules: the words of a text, the ids of a word, the piece of an id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.normalize = self.tokenizer.normalizer.normalize_str
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"[^\s", f"[^{WHITE}")).findall
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("|".join(regex.escape(t) for t in self.special)).split if self.special else None
        self.find = regex.compile("|".join(regex.escape(t) for t in self.special)).findall if self.special else None
        self.library = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = _byte_letters()
        self.bytes = {x: b for b, x in enumerate(self.letters)}
        self.agreed, self.odd = {chr(i) for i in range(128)}, set()
        self.pieces = [""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for piece, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.pieces[i] = piece

    def split(self, text: str) -> list:
        """Words in order; a special token is its id."""
        if self.special and any(t in text for t in self.special):
            out = []
            found = [*self.find(text), None]
            for part, token in zip(self.cut(text), found):
                out += self._by_library(self.normalize(part))
                if token is not None:
                    out.append(self.special[token])
            return out
        return self.words(text.lower()) if text.isascii() else self._by_library(self.normalize(text))

    def _by_library(self, text: str) -> list[str]:
        """Words of a text; where a character's class differs from the library's, as the library says."""
        chars = set(text)
        for c in chars - self.agreed - self.odd:
            probe = f"a{c}a 1{c}1 !{c}! {c}{c}"
            (self.agreed if self._spelled(probe) == self.words(probe) else self.odd).add(c)
        return self.words(text) if self.odd.isdisjoint(chars) else self._spelled(text)

    def _spelled(self, text: str) -> list[str]:
        spelled = [letters for letters, _ in self.library(text)]
        return [bytes(map(self.bytes.__getitem__, x)).decode("utf-8", "surrogatepass") for x in spelled]

    def ids(self, word: bytes) -> list[int]:
        """Ids of one word, given as UTF-8, or of what stands for a special token."""
        if word.startswith(MARK):
            return [int(word[len(MARK) :])]
        return [t.id for t in self.model.tokenize("".join([self.letters[b] for b in word]))]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTable:
    """The rules of a tokenizer file, read once in each Python worker."""
    return WordTable(path)


def _written(word: str | int) -> bytes:
    return MARK + str(word).encode() if isinstance(word, int) else word.encode("utf-8", "surrogatepass")


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers, all lowest bytes first, so that the shuffle's compression finds the zeros of the higher ones."""
    return np.ascontiguousarray(numbers, "<u4").view("u1").reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, "u1").reshape(4, -1).T).view("<u4").ravel()


def _gathered(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of values that begin at starts and are counts long, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts - ends + counts, counts)]


class _Numbered(dict):
    """Numbers words by the place where each comes first."""

    def __missing__(self, word: str | int) -> int:
        n = self[word] = len(self)
        return n


def _blocks(table: WordTable, frames: Iterator[pa.RecordBatch], most: int, placed: bool) -> Iterator[tuple[str, dict, list]]:
    """The blocks of a partition in order: name, words numbered by first place, and kept columns with word numbers.

    The name holds a checksum of the block's texts, so that two reads of the input name a block alike only if
    it has the same texts.
    """
    part, made = TaskContext.get().partitionId(), 0
    words, rows, size, check = _Numbered(), [], 0, 0
    for frame in frames:
        rest, kept, begun = frame.select(frame.schema.names[1:]), [], 0
        for i, value in enumerate(frame.column(0)):
            text = value.as_py() or ""
            check = zlib.crc32(MARK + text.encode("utf-8", "surrogatepass"), check)
            size += len(text)
            split = table.split(text)
            places = np.fromiter(map(words.__getitem__, split), "<u4", len(split))
            if placed:
                kept.append(_planes(places))
            if size >= most:
                rows.append((rest.slice(begun, i + 1 - begun), kept))
                yield f"{part}-{made}-{check}", words, rows
                words, rows, size, check, made = _Numbered(), [], 0, 0, made + 1
                kept, begun = [], i + 1
        if begun < frame.num_rows:
            rows.append((rest.slice(begun), kept))
    if rows:
        yield f"{part}-{made}-{check}", words, rows


def _places(path: str, most: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents of each block, their words replaced by the words' numbers in the block."""
        for block, _, rows in _blocks(_tokenizer(path), frames, most, placed=True):
            for frame, places in rows:
                columns = [pa.array([block] * len(places), pa.string()), *frame.columns, pa.array(places, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", *frame.schema.names, "places"])

    return run


def _distinct(path: str, most: int, buckets: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct words of each block, dealt to buckets, a row for each bucket."""
        for block, numbered, _ in _blocks(_tokenizer(path), frames, most, placed=False):
            if not numbered:
                continue
            words = [_written(w) for w in numbered]
            dealt = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int32, len(words))
            order = np.argsort(dealt, kind="stable")
            found, firsts = np.unique(dealt[order], return_index=True)
            runs = [order[a:b] for a, b in zip(firsts, [*firsts[1:], len(order)])]
            lengths = np.fromiter(map(len, words), "<u4", len(words))
            columns = [
                pa.array(found, pa.int32()),
                pa.array([block] * len(runs), pa.string()),
                pa.array([_planes(x) for x in runs], pa.binary()),
                pa.array([_planes(lengths[x]) for x in runs], pa.binary()),
                pa.array([b"".join([words[i] for i in x.tolist()]) for x in runs], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "numbers", "lengths", "words"])

    return run


def _encoded(path: str):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of the words of each row; a bucket's rows come together, and each of its words is encoded once."""
        table, known, current = _tokenizer(path), {}, None
        for frame in frames:
            counts, ids = [], []
            for bucket, lengths, words in zip(*(frame.column(i).to_pylist() for i in (0, 3, 4))):
                if bucket != current:
                    known, current = {}, bucket
                at, found = 0, []
                for n in _numbers(lengths).tolist():
                    word = words[at : at + n]
                    at += n
                    if word not in known:
                        known[word] = table.ids(word)
                    found.append(known[word])
                counts.append(_planes(np.fromiter(map(len, found), "<u4", len(found))))
                ids.append(_planes(np.array([i for x in found for i in x], "<u4")))
            columns = [frame.column(1), frame.column(2), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "numbers", "counts", "ids"])

    return run


def _joined(path: str):
    def run(documents: pa.Table, words: pa.Table) -> pa.Table:
        """Pieces joined to the ids of each word, and both to the block's documents by position."""
        numbers, counts, flat = (
            np.concatenate([np.zeros(0, "<u4"), *map(_numbers, words.column(c).to_pylist())]).astype(np.int64)
            for c in ("numbers", "counts", "ids")
        )
        column = documents.column("places")
        most = max((int(own.max()) for x in column if len(own := _numbers(x.as_py()))), default=-1)
        if len(numbers) != 1 + most:
            raise RuntimeError("two reads of the documents differ; write or checkpoint them first")
        at = np.argsort(numbers)
        starts, counts = (np.cumsum(counts) - counts)[at], counts[at]
        names = list(map(_tokenizer(path).pieces.__getitem__, flat.tolist()))
        spelled = [" ".join(names[a : a + n]) for a, n in zip(starts.tolist(), counts.tolist())]
        del names
        kept, done = documents.drop_columns(["block", "places"]), []
        for begin in range(0, len(column), SLICE):
            packed, decoded = [], []
            for value in column.slice(begin, SLICE):
                x = _numbers(value.as_py()).astype(np.int64)
                packed.append(_gathered(flat, starts[x], counts[x]).astype("<u4").tobytes())
                decoded.append(" ".join(map(spelled.__getitem__, x[counts[x] > 0].tolist())))
            some = kept.slice(begin, SLICE).append_column("ids", pa.array(packed, pa.binary()))
            done.append(some.append_column("decoded", pa.array(decoded, pa.string())))
        return pa.concat_tables(done)

    return run


def _pin_splits(spark: SparkSession) -> None:
    """Let the division of files into partitions not follow the number of executors, so that two reads divide alike."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


def encode_decode(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    block: int = BLOCK,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Encode every whole text with a byte-level word BPE, and decode the ids again.

    ``path`` names a tokenizer file that each executor can open. Returns the ``keep`` columns,
    ``ids`` (unsigned 32-bit little-endian integers, packed) and ``decoded`` (the pieces of the ids
    with blanks between them, special tokens included). Equal to the tokenizers library's encode with
    add_special_tokens=False and decode with skip_special_tokens=False.

    Texts are split by blocks of at least ``block`` characters, or what is left of a partition. The distinct words of a block are
    dealt by hash to ``buckets`` buckets, a packed row for each, so that a frequent word comes once from
    each block; a bucket's words are encoded once each. Their ids go back to the block, where they are
    joined to the vocabulary's pieces and then, by position, to the documents. Texts are not
    shuffled, word numbers are. A task holds one block, or one bucket's words.

    The documents are read twice by the same plan, and have to come in the same order and partitions, as files,
    checkpoints and shuffles of them do; if they differ, the job fails. A null text counts as empty and has no ids;
    repeated rows repeat their result; columns not kept are ignored; an empty table gives no rows.
    """
    _pin_splits(docs.sparkSession)
    fields = ", ".join(f"c{i} {kind}" for i, (_, kind) in enumerate(docs.select(*keep).dtypes))
    chosen = docs.select(F.col(text_col).alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])
    places = map_arrow(chosen, _places(path, block), f"block string, {fields}, places binary")
    distinct = "bucket int, block string, numbers binary, lengths binary, words binary"
    words = map_arrow(chosen, _distinct(path, block, buckets), distinct).repartition("bucket").sortWithinPartitions("bucket")
    ids = map_arrow(words, _encoded(path), "block string, numbers binary, counts binary, ids binary")
    both = places.groupBy("block").cogroup(ids.groupBy("block"))
    return both.applyInArrow(_joined(path), f"{fields}, ids binary, decoded string").toDF(*keep, "ids", "decoded")


def unpack(packed: bytes) -> list[int]:
    """The ids of one packed row."""
    return np.frombuffer(packed, "<u4").tolist()


def digest(ids: list[int]) -> str:
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
