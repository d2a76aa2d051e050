"""Document fingerprints by randomised edit embedding: edit distance becomes Hamming distance."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.components import connected_components, numbered
from strandline.llm.lineage import cut, map_arrow, release
from strandline.llm.words import mix

#: Coordinates of an embedding that a fingerprint samples: about this many of 2^level.
SAMPLED = 512
#: Classes of characters, and the period of their random bits.
KINDS, PERIOD = 256, 4096
#: Characters walked at a time, and texts below which they are walked one by one.
SLICE = 4 << 20
FEW = 32
#: Near texts: a piece starts where the hash of GRAM characters is divisible by SPACING; PIECE characters are walked.
GRAM, SPACING, PIECE = 4, 4, 24
#: A band samples DIGITS of the first REACH coordinates of a piece; a text has the BANDS bands of lowest hash.
DIGITS, REACH, BANDS = 12, 40, 64
#: Edits for each character of the longer text up to which texts are near.
SHARE = 0.08
#: Characters of the grams that texts so near must share.
SHARED = 5
#: A sketch has a digit of 1 to 15 for each of BINS bins of these grams, 0 where a bin is empty.
BINS = 256
#: Standard errors below the digits expected at the very bound down to which a pair is aligned.
ERRORS = 4.5
#: Lengths of a class, as a power of the ratio of lengths that near texts may have.
CLASS = 3
#: Rows of a bucket that one task compares with as many others at a time.
BLOCK = 2048
#: Likely pairs that are aligned for each part of a bucket, most alike first, in the rounds before the last.
LIKELY = (4, 8, 32)
#: Characters of texts that are banded together, about.
STRETCH = 1 << 16
#: Texts of pairs up to which their hashes (about 100 bytes each) are broadcast.
BROADCAST_TEXTS = 200_000
#: Characters of texts whose grams are held for the next pairs.
PREPARED = 1 << 21
#: Pairs compared at a time, and columns of an alignment between two looks at whether it can still be near.
PAIRS, COLUMNS = 1 << 15, 128

_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


@lru_cache(maxsize=1)
def _steps() -> np.ndarray:
    """For each class and coordinate: how many coordinates a character of that class fills from there.

    The shared walk writes the character at its pointer and moves the pointer on when the random bit
    of (coordinate, class) is 1; this counts to the first such coordinate.
    """
    bits = np.random.default_rng(20160).integers(0, 2, (KINDS, PERIOD), dtype=np.uint8)
    bits[:, -1] = 1
    fill = np.zeros((KINDS, 2 * PERIOD), np.int64)
    ahead = np.zeros(KINDS, np.int64)
    for j in range(2 * PERIOD - 1, -1, -1):
        ahead = np.where(bits[:, j % PERIOD] == 1, 1, ahead + 1)
        fill[:, j] = ahead
    return np.ascontiguousarray(fill[:, :PERIOD]).reshape(-1)


@lru_cache(maxsize=1)
def _step_lists() -> list[list[int]]:
    return _steps().reshape(KINDS, PERIOD).tolist()


@lru_cache(maxsize=64)
def coordinates(level: int, sampled_level: int) -> np.ndarray:
    """Sampled coordinates below 2^level at the rate of ``sampled_level``; those of a higher one are fewer of the same."""
    rate = min(1.0, SAMPLED / 2**sampled_level)
    limit = np.uint64(min(rate * 2**64, 2**64 - 1))
    found = []
    for at in range(0, 1 << level, 1 << 20):
        j = np.arange(at, min(at + (1 << 20), 1 << level), dtype=np.uint64)
        found.append(j[mix(j + np.uint64(0xA0761D6478BD642F)) <= limit])
    return np.concatenate(found).astype(np.int64)


def level_of(n_chars: int) -> int:
    """Walks take about two coordinates for each character; a level has room for two and a half."""
    return max(9, (5 * n_chars // 2).bit_length())


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _rows(codes: np.ndarray) -> np.ndarray:
    """Start of each character's class in the step table."""
    return ((codes * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.int64) * PERIOD


def walks(codes: list[np.ndarray], begin: list[int]) -> list[np.ndarray]:
    """First coordinate of each character of each text, and the end; the walks start at ``begin``."""
    lengths = np.array([len(c) for c in codes], np.int64)
    order = np.argsort(-lengths, kind="stable")
    sorted_lengths = lengths[order]
    offsets = np.concatenate([[0], np.cumsum(sorted_lengths + 1)])[:-1]
    total = int((lengths + 1).sum())
    rows, first = np.zeros(total, np.int64), np.zeros(total, np.int64)
    for k, i in enumerate(order):
        rows[offsets[k] : offsets[k] + lengths[i]] = _rows(codes[i])
    steps = _steps()
    at, j = offsets.copy(), np.array(begin, np.int64)[order]
    longest = -sorted_lengths
    step = 0
    active = int(np.searchsorted(longest, -step, "left"))
    while active >= FEW:
        pos, own = at[:active], j[:active]
        first[pos] = own
        own += steps.take(rows.take(pos) + (own & (PERIOD - 1)))
        pos += 1
        step += 1
        active = int(np.searchsorted(longest, -step, "left"))
    table = _step_lists()
    for k in range(active):
        here, coordinate, out = int(at[k]), int(j[k]), []
        end = int(offsets[k] + sorted_lengths[k])
        for kind in (rows[here:end] // PERIOD).tolist():
            out.append(coordinate)
            coordinate += table[kind][coordinate & (PERIOD - 1)]
        first[here:end] = out
        j[k] = coordinate
    ends = offsets + sorted_lengths
    first[ends] = j
    found: list = [None] * len(codes)
    for k, i in enumerate(order):
        found[i] = first[offsets[k] : ends[k] + 1]
    return found


def sample(codes: np.ndarray, first: np.ndarray) -> str:
    """Fingerprint of a walked text: its level, then one digit of the character at each sampled coordinate."""
    level = level_of(len(codes))
    j = coordinates(level, level)
    j = j[: np.searchsorted(j, first[-1])]
    at = np.searchsorted(first, j, "right") - 1
    digits = mix(codes[at].astype(np.uint64) + (j.astype(np.uint64) << np.uint64(21))) & np.uint64(15)
    return f"{level:02d}:" + _DIGITS[digits.astype(np.int64)].tobytes().decode()


@lru_cache(maxsize=256)
def _coarser(level: int, to: int) -> np.ndarray:
    """Places in a fingerprint of ``level`` that one of the higher level ``to`` has too."""
    return np.flatnonzero(np.isin(coordinates(level, level), coordinates(level, to)))


def _digits_at(print_: str, to: int) -> np.ndarray:
    level, digits = int(print_[:2]), np.frombuffer(print_[3:].encode(), np.uint8)
    if level == to:
        return digits
    places = _coarser(level, to)
    return digits[places[: np.searchsorted(places, len(digits))]]


def likeness(a: str, b: str) -> float:
    """Share of sampled coordinates at which two fingerprints agree; 1 for equal ones, 0 for nothing alike."""
    if a == b:
        return 1.0
    to = max(int(a[:2]), int(b[:2]))
    x, y = _digits_at(a, to), _digits_at(b, to)
    n = min(len(x), len(y))
    most = max(len(x), len(y))
    return float((x[:n] == y[:n]).sum() / most) if most else 0.0


def print_texts(texts: list[str]) -> list[str]:
    """Fingerprint of each text."""
    codes = [codes_of(x) for x in texts]
    return [sample(c, w) for c, w in zip(codes, walks(codes, [0] * len(codes)))]


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the start of another."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _compare(texts: list[str]) -> list[tuple]:
    """For each text but the last, which only follows: what edited_likeness() returns."""
    codes = [codes_of(x) for x in texts]
    own = walks(codes, [0] * len(codes))
    thirds = [len(c) // 3 for c in codes[:-1]]
    tails = [after[:third] for after, third in zip(codes[1:], thirds)]
    moved = walks(tails, [int(w[len(c) - t]) for w, c, t in zip(own, codes, thirds)])
    prints = [sample(c, w) for c, w in zip(codes, own)]
    out = []
    for i, (tail, walk, third) in enumerate(zip(tails, moved, thirds)):
        keep = len(codes[i]) - third
        changed = np.concatenate([codes[i][:keep], tail])
        text = changed.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        print_ = sample(changed, np.concatenate([own[i][:keep], walk]))
        sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        out.append((len(codes[i]), sha, prints[i], print_, likeness(prints[i], print_), likeness(prints[i], prints[i + 1])))
    return out


_FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _following(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, only_follows, doc_id, text) in order: compare each with the next of its bucket."""
    names = [f.split()[0] for f in _FIELDS.split(", ")]

    def out(ids: list, texts: list) -> pa.RecordBatch:
        columns = list(zip(*_compare(texts)))
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=names
        )

    bucket, ids, texts, size, done = None, [], [], 0, False
    for frame in frames:
        for b, last, i, text in zip(*[frame.column(k) for k in range(3)], frame.column(3)):
            b, last, i, text = b.as_py(), last.as_py(), i.as_py(), text.as_py() or ""
            if b != bucket:
                bucket, ids, texts, size, done = b, [], [], 0, False
            if done:
                continue
            if last:
                done = True
                if ids:
                    yield out(ids, [*texts, text])
                continue
            ids.append(i)
            texts.append(text)
            size += len(text)
            if size >= SLICE and len(ids) > 1:
                yield out(ids[:-1], texts)
                ids, texts, size = ids[-1:], texts[-1:], len(text)


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are.

    The edited text has its last third replaced by the start of the next document, by falling id;
    after the last comes the first. Returns the id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next`` (likeness to the edited text's and to the
    next document's fingerprint).

    Documents are dealt to stretches of ids, one for each shuffle partition; the first id of each
    stretch reaches the driver, and its row is also dealt to the stretch before. Null texts are empty;
    null ids come after all others; rows of equal id follow each other by text; a single document
    is its own next. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    place = F.coalesce("doc_id", F.lit(-(1 << 63)))
    source = source.withColumn("place", place)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(source.select("place").approxQuantile("place", [k / parts for k in range(1, parts)], 0.2 / parts)))

    @F.pandas_udf(T.LongType())
    def bucket_of(ids: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(np.array(bounds), ids.to_numpy(), "left"))

    dealt = source.withColumn("bucket", bucket_of("place"))
    heads = sorted(tuple(r) for r in dealt.groupBy("bucket").agg(F.max("place")).collect())
    before = {place: heads[k - 1][0] for k, (_, place) in enumerate(heads)}
    followers = source.where(F.col("place").isin(list(before)))
    to = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map()
    rows = dealt.select("bucket", F.lit(False).alias("last"), "doc_id", "text", "place")
    if before:
        rows = rows.union(followers.select(to[F.col("place")].alias("bucket"), F.lit(True), "doc_id", "text", "place"))
    ordered = rows.repartition(parts, "bucket").sortWithinPartitions("bucket", "last", F.desc("place"), "text")
    found = map_arrow(ordered.select("bucket", "last", "doc_id", "text"), _following, _FIELDS)
    return found.withColumnRenamed("doc_id", id_col)


def _printed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        column = frame.column(1)
        at = 0
        while at < len(column):
            texts, size = [], 0
            while at + len(texts) < len(column) and size < SLICE:
                texts.append(column[at + len(texts)].as_py() or "")
                size += len(texts[-1])
            yield pa.RecordBatch.from_arrays(
                [frame.column(0).slice(at, len(texts)), pa.array(print_texts(texts), pa.string())], names=["doc_id", "fingerprint"]
            )
            at += len(texts)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row; a null text counts as empty, equal texts have equal fingerprints."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(source, _printed, "doc_id long, fingerprint string").withColumnRenamed("doc_id", id_col)


@lru_cache(maxsize=1)
def _band() -> np.ndarray:
    """The sampled coordinates of a piece, in order."""
    return np.sort(np.random.default_rng(411).choice(REACH, DIGITS, replace=False))


@lru_cache(maxsize=1)
def _near_steps() -> np.ndarray:
    """The step table from coordinates below 64 on, where longer steps end beyond REACH all the same."""
    return np.minimum(_steps().reshape(KINDS, PERIOD)[:, :64], 64).astype(np.uint8).reshape(-1)


def _piece_keys(joined: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The band of the piece at each start: the characters at the sampled coordinates of its walk."""
    at = np.zeros(len(starts), np.uint8)
    pieces, first = np.empty((PIECE, len(starts)), np.uint32), np.empty((PIECE, len(starts)), np.uint8)
    for k in range(PIECE):
        pieces[k], first[k] = joined.take(starts + k), at
        kinds = (pieces[k] * np.uint32(0x9E3779B1)) >> np.uint32(24)
        at = np.minimum(at + _near_steps().take((kinds << np.uint32(6)) + at), 63)
    keys, every = np.zeros(len(starts), np.uint64), np.arange(len(starts))
    for j in _band():
        place = np.add.reduce(first <= np.uint8(j), axis=0, dtype=np.uint8).astype(np.int64) - 1
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + pieces.reshape(-1).take(place * len(starts) + every))
    return keys


def _band_keys(texts: list[np.ndarray]) -> list[np.ndarray]:
    """band_keys() of some texts, taken together, each with zeros behind it."""
    zeros = np.zeros(PIECE + GRAM, np.uint32)
    joined = np.concatenate([x for text in texts for x in (text, zeros)])
    lengths = np.array([len(x) for x in texts])
    begins = np.append(0, np.cumsum(lengths + len(zeros)))
    starts, keys = [], []
    for begin in range(0, len(joined), STRETCH):
        end = min(len(joined) - GRAM, begin + STRETCH)
        if end <= begin:
            break
        stretch = joined[begin : end + GRAM].astype(np.uint64)
        total = np.zeros(end - begin, np.uint64)
        for k in range(GRAM):
            total = mix(total * np.uint64(0x9E3779B97F4A7C15) + stretch[k : end - begin + k])
        chosen = total % np.uint64(SPACING) == 0
        heads = begins[np.searchsorted(begins, begin) : np.searchsorted(begins, end)]
        chosen[heads - begin] = True
        found = begin + np.flatnonzero(chosen)
        text = np.searchsorted(begins, found, "right") - 1
        found = found[found - begins[text] < lengths[text]]
        starts.append(found)
        keys.append(_piece_keys(joined, found))
    starts, keys = np.concatenate(starts), np.concatenate(keys)
    cuts = np.searchsorted(starts, begins)
    return [np.unique(keys[a:b])[:BANDS].view(np.int64) for a, b in zip(cuts[:-1], cuts[1:])]


def band_keys(codes: np.ndarray) -> np.ndarray:
    """Buckets of a text: bit samples of the embeddings of its pieces, the BANDS lowest.

    A walk over a whole text is out of step from its first edits on, so that long texts would seldom agree.
    Walks that start anew wherever the text itself says so agree again in the next piece.
    """
    return _band_keys([codes])[0]


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance of two arrays of code points, or most + 1 if it is greater.

    What both begin and end with is left out. Of the rest a column of the table is two integers, whose bits say
    where it rises and falls by one; only rows at most ``most`` off the diagonal are kept, and it ends
    when no place of a column can lead to ``most`` or less.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return most + 1
    differ = np.flatnonzero(a != b[: len(a)])
    begin = int(differ[0]) if len(differ) else len(a)
    a, b = a[begin:], b[begin:]
    differ = np.flatnonzero(a[::-1] != b[len(b) - len(a) :][::-1])
    end = int(differ[0]) if len(differ) else len(a)
    a, b = a[: len(a) - end], b[: len(b) - end]
    if not len(a):
        return min(len(b), most + 1)
    places: dict[int, int] = {}
    columns = max(COLUMNS, most)
    rises = falls = low = high = base = 0  # base is the value at row low, above the first bit
    for start in range(0, len(b), columns):
        stop = min(len(b), start + columns)
        if start:
            width = high - low
            bits = [np.unpackbits(np.frombuffer(x.to_bytes(width // 8 + 1, "little"), np.uint8), bitorder="little") for x in (rises, falls)]
            values = base + np.append(0, np.cumsum(bits[0][:width].astype(np.int64) - bits[1][:width]))
            ahead = np.abs(len(b) - start - len(a) + np.arange(low, high + 1))
            if (values + ahead).min() > most:
                return most + 1
        dropped = max(0, start - most) - low
        gone = (1 << dropped) - 1
        base += (rises & gone).bit_count() - (falls & gone).bit_count()
        rises, falls, low = rises >> dropped, falls >> dropped, low + dropped
        further = min(len(a), stop + most)
        rises |= ((1 << (further - high)) - 1) << (high - low)
        high = further
        mask = (1 << (high - low)) - 1
        letters = b[start:stop].tolist()
        here = {}
        for c in set(letters):
            if c not in places:
                places[c] = int.from_bytes(np.packbits(a == c, bitorder="little").tobytes(), "little")
            here[c] = (places[c] >> low) & mask
        for c in letters:
            same = here[c]
            level = ((((same & rises) + rises) ^ rises) | same | falls) & mask
            more = ((falls | (mask ^ (level | rises))) << 1 | 1) & mask
            rises, falls = ((level & rises) << 1 & mask) | (mask ^ (level | more)), more & level
        base += stop - start
    return min(base + rises.bit_count() - falls.bit_count(), most + 1)


def _gram_hashes(codes: np.ndarray) -> np.ndarray:
    n = max(0, len(codes) - SHARED + 1)
    codes, total = codes.astype(np.uint64), np.zeros(n, np.uint64)
    for k in range(SHARED):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += codes[k : n + k]
    return total


def _grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different grams of SHARED characters, as sorted hashes, and how often each is there."""
    return np.unique(_gram_hashes(codes), return_counts=True)


def _may_be_near(x: tuple, y: tuple, longer: int, most: int) -> bool:
    """An edit changes SHARED grams at most, so texts up to ``most`` edits apart share all others."""
    needed = longer - SHARED + 1 - most * SHARED
    if needed <= 0:
        return True
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    return int(np.minimum(x[1][i], y[1][j]).sum()) >= needed


def _sketches(texts: list[np.ndarray]) -> list[bytes]:
    """One-permutation hashing of each text's grams, repeats counted: four planes of BINS bits, one for each bit of the digits."""
    grams = [np.sort(_gram_hashes(x)) for x in texts]
    lengths = np.array([len(x) for x in grams])
    text, grams = np.repeat(np.arange(len(texts)), lengths), np.concatenate(grams)
    begin = np.flatnonzero(np.append(True, (grams[1:] != grams[:-1]) | (text[1:] != text[:-1]))) if len(grams) else np.zeros(0, np.int64)
    turn = np.arange(len(grams)) - np.repeat(begin, np.diff(np.append(begin, len(grams))))
    hashes = mix(mix(grams) + turn.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    none = np.uint64(2**64 - 1)
    low = np.full(len(texts) * BINS, none)
    np.minimum.at(low, text * BINS + (hashes % np.uint64(BINS)).astype(np.int64), hashes)
    digits = np.where(low == none, 0, mix(low) % np.uint64(15) + np.uint64(1)).astype(np.uint8).reshape(len(texts), BINS)
    planes = np.concatenate([np.packbits(digits >> k & 1, axis=1, bitorder="little") for k in range(4)], axis=1)
    return [x.tobytes() for x in planes]


def sketch(codes: np.ndarray) -> bytes:
    """The sketch of a text's grams."""
    return _sketches([codes])[0]


def _alike(words: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether pairs (a, b) of texts of n characters may be near, and how alike their sketches are, whose k-th words are row k.

    At the bound two texts share a known part of their grams, and in each bin the lowest of both is
    shared with that probability; ERRORS standard errors fewer equal digits are let through.
    """
    each = BINS // 64
    either, both, equal = (np.zeros(len(a), np.int64) for _ in range(3))
    for k in range(each):
        x, y = ([words[k + each * plane].take(side) for plane in range(4)] for side in (a, b))
        full_x, full_y = x[0] | x[1] | x[2] | x[3], y[0] | y[1] | y[2] | y[3]
        differ = (x[0] ^ y[0]) | (x[1] ^ y[1]) | (x[2] ^ y[2]) | (x[3] ^ y[3])
        either += np.bitwise_count(full_x | full_y)
        both += np.bitwise_count(full_x & full_y)
        equal += np.bitwise_count(full_x & ~differ)
    longer = np.maximum(n[a], n[b])
    needed = longer - SHARED + 1 - (longer * share).astype(np.int64) * SHARED
    every = np.maximum(n[a] - SHARED + 1, 0) + np.maximum(n[b] - SHARED + 1, 0)
    shared = either * np.maximum(needed, 0) / np.maximum(every - needed, 1)
    expected = shared + np.maximum(both - shared, 0) / 15
    spread = np.sqrt(expected * np.maximum(1 - expected / np.maximum(either, 1), 0))
    return (needed <= 0) | (equal >= expected - ERRORS * spread), equal / np.maximum(either, 1)


def _candidates(share: float, most: int | None):
    """Rows (bucket, i, j, place, node, part, n, sketch), sorted by the first three -> rows (a, b, left).

    A row with a and b is a pair of different parts of a bucket that may be near, of those that are among the ``most``
    most alike of one of both parts; a row with ``left`` alone is a bucket of which pairs were left out.
    """

    def pairs_of(group: np.ndarray, columns: list[np.ndarray], sketches: np.ndarray) -> pa.RecordBatch:
        bucket, i, j, place, node, part, n = columns
        words = np.ascontiguousarray(sketches.T)
        ends = np.append(group[1:], len(node))
        others = np.repeat(ends, ends - group) - np.arange(len(node)) - 1
        upto = np.append(0, np.cumsum(others))
        found, begin = [], 0
        while begin < len(node):
            end = max(begin + 1, int(np.searchsorted(upto, upto[begin] + PAIRS, "right")) - 1)
            a = np.repeat(np.arange(begin, end), others[begin:end])
            b = a + 1 + np.arange(len(a)) - (upto[a] - upto[begin])
            begin = end
            longer = np.maximum(n[a], n[b])
            kept = (part[a] != part[b]) & ((i[a] == j[a]) | (place[a] != place[b]))
            kept &= np.abs(n[a] - n[b]) <= (longer * share).astype(np.int64)
            a, b = a[kept], b[kept]
            near, likeness_ = _alike(words, n, a, b, share)
            found.append((a[near], b[near], likeness_[near]))
        a, b, alike = (np.concatenate([f[k] for f in found]) for k in range(3))
        left = np.zeros(0, np.int64)
        low, high = np.minimum(node[a], node[b]), np.maximum(node[a], node[b])
        if most is not None and len(a):
            tie = mix(mix(low.astype(np.uint64)) + high.astype(np.uint64))
            where = np.repeat(np.arange(len(group)), ends - group)
            pair, side = np.tile(np.arange(len(a)), 2), np.concatenate([a, b])
            order = np.lexsort((tie[pair], -alike[pair], part[side], where[side]))
            side = side[order]
            first = np.flatnonzero(np.append(True, (np.diff(part[side]) != 0) | (np.diff(where[side]) != 0)))
            rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
            kept = np.zeros(len(a), bool)
            kept[pair[order][rank < most]] = True
            left = np.unique(bucket[a[~kept]])
            low, high = low[kept], high[kept]
        if len(low):
            low, high = np.unique(np.stack([low, high]), axis=1)
        nulls = pa.nulls(len(left), pa.int64()), pa.nulls(len(low), pa.int64())
        columns = [pa.concat_arrays([pa.array(low), nulls[0]]), pa.concat_arrays([pa.array(high), nulls[0]])]
        return pa.RecordBatch.from_arrays([*columns, pa.concat_arrays([nulls[1], pa.array(left)])], names=["a", "b", "left"])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for frame in frames:
            if not frame.num_rows:
                continue
            columns = [frame.column(k).to_numpy().astype(np.int64) for k in range(7)]
            sketches = np.frombuffer(b"".join(frame.column(7).to_pylist()), np.uint64).reshape(frame.num_rows, BINS // 16)
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest[0], columns)]
                sketches = np.concatenate([rest[1], sketches])
            differ = np.any([x[1:] != x[:-1] for x in columns[:3]], axis=0)
            group = np.append(0, np.flatnonzero(differ) + 1)
            last = group[-1]
            if last:
                yield pairs_of(group[:-1], [x[:last] for x in columns], sketches[:last])
            rest = [x[last:] for x in columns], sketches[last:]
        if rest is not None:
            yield pairs_of(np.zeros(1, np.int64), *rest)

    return run


def _packed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in less space, as each is shuffled once for each pair it is in."""
    for frame in frames:
        data = [zlib.compress(x.as_py().encode(), 1) for x in frame.column(1)]
        yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(data, pa.binary())], names=["node", "data"])


def _near(share: float):
    """Keep the pairs (a, b, x, y) whose packed texts x and y are near."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0  # texts of other pairs, as one is often in many
        for frame in frames:
            kept = []
            for pair in zip(frame.column(2).to_pylist(), frame.column(3).to_pylist()):
                if size > PREPARED:
                    held, size = {}, 0
                for text in pair:
                    if text not in held:
                        codes = codes_of(zlib.decompress(text).decode())
                        held[text] = codes, _grams(codes)
                        size += len(codes)
                (x, its), (y, others) = (held[text] for text in pair)
                longer = max(len(x), len(y))
                most = int(longer * share)
                may_be = abs(len(x) - len(y)) <= most and _may_be_near(its, others, longer, most)
                kept.append(may_be and edit_distance(x, y, most) <= most)
            yield frame.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    return run


def _classes(n: int, share: float) -> list[int]:
    """Classes of lengths of a text, of which any two texts whose lengths may be near have one in common."""
    if share <= 0:
        return [n]
    if share >= 1:
        return [0]
    place = math.log(n) / -math.log1p(-share)
    return sorted({math.floor((place - 1e-6) / CLASS), math.floor((place + 1 + 1e-6) / CLASS)})


def _banded(share: float):
    """Rows (same, doc_id, text) -> the text's length, buckets and sketch in place of the text."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            at = 0
            while at < frame.num_rows:
                texts, size = [], 0
                while at + len(texts) < frame.num_rows and size < STRETCH:
                    texts.append(codes_of(frame.column(2)[at + len(texts)].as_py()))
                    size += len(texts[-1])
                keys = []
                for codes, bands in zip(texts, _band_keys(texts)):
                    turns = [c * 0xD1342543DE82EF95 % 2**64 for c in _classes(len(codes), share)]
                    keys.append(mix(np.add.outer(np.array(turns, np.uint64), bands.view(np.uint64)).reshape(-1)).view(np.int64))
                arrays = [
                    pa.array([len(x) for x in texts], pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(_sketches(texts), pa.binary()),
                ]
                ids = [frame.column(k).slice(at, len(texts)) for k in range(2)]
                yield pa.RecordBatch.from_arrays([*ids, *arrays], names=["same", "doc_id", "n", "keys", "sketch"])
                at += len(texts)

    return run


def _shared(nodes: DataFrame) -> DataFrame:
    """Rows (bucket, node, blocks) of the buckets that several nodes share."""
    buckets = nodes.select(F.explode("keys").alias("bucket"), "node")
    shared = buckets.withColumn("size", F.count("*").over(Window.partitionBy("bucket"))).where("size > 1")
    return cut(shared.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).drop("size"))


def _likely(rows: DataFrame, nodes: DataFrame, labels: DataFrame | None, share: float, most: int | None) -> DataFrame:
    """What _candidates() finds in the rows, whose nodes are parts of their own where ``labels`` lacks them."""
    placed = rows.withColumn("place", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("bucket", F.least("place", "other").alias("i"), F.greatest("place", "other").alias("j"), "place", "node")
    parts = placed.withColumn("part", F.col("node"))
    if labels is not None:
        parts = placed.join(labels, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
    full = parts.join(nodes.select("node", "n", "sketch"), "node").select("bucket", "i", "j", "place", "node", "part", "n", "sketch")
    ordered = full.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return cut(map_arrow(ordered, _candidates(share, most), "a long, b long, left long"))


def _verified(pairs: DataFrame, texts_of: Callable[[DataFrame], DataFrame], share: float) -> DataFrame:
    """The pairs (a, b) whose texts are near."""
    texts = texts_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    both = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return cut(map_arrow(both, _near(share), "a long, b long"))


def _link(nodes: DataFrame, texts_of: Callable[[DataFrame], DataFrame], share: float) -> DataFrame:
    """Components of the near pairs that share a bucket: (node, component), for linked nodes.

    Sketches, not texts, go with the rows of a bucket, in blocks of BLOCK rows. The pairs they let through are aligned,
    first the likeliest of each text; then, in buckets of which pairs were left out, those of each component so far, and
    last all whose texts are still in different components.
    """
    rows = _shared(nodes)
    release(nodes.sparkSession)
    labels = links = tested = None
    for most in (*LIKELY, None):
        found = _likely(rows, nodes, labels, share, most)
        pairs = found.where("left is null").select("a", "b").distinct()
        pairs = cut(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        tested = pairs if tested is None else tested.unionByName(pairs)
        left = cut(found.where("left is not null").select(F.col("left").alias("bucket")).distinct())
        release(nodes.sparkSession)
        near = _verified(pairs, texts_of, share)
        links = near if links is None else links.unionByName(near)
        labels = connected_components(links)
        if left.isEmpty():
            break
        rows = cut(rows.join(left, "bucket", "left_semi"))
        del found
        release(nodes.sparkSession)
    return labels


def near_texts(docs: DataFrame, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group documents that are an edit distance of at most ``share`` of the longer text apart.

    Candidates agree in a bit-sampled band of the embedding of a piece and in a class of lengths; those whose sketches
    may be those of near texts are verified by their true edit distance, of one document for each distinct text. Returns the id and ``component_id``
    (the smallest id reachable). Rows that repeat an id with another text are documents of their own. Null
    and empty texts stand alone; a null id gives a null component_id; equal rows repeat their result; an
    empty table gives no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    source = source.withColumn("same", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    usable = source.where("text is not null and text != '' and doc_id is not null")
    schema = "same string, doc_id long, n long, keys array<long>, sketch binary"
    banded = map_arrow(usable.select("same", "doc_id", "text"), _banded(share), schema)
    groups = numbered(
        banded.groupBy("same").agg(
            F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")
        )
    )

    def texts_of(ids: DataFrame) -> DataFrame:
        wanted = cut(groups.join(ids, "node", "left_semi").select(F.col("same").alias("key"), "id", "node"))
        if wanted.count() <= BROADCAST_TEXTS:  # so that texts that no pair has are not shuffled
            wanted = F.broadcast(wanted)
        one = usable.join(wanted, (F.col("same") == F.col("key")) & (F.col("doc_id") == F.col("id")))
        return map_arrow(one.select("node", "text"), _packed, "node long, data binary").dropDuplicates(["node"])

    labels = _link(groups, texts_of, share)
    placed = groups.select("same", "node", "id").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = cut(placed)
    heads = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    placed = placed.join(heads, "component").select("same", "component_id")
    named = usable.select("doc_id", "same").join(placed, "same").select(F.col("doc_id").alias(id_col), "component_id")
    alone = source.where("text is null or text = '' or doc_id is null")
    return named.unionByName(alone.select(F.col("doc_id").alias(id_col), F.col("doc_id").alias("component_id")))
