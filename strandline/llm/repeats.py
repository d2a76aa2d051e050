"""Removal of repeated byte strings by blockwise suffix sorting with difference-cover ranks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.lineage import cut, map_arrow
from strandline.llm.words import mix

#: Bytes of the grams that anchor a string.
GRAM = 64
#: Period of the cover: sample suffixes start at multiples of it from an anchor.
PERIOD = 32
#: Bytes hashed at a time, and bytes of suffix buckets sorted at a time.
SLICE = 1 << 19
BLOCK = 1 << 20
#: Different chunks of an anchor that are sorted in one task; more are first parted by further bytes, in steps of so many places.
SORTED = 8192
WIDTHS = (32, 8, 1)
#: Ids of documents that may be broadcast (16 bytes each).
BROADCAST_IDS = 1_000_000

_BASE = 0xD1342543DE82EF95
_UP = np.cumprod(np.append(np.ones(1, np.uint64), np.full(SLICE * 2, _BASE, np.uint64)), dtype=np.uint64)
_DOWN = np.cumprod(
    np.append(np.ones(1, np.uint64), np.full(SLICE * 2, pow(_BASE, -1, 1 << 64), np.uint64)), dtype=np.uint64
)


def _gram_hashes(flat: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position."""
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * _UP[: len(flat)], out=sums[1:])
    n = len(flat) - GRAM + 1
    return mix((sums[GRAM:] - sums[:n]) * _DOWN[:n])


def _anchors(flat: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each string of ``length`` bytes: position and hash of its anchor, its gram of lowest hash (the last such)."""
    grams = _gram_hashes(flat)
    room = np.uint64((1 << 21) - 1)
    keys = (grams & ~room) | (room - np.arange(len(grams), dtype=np.uint64))
    width = length - GRAM + 1
    low, span = keys, 1
    while span * 2 <= width:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    n = len(keys) - width + 1
    low = np.minimum(low[:n], low[width - span : width - span + n])
    at = (room - (low & room)).astype(np.int64)
    return at, grams[at].view(np.int64)


def runs_of(data: bytes, length: int) -> np.ndarray:
    """Rows (anchor, first, last, hash): strings from first to last of a text that share an anchor."""
    flat = np.frombuffer(data, np.uint8)
    out = []
    for begin in range(0, max(0, len(flat) - length + 1), SLICE):
        at, grams = _anchors(flat[begin : begin + SLICE + length - 1], length)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        last = np.append(first[1:], len(at)) - 1
        out.append(np.stack([at[first] + begin, first + begin, last + begin, grams[first]], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 4), np.int64)


def _buffer(value: pa.Scalar) -> bytes:
    return value.as_buffer() if value.is_valid else b""


def _grams(length: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            hashes = []
            for x in frame.column(2):
                rows = runs_of(_buffer(x), length)
                kinds, n = np.unique(rows[np.append(True, rows[1:, 0] != rows[:-1, 0])[: len(rows)], 3], return_counts=True)
                hashes.append(np.concatenate([kinds, kinds[n > 1]]))
            yield pa.RecordBatch.from_arrays(
                [frame.column(0), frame.column(1), pa.array(hashes, pa.list_(pa.int64()))], names=["key", "id", "grams"]
            )

    return run


def _flat(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns.values()], names=list(columns))


_CHUNK = "key long, id long, first int, size int, copies int, reach int, gram long, lead int, digest binary"


def _chunks(length: int):
    """Chunks (key, id, text, repeated grams) -> one row for each run whose anchor is repeated.

    Equal runs that follow each other, as in a text with a short period, are one row with their number and
    the end of the last.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            out: list[list] = [[] for _ in range(9)]
            for key, own, text, wanted in zip(*[frame.column(i) for i in range(4)]):
                data = _buffer(text)
                rows = runs_of(data, length)
                rows = rows[np.isin(rows[:, 3], wanted.values.to_numpy())]
                before, stop, begun = None, -1, len(out[0])
                for at, first, last, gram in rows.tolist():
                    size, lead = last - first + length, at - first
                    here = (gram, lead, bytes(data[first : first + size]))
                    if here == before and first == stop + 1:
                        out[4][-1] += 1
                        out[5][-1] = first + size
                    else:
                        digest = hashlib.blake2b(here[2], digest_size=16, salt=lead.to_bytes(4, "little")).digest()
                        for column, value in zip(out[2:], (first, size, 1, first + size, gram, lead, digest)):
                            column.append(value)
                    before, stop = here, last
                out[0] += [key.as_py()] * (len(out[2]) - begun)
                out[1] += [own.as_py()] * (len(out[2]) - begun)
            kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.int32(), pa.binary()]
            names = [f.split()[0] for f in _CHUNK.split(", ")]
            yield _flat({n: (v, k) for n, v, k in zip(names, out, kinds)})

    return run


def _bytes_of(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, wanted chunks) -> the bytes of each wanted chunk."""
    for frame in frames:
        out: dict[str, tuple[list, pa.DataType]] = {
            "gram": ([], pa.int64()), "lead": ([], pa.int32()), "digest": ([], pa.binary()), "at": ([], pa.int32()), "bytes": ([], pa.binary())
        }
        for text, wanted in zip(frame.column(0), frame.column(1).to_pylist()):
            data = _buffer(text)
            for w in wanted:
                for name in ("gram", "lead", "digest"):
                    out[name][0].append(w[name])
                out["at"][0].append(0)
                out["bytes"][0].append(bytes(data[w["first"] : w["first"] + w["size"]]))
        yield _flat(out)


def _names(parts: list[np.ndarray]) -> np.ndarray:
    """Rank of each row of several equally long integer columns."""
    order = np.lexsort(parts[::-1])
    new = np.zeros(len(order), bool)
    for p in parts:
        s = p[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def repeated_strings(chunks: list[tuple[int, int, bytes]], length: int) -> list[tuple[int, int] | None]:
    """Of (gram, lead, bytes) chunks, different within their gram: the stretch that repeated strings cover.

    Suffixes are bucketed by gram and distance to the anchor, as equal strings are alike in both. A
    string is then its first PERIOD bytes, the rank of the sample suffix at the next multiple of
    PERIOD from the anchor (precomputed by doubling over 32, 64 and 128 bytes), and its last bytes. Within
    a bucket the strings are sorted by those, so long ties cost one comparison of ranks.
    """
    sizes = np.array([len(c[2]) for c in chunks], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.frombuffer(b"".join(c[2] for c in chunks) + bytes(8), np.uint8)
    words = np.ndarray((len(flat) - 7,), ">u8", flat.data, strides=(1,))
    leads = np.array([c[1] for c in chunks], np.int64)
    grams = np.array([c[0] for c in chunks], np.int64)

    back = leads // PERIOD
    count = back + (sizes - leads) // PERIOD
    base = np.concatenate([[0], np.cumsum(count)])
    own = np.repeat(np.arange(len(chunks)), count)
    place = offsets[own] + leads[own] + (np.arange(base[-1]) - base[own] - back[own]) * PERIOD
    rank = _names([words[place + 8 * k].astype(np.uint64) for k in range(4)])
    ranks = {1: rank}
    for blocks in (1, 2):
        left = ranks[blocks]
        right = np.append(left[blocks:], np.zeros(blocks, np.int64))
        ranks[2 * blocks] = _names([left, right])

    n = sizes - length + 1
    chunk = np.repeat(np.arange(len(chunks)), n)
    start = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)])[:-1], n)
    to_anchor = start - leads[chunk]
    next_ = -(-to_anchor // PERIOD)
    sample = base[chunk] + back[chunk] + next_
    covered = (length - PERIOD) // PERIOD
    at = offsets[chunk] + start
    keys = [grams[chunk].view(np.uint64), to_anchor.view(np.uint64)]
    keys += [words[at + 8 * k].astype(np.uint64) for k in range(PERIOD // 8)]
    done = 0
    while done < covered:
        blocks = next(b for b in (4, 2, 1) if done + b <= covered)
        keys.append(ranks[blocks][sample + done].view(np.uint64))
        done += blocks
    tail = length - covered * PERIOD
    keys += [words[at + length - tail + 8 * k].astype(np.uint64) for k in range(tail // 8)]
    if tail % 8:
        keys.append(words[at + length - 8].astype(np.uint64))
    total = np.zeros(len(at), np.uint64)
    for k in keys:
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + k)
    order = np.argsort(total, kind="stable")
    close = total[order][1:] == total[order][:-1]
    same = close.copy()
    for k in keys:
        s = k[order]
        same &= s[1:] == s[:-1]
    if (same != close).any():  # strings that differ have one hash: sort by what they are
        order = np.lexsort(keys[::-1])
        same = np.ones(len(order) - 1, bool)
        for k in keys:
            s = k[order]
            same &= s[1:] == s[:-1]
    repeated = np.zeros(len(at), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    out: list[tuple[int, int] | None] = [None] * len(chunks)
    found = np.flatnonzero(repeated)
    if len(found):
        owner = chunk[found]
        edge = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        ends = np.append(edge[1:], len(found)) - 1
        for a, b in zip(edge.tolist(), ends.tolist()):
            out[int(owner[a])] = (int(start[found[a]]), int(start[found[b]]) + length)
    return out


def _sorted_blocks(length: int):
    """Rows (gram, lead, digest, at, bytes), sorted by gram -> (digest, from, to) where strings repeat."""

    def solve(rows: list) -> pa.RecordBatch:
        found = repeated_strings([(g, lead, b) for g, lead, _, _, b in rows], length)
        kept = [(row[2], row[3], span) for row, span in zip(rows, found) if span]
        return _flat(
            {
                "digest": ([d for d, _, _ in kept], pa.binary()),
                "start": ([at + s[0] for _, at, s in kept], pa.int32()),
                "stop": ([at + s[1] for _, at, s in kept], pa.int32()),
            }
        )

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        size = 0
        for frame in frames:
            for row in zip(*[frame.column(i).to_pylist() for i in range(5)]):
                if size >= BLOCK and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield solve(rows)

    return run


_PIECE = "gram long, lead int, digest binary, at int, bytes binary"


def _parted(length: int, width: int):
    """Pieces (gram, lead, digest, at, bytes) -> pieces of a new gram, for strings within ``width`` places of each other.

    The strings of such a piece share more than the anchor: the bytes that all of them have before and after it.
    The new gram hashes these too, so pieces with equal strings still have one gram.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _PIECE.split(", ")]
        for frame in frames:
            out: list[list] = [[] for _ in names]
            for gram, lead, digest, at, data in zip(*[frame.column(i).to_pylist() for i in range(5)]):
                head = gram.to_bytes(8, "little", signed=True)
                least = max(0, lead - (len(data) - length))
                for step in range(least // width, lead // width + 1):
                    low, high = max(least, step * width), min(lead, step * width + width - 1)
                    shared = data[lead - step * width : lead + max(GRAM, length - step * width - width + 1)]
                    mark = hashlib.blake2b(head + step.to_bytes(4, "little") + shared, digest_size=8).digest()
                    piece = data[lead - high : lead - low + length]
                    row = (int.from_bytes(mark, "little", signed=True), high, digest, at + lead - high, piece)
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary()]
            yield _flat({n: (v, k) for n, v, k in zip(names, out, kinds)})

    return run


_RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _cut_out(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, spans) -> the text's size, what the spans cover, and the bytes that remain."""
    for frame in frames:
        out: list[list] = [[], [], [], []]
        for text, spans in zip(frame.column(1), frame.column(2).to_pylist()):
            data = bytes(_buffer(text))
            kept, at, removed, n = [], 0, 0, 0
            stop = -1
            for s in sorted((x["start"], x["stop"]) for x in spans or ()):
                if s[0] > stop:
                    n += 1
                    kept.append(data[at : s[0]])
                    stop = s[0]
                removed += max(0, s[1] - stop)
                stop = max(stop, s[1])
                at = stop
            kept.append(data[at:])
            for column, value in zip(out, (len(data), removed, n, b"".join(kept))):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["n_bytes", "n_removed", "n_spans", "kept"]
        yield pa.RecordBatch.from_arrays(
            [frame.column(0), *[pa.array(v, k) for v, k in zip(out, kinds)]], names=["id", *names]
        )


def _few(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def repeated_spans(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans (key, id, start, stop) of the byte strings of ``length`` that also start anywhere else.

    ``key`` hashes id and text. Strings that are equal have the same anchor, their 64-byte gram of
    lowest hash, at the same place. So only strings whose anchor's gram occurs twice as an anchor are
    looked at. They lie in chunks, the bytes that the neighbouring strings of an anchor cover. A chunk
    with an equal one is repeated as a whole; chunks that differ but share an anchor go through the
    suffix sort, one of each kind, in blocks of whole anchors. An anchor with more than SORTED kinds is parted
    first, by ever more of the bytes around it, until the parts fit; parts of one place hold one string each, and
    are only counted.
    """
    assert length % 8 == 0 and length >= GRAM + PERIOD
    source = docs.select(
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    )
    long_ones = source.where(F.octet_length("text") >= length)
    grams = map_arrow(long_ones, _grams(length), "key long, id long, grams array<long>")
    grams = grams.select("key", "id", F.explode("grams").alias("gram"))
    often = cut(grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"))
    wanted = cut(grams.join(often, "gram").groupBy("key", "id").agg(F.collect_set("gram").alias("wanted")))
    ids = _few(wanted.select("key").distinct())
    texts = source.join(ids, "key", "left_semi")

    def with_text(lists: DataFrame) -> DataFrame:
        right = lists.withColumnRenamed("key", "k").withColumnRenamed("id", "i")
        return texts.join(right, (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("i")))

    chunks = cut(map_arrow(with_text(wanted).select("key", "id", "text", "wanted"), _chunks(length), _CHUNK))
    kinds = chunks.groupBy("gram", "digest").agg(
        F.sum("copies").alias("n"), F.min(F.struct("key", "id", "first", "size", "lead")).alias("one")
    )
    kinds = cut(kinds)
    whole = kinds.where("n > 1").select("digest", F.lit(0).alias("start"), F.col("one.size").alias("stop"))
    classes = cut(kinds.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    chosen = cut(kinds.join(classes, "gram").select("gram", "digest", "n", "kinds", "one.*"))
    entry = F.struct("gram", "lead", "digest", "first", "size")

    def bytes_of(rows: DataFrame) -> DataFrame:
        lists = rows.groupBy("key", "id").agg(F.collect_list(entry).alias("entries"))
        return map_arrow(with_text(lists).select("text", "entries"), _bytes_of, _PIECE)

    def sorted_spans(pieces: DataFrame) -> DataFrame:
        blocks = pieces.select("gram", "lead", "digest", "at", "bytes").repartition("gram").sortWithinPartitions("gram")
        return map_arrow(blocks, _sorted_blocks(length), "digest binary, start int, stop int")

    spans = whole.unionByName(sorted_spans(bytes_of(chosen.where(F.col("kinds") <= SORTED))))
    large = chosen.where(F.col("kinds") > SORTED)
    if not large.isEmpty():
        pieces = bytes_of(large)
        for width in WIDTHS:
            pieces = cut(map_arrow(pieces, _parted(length, width), _PIECE))
            if width == 1:
                twice = pieces.groupBy("bytes").agg(F.count("*").alias("n")).where("n > 1").select("bytes")
                last = pieces.join(twice, "bytes")
                spans = spans.unionByName(last.select("digest", F.col("at").alias("start"), (F.col("at") + length).alias("stop")))
                break
            sizes = cut(pieces.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"))
            parts = pieces.join(sizes, "gram")
            spans = spans.unionByName(sorted_spans(parts.where(F.col("n") <= SORTED)))
            pieces = parts.where(F.col("n") > SORTED).drop("n").select("gram", "lead", "digest", "at", "bytes")
    spans = cut(spans.groupBy("digest").agg(F.min("start").alias("start"), F.max("stop").alias("stop")))
    reach = F.when(F.col("copies") > 1, F.col("reach")).otherwise(F.col("first") + F.col("stop"))
    return chunks.join(spans, "digest").select("key", "id", (F.col("first") + F.col("start")).alias("start"), reach.alias("stop"))


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove each byte that a repeated string of ``length`` bytes covers.

    Texts are taken as UTF-8 bytes; a string that also starts anywhere else, in the same document or
    another, is repeated, and strings never cross documents. Returns the id, ``n_bytes``,
    ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (the remaining bytes, which need
    not be whole characters).

    A null text is empty. Rows that repeat an id or a text are texts of their own, so equal texts of
    ``length`` bytes or more are removed whole. Other columns are ignored; an empty table gives no rows.
    """
    spans = repeated_spans(docs, length, id_col, text_col)
    lists = cut(spans.groupBy("key", "id").agg(F.collect_set(F.struct("start", "stop")).alias("spans")))
    source = docs.select(
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    )
    ids = _few(lists.select("key").distinct())
    right = lists.select(F.col("key").alias("k"), F.col("id").alias("i"), "spans")
    touched = source.join(ids, "key", "left_semi").join(right, (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("i")), "left")
    clean = source.join(ids, "key", "left_anti").select(
        "id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("kept"),
    )
    return map_arrow(touched.select("id", "text", "spans"), _cut_out, _RESULT).unionByName(clean).withColumnRenamed("id", id_col)
