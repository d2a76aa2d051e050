"""Operators on texts against brute force, with nulls, empties, repeats, clashing columns and empty tables."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strandline.llm import bpe, editprint, linededup, minhash, mixing, quality, repeats, sharding
from strandline.llm.components import connected_components
from strandline.llm.words import mix
from tests.llm.conftest import words

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def shingle_set(text, k=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def components(n, linked):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i, j in linked:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                changed = True
    return label


def test_minhash_equals_brute_force(docs, texts):
    known = [(i, t) for i, t in texts if i is not None]
    sets = [shingle_set(t) for _, t in known]
    linked = []
    for a in range(len(known)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and both * 100 >= 75 * (len(sets[a]) + len(sets[b]) - both):
                linked.append((b, a))
    groups = {}
    for k, g in enumerate(components(len(known), linked)):
        groups.setdefault(g, []).append(known[k][0])
    label = components(len(known), linked)
    want = [(i, len(sets[k]), min(groups[label[k]]), i == min(groups[label[k]])) for k, (i, _) in enumerate(known)]
    want += [(None, len(shingle_set(t)), None, True) for i, t in texts if i is None]
    assert rows_of(minhash.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept") == sorted(want, key=repr)


def test_minhash_signatures_match_jaccard():
    rng = np.random.default_rng(0)
    pool = np.sort(rng.integers(0, 1 << 63, 1200, dtype=np.uint64) * np.uint64(2))
    a, b = np.unique(pool[:1000]), np.unique(pool[200:])
    x, y = minhash.signatures([a, b], 128)
    assert abs((x == y).mean() - 800 / 1200) < 0.15
    assert (minhash.signatures([a[:1]], 128) == a[0]).all()


def test_components_of_both_sizes(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (7, 7), (None, 3)], "a long, b long")
    want = [(i, 0) for i in range(41)] + [(100, 100), (101, 100), (102, 100)]
    for small in (0, 1000):
        assert rows_of(connected_components(edges, small), "node", "component") == sorted(want, key=repr)
    assert connected_components(edges.where("false")).count() == 0


def test_repeats_equal_brute_force(docs, texts, monkeypatch):
    data = [(t or "").encode() for _, t in texts]
    seen = Counter(d[s : s + 200] for d in data for s in range(len(d) - 199))
    want = []
    for (i, _), d in zip(texts, data):
        mask = bytearray(len(d))
        for s in range(len(d) - 199):
            if seen[d[s : s + 200]] > 1:
                mask[s : s + 200] = b"\1" * 200
        spans = sum(1 for k in range(len(d)) if mask[k] and not (k and mask[k - 1]))
        want.append((i, len(d), sum(mask), spans, bytearray(c for c, m in zip(d, mask) if not m)))
    for limit in (repeats.SORTED, 1):
        monkeypatch.setattr(repeats, "SORTED", limit)
        got = rows_of(repeats.remove_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept")
        assert got == sorted(want, key=repr)


def test_repeats_of_hot_anchors_and_short_periods(spark, monkeypatch):
    rng = random.Random(1)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    hot, long_hot = letters(64), letters(170)
    rows = [(i, letters(rng.randrange(300)) + hot + letters(rng.randrange(300))) for i in range(30)]
    rows += [(i, letters(120) + long_hot + rng.choice(["abc", "xyz"]) * rng.randrange(1, 20) + letters(90)) for i in range(30, 60)]
    rows += [(60, "x" * 1500), (61, "ab" * 400 + letters(30) + "ab" * 120), (62, "a line of some forty bytes, again ...\n" * 20), (63, "x" * 200)]
    data = [t.encode() for _, t in rows]
    seen = Counter(d[s : s + 200] for d in data for s in range(len(d) - 199))
    want = []
    for (i, _), d in zip(rows, data):
        gone = {k for s in range(len(d) - 199) if seen[d[s : s + 200]] > 1 for k in range(s, s + 200)}
        want.append((i, len(gone), bytearray(c for k, c in enumerate(d) if k not in gone)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for limit in (3, 1):
        monkeypatch.setattr(repeats, "SORTED", limit)
        assert rows_of(repeats.remove_repeats(df), "doc_id", "n_removed", "kept") == sorted(want, key=repr)


def test_bpe_equals_the_library(docs, texts):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = []
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, tokenizer.decode(ids, skip_special_tokens=False)))
    coded = bpe.encode_decode(docs, TOKENIZER).collect()
    assert sorted(((r.doc_id, bpe.unpack(r.ids), r.decoded) for r in coded), key=repr) == sorted(want, key=repr)


def test_bpe_in_blocks_and_buckets(spark, tmp_path):
    rng = random.Random(8)
    odd = ["don't", "₞", "ẞtraße", "[UNK]", "[SEP]x", "x" * 300, "1234567", "a\u0301", "\u200b", "你好"]
    texts = [" ".join(rng.choice(odd) if rng.random() < 0.2 else words(rng, 1) for _ in range(rng.randrange(80))) for _ in range(120)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = {}
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        want[i] = (ids, tokenizer.decode(ids, skip_special_tokens=False))
    for block, buckets in ((1, 1), (700, 5), (1 << 22, 4096)):
        coded = bpe.encode_decode(spark.read.parquet(str(tmp_path / "docs")), TOKENIZER, block=block, buckets=buckets).collect()
        assert len(coded) == len(texts) and {r.doc_id: (bpe.unpack(r.ids), r.decoded) for r in coded} == want


def test_bpe_refuses_documents_that_differ_when_read_again(spark):
    shaken = spark.range(20).selectExpr("id doc_id").mapInPandas(
        lambda frames: (x.assign(text=[str(random.SystemRandom().random()) for _ in x.index]) for x in frames), "doc_id long, text string"
    )
    with pytest.raises(Exception, match="two reads of the documents differ"):
        bpe.encode_decode(shaken, TOKENIZER).collect()


def test_shards_are_even_and_keep_groups(docs, texts):
    got = sharding.shard_documents(docs, 4).collect()
    assert len(got) == len(texts) and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    for shard in range(4):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    crc = sorted((zlib.crc32(t.encode()) for _, t in texts if t is not None))
    assert sorted(r.text_crc32 for r in got if r.text_crc32 is not None) == crc
    homes = {}
    for r in got:
        assert homes.setdefault((r.text_crc32, r["size"]), r.shard) == r.shard
    assert sum(r["size"] for r in got) == sum(len((t or "").encode()) + 1 for _, t in texts)


def test_differencing_equals_a_plain_one():
    """Karmarkar-Karp as it is defined, on lists of sums: combine the two of largest spread, oppositely ordered."""
    rng = random.Random(2)
    for ways in (2, 3, 5):
        sizes = [rng.randrange(1, 90) for _ in range(40)]
        parts = [[n] + [0] * (ways - 1) for n in sizes]
        while len(parts) > 1:
            parts.sort(key=lambda p: p[0] - p[-1])
            a, b = parts.pop(), parts.pop()
            parts.append(sorted((x + y for x, y in zip(a, reversed(b))), reverse=True))
        found = sharding.differencing([[(n, k)] for k, n in enumerate(sizes)], ways)
        assert max(x for x, _ in found) - min(x for x, _ in found) <= parts[0][0] - parts[0][-1] + 3
        homes = [sharding.leaves(content) for _, content in found]
        assert sorted(k for own in homes for k in own) == list(range(40))
        assert [sum(sizes[k] for k in own) for own in homes] == [x for x, _ in found]


def test_differencing_in_several_levels(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_GROUPS", 16)
    monkeypatch.setattr(sharding, "BLOCK_PARTS", 4)
    groups = spark.range(500).selectExpr("cast(id as string) item", "1 + id % 37 weight")
    placed = sharding.balanced_shards(groups, 5).join(groups, "item").groupBy("shard").sum("weight").collect()
    sums = [r[1] for r in placed]
    assert len(sums) == 5 and max(sums) - min(sums) <= 8


def test_mix_meets_its_targets(docs, texts):
    got = mixing.mix_sources(docs).collect()
    size = sum(len((t or "").encode().split()) for _, t in texts)
    assert len(got) == len(texts) and sum(r["size"] for r in got) == size
    targets = {r.source: (r.target, r.source_size) for r in got}
    assert abs(sum(t for t, _ in targets.values()) - size) < 1e-6
    for source, (target, whole) in targets.items():
        taken = sum(r.taken for r in got if r.source == source)
        assert target <= 3 * whole + 1e-9 and abs(taken - target) <= max(64, 0.02 * target)
    assert all(r.taken <= 3 * r["size"] for r in got)
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_mix_takes_small_sources_to_their_target(spark):
    rows = [(i, "w " * 3000, "big") for i in range(40)] + [(100, "one two three", "small"), (101, "four", "tiny")]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for name in ("small", "tiny"):
        own = [r for r in got if r.source == name]
        assert sum(r.taken for r in own) == own[0].target == 3 * own[0].source_size


def test_words_are_joined_to_few_documents_at_a_time():
    """The result of a block comes in pieces, so that neither its ids nor its texts are all held as Python objects."""
    table, n = bpe.WordTable(TOKENIZER), 2 * bpe.SLICE + 1
    ids = [table.ids(w) for w in (b"the", b" wordless")]
    docs = pa.table({"block": ["b"] * n, "c0": list(range(n)), "places": [bpe._planes(np.array([k % 2] * (k % 3), "<u4")) for k in range(n)]})
    words = pa.table({"numbers": [bpe._planes(np.array([0, 1]))], "counts": [bpe._planes(np.array([*map(len, ids)]))], "ids": [bpe._planes(np.array(sum(ids, [])))]})
    found = bpe._joined(TOKENIZER)(docs, words)
    assert [b.num_rows for b in found.to_batches()] == [bpe.SLICE, bpe.SLICE, 1]
    assert [bpe.unpack(x) for x in found.column("ids").to_pylist()] == [ids[k % 2] * (k % 3) for k in range(n)]
    assert found.column("decoded").to_pylist() == [" ".join(table.pieces[i] for i in ids[k % 2] * (k % 3)) for k in range(n)]


def test_line_dedup_equals_brute_force(docs, texts):
    """Pairs of lines in order of id and place; equal rows are one document."""
    known = sorted({(i is not None, i or 0, t) for i, t in texts if t is not None}, key=lambda r: (r[0], r[1], xx(r)))
    first, gone = {}, {}
    for n, (_, _, text) in enumerate(known):
        lines = text.split("\n")
        for k, pair in enumerate(zip(lines, lines[1:])):
            home = first.setdefault(pair, (n, k))
            if home != (n, k):
                gone.setdefault(n, set()).update({k, k + 1} - ({home[1], home[1] + 1} if home[0] == n else set()))
    want = {}
    for n, (named, i, text) in enumerate(known):
        kept = [x for k, x in enumerate(text.split("\n")) if k not in gone.get(n, ())]
        want[i if named else None, text] = ("\n".join(kept), len(text.split("\n")), len(gone.get(n, ())))
    rows = [(i, t, *want.get((i, t), (None, 0, 0))) for i, t in texts]
    found = linededup.dedup_lines(docs.withColumn("gone", docs.text).withColumn("body", docs.text))
    assert rows_of(found, "doc_id", "gone", "text", "n_lines", "n_removed") == sorted(rows, key=repr)


def xx(row):
    return row[2]


def test_short_repeated_passages_go_whole(spark):
    rows, want = [], {}
    for n in (2, 3, 4, 5, 8):
        for k in range(6):
            passage = [f"passage {n} {k} line {i}" for i in range(n)]
            rows += [(100 * n + 2 * k, "\n".join([f"a {n} {k}", *passage, f"b {n} {k}"])), (100 * n + 2 * k + 1, "\n".join([f"c {n} {k}", *passage, f"d {n} {k}"]))]
            want |= {100 * n + 2 * k: rows[-2][1], 100 * n + 2 * k + 1: f"c {n} {k}\nd {n} {k}"}
    rows += [(1, "x\nx\nx\nx"), (2, "x\ny"), (3, None), (4, ""), (5, "p\nq"), (5, "p\nq"), (6, "p\nq"), (None, "z\nw"), (7, "z\nw\nv")]
    want |= {1: "x\nx", 2: "x\ny", 3: None, 4: "", 5: "p\nq", 6: "", None: "z\nw", 7: "v"}
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows) and {r.doc_id: r.text for r in got} == want
    assert all(r.n_lines - r.n_removed == (len(r.text.split("\n")) if r.text else r.n_lines - r.n_removed) for r in got)


def test_windows_do_not_carry_their_lines(spark):
    """What is shuffled for a window is of one size, however long its lines are, and differs with them."""
    df = spark.createDataFrame([("a\nb\na\nb",), ("a" * 9000 + "\nb\n" + "é" * 9000,)], "text string")
    runs = [[bytes(w.run) for w in r.w] for r in df.select(linededup.windows(df.text).alias("w")).collect()]
    assert runs[0] == [hashlib.sha256(x).digest()[:16] for x in (b"a\nb", b"b\na", b"a\nb")]
    assert runs[1] == [hashlib.sha256(x.encode()).digest()[:16] for x in ("a" * 9000 + "\nb", "b\n" + "é" * 9000)]


def test_windows_resist_shifts(spark):
    lines = [f"line {i} of many" for i in range(50)]
    df = spark.createDataFrame([("\n".join(lines),), ("\n".join(["new"] + lines),), ("one",), ("",)], "text string")
    marks = [{w.mark for w in r.w} for r in df.select(linededup.windows(df.text).alias("w")).collect()]
    assert len(marks[0]) == 49 and len(marks[1] - marks[0]) == 1 and marks[2] == set() == marks[3]


def test_quality_learns_from_positives_and_unlabelled(spark):
    good = [(i, f"The plain words of text number {i} are set in calm prose, with rests. And so on it goes.") for i in range(0, 300)]
    bad = [(i, "!!$$ ## " * 12 + str(i)) for i in range(300, 360)]
    df = spark.createDataFrame(good + bad + [(900, None), (901, ""), (None, "plain")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 200)] + [(i, 0) for i in range(300, 340)] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.classify(df, labels).collect()}
    assert len(got) == 363
    held = [i for i in got if i is not None and zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in held) for i in got if i is not None)
    right = [got[i].predicted == (i < 300) for i in held if i < 900]
    assert sum(right) / len(right) > 0.95 and all(0 <= r.score <= 1 for r in got.values())
    none = quality.classify(df, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}


def test_a_repeated_id_gives_one_model(spark):
    rows = [(i, f"calm prose number {i} with words. And more of it.") for i in range(60)] + [(i, "## !! $$ " * 9) for i in range(60, 90)]
    rows += [(3, "$$ !! ## 17"), (3, None), (70, "a quiet word or two.")]
    labels = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, other = (quality.classify(df.repartition(k), labels).selectExpr("doc_id", "round(score, 9) as score") for k in (1, 5))
    assert rows_of(one, "doc_id", "score") == rows_of(other, "doc_id", "score")


def test_prior_is_near_the_share_of_positives():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.9):
        positive = rng.normal(1, 0.6, (1500, 4))
        unlabelled = np.concatenate([rng.normal(1, 0.6, (int(3000 * share), 4)), rng.normal(-1, 0.6, (3000 - int(3000 * share), 4))])
        found = quality.estimated_prior(rng.permutation(positive), rng.permutation(unlabelled))
        assert 0.8 * share < found < share + 0.03
    assert quality.estimated_prior(positive[:3], unlabelled) == quality.UNKNOWN


def test_risk_is_the_least_near_the_fitted_weights():
    """The non-negative risk, written out, against steps away from the fit."""
    rng = np.random.default_rng(1)
    positive = rng.normal(0.6, 0.8, (400, 3))
    unlabelled = np.concatenate([rng.normal(0.6, 0.8, (500, 3)), rng.normal(-0.6, 0.8, (500, 3))])
    model = quality.fit(positive, unlabelled, 0.5, decay=0.0)
    assert (model.margin(np.full((1, 3), 1.0)) > model.margin(np.full((1, 3), -1.0))).all()

    def risk(weights, bias):
        of_p, of_u = (np.clip((x - model.centre) / model.spread, -8, 8) @ weights + bias for x in (positive, unlabelled))
        as_negative = np.log1p(np.exp(of_u)).mean() - 0.5 * np.log1p(np.exp(of_p)).mean()
        return 0.5 * np.log1p(np.exp(-of_p)).mean() + max(0.0, as_negative)

    best = risk(model.weights, model.bias)
    for _ in range(30):
        assert best <= risk(model.weights + rng.normal(0, 0.2, 3), model.bias + rng.normal(0, 0.2)) + 1e-3


def test_edit_fingerprints(docs, texts, spark):
    known = [(k, t or "") for k, (_, t) in enumerate(texts)]
    df = spark.createDataFrame(known, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in editprint.edited_likeness(df).collect()}
    order = sorted(known, reverse=True)
    for (i, own), (_, after) in zip(order, order[1:] + order[:1]):
        changed = editprint.edited(own, after)
        prints = editprint.print_texts([own, changed, after])
        assert (got[i].n_chars, got[i].edited_sha256) == (len(own), hashlib.sha256(changed.encode()).hexdigest())
        assert [got[i].fingerprint, got[i].edited_fingerprint] == prints[:2]
        assert got[i].near_next == pytest.approx(editprint.likeness(prints[0], prints[2]))
        assert 0 <= got[i].near_edited <= 1
    assert editprint.edited_likeness(docs).count() == len(texts)


def test_fingerprints_equal_a_walk_step_by_step():
    """The walk as it is defined: write the character at the pointer, move on where the shared bit is 1."""
    bits = np.random.default_rng(20160).integers(0, 2, (editprint.KINDS, editprint.PERIOD), dtype=np.uint8)
    bits[:, -1] = 1
    for text in ("", "a", "hello world", "é ß 日本 🙂" * 9, "x" * 700, "the quick brown fox. " * 40):
        codes = [ord(c) for c in text]
        written, at, j = [], 0, 0
        while at < len(codes):
            written.append(codes[at])
            kind = (codes[at] * 0x9E3779B1 % (1 << 32)) >> 24
            at += int(bits[kind, j % editprint.PERIOD])
            j += 1
        level = max(9, (5 * len(codes) // 2).bit_length())
        digits = []
        for place in editprint.coordinates(level, level).tolist():
            if place < len(written):
                digits.append("%x" % (int(mix(np.array([written[place] + (place << 21)], np.uint64))[0]) & 15))
        assert editprint.print_texts([text]) == [f"{level:02d}:" + "".join(digits)]


def edits(rng, text, n):
    out = list(text)
    for _ in range(n):
        place, kind = rng.randrange(len(out)), rng.randrange(3)
        out[place : place + (kind != 0)] = [] if kind == 2 else [rng.choice("abcdeiou")]
    return "".join(out)


def test_bands_find_nearly_all_near_texts():
    rng = random.Random(3)
    for size in (60, 200, 900, 4000):
        found = 0
        for _ in range(100):
            text = words(rng, size)[:size]
            a, b = (editprint.band_keys(editprint.codes_of(x)) for x in (text, edits(rng, text, int(size * editprint.SHARE))))
            found += len(np.intersect1d(a, b)) > 0
        assert found >= 95


def test_walks_one_by_one_equal_walks_together():
    rng = np.random.default_rng(2)
    texts = ["".join(map(chr, rng.integers(97, 123, rng.integers(0, 60)))) for _ in range(80)]
    codes = [editprint.codes_of(t) for t in texts]
    together = editprint.walks(codes, [0] * len(codes))
    for c, w in zip(codes, together):
        assert (editprint.walks([c], [0])[0] == w).all()


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def test_edit_distance_within_a_bound():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(2))
        for most in (0, 1, 3, 20):
            assert editprint.edit_distance(editprint.codes_of(a), editprint.codes_of(b), most) == min(plain_distance(a, b), most + 1)


def test_near_texts_equal_brute_force(spark):
    rng = random.Random(6)
    base = [words(rng, 40) for _ in range(6)]
    rows = [(10 * k + n, edits(rng, text, n * len(text) // 40)) for k, text in enumerate(base) for n in range(5)]
    rows += [(500, base[0]), (500, base[1]), (501, base[1] + "x"), (502, base[0]), (503, None), (504, ""), (None, base[2]), (504, ""), (3, base[3])]
    known = [(i, t) for i, t in rows if t and i is not None]
    near = lambda a, b: plain_distance(a, b) <= int(max(len(a), len(b)) * editprint.SHARE)
    linked = [(b, a) for a in range(len(known)) for b in range(a) if near(known[a][1], known[b][1])]
    label = components(len(known), linked)
    want = [(i, min(known[m][0] for m in range(len(known)) if label[m] == label[k])) for k, (i, _) in enumerate(known)]
    want += [(i, i) for i, t in rows if not t or i is None]
    found = editprint.near_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert rows_of(found, "doc_id", "component_id") == sorted(want, key=repr)


def test_edit_distance_in_several_stretches(monkeypatch):
    monkeypatch.setattr(editprint, "COLUMNS", 5)
    rng = random.Random(14)
    for _ in range(60):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(20, 60)))
        b = edits(rng, a, rng.randrange(12))
        for most in (2, 6, 11):
            assert editprint.edit_distance(editprint.codes_of(a), editprint.codes_of(b), most) == min(plain_distance(a, b), most + 1)


def test_sketches_tell_near_texts_from_those_that_share_a_passage():
    rng = random.Random(15)
    for size in (40, 300, 2000):
        passage = words(rng, size)[: size // 5]
        texts = [passage + words(rng, size)[: size - len(passage)] for _ in range(40)]
        near = [edits(rng, t, int(size * editprint.SHARE) - 1) for t in texts]
        codes = [editprint.codes_of(t) for t in texts + near]
        held = np.stack([np.frombuffer(editprint.sketch(c), np.uint64) for c in codes], axis=1)
        n, k = np.array([len(c) for c in codes]), np.arange(40)
        assert editprint._alike(held, n, k, k + 40, editprint.SHARE)[0].all()
        if size >= 300:
            assert not editprint._alike(held, n, k, (k + 1) % 40, editprint.SHARE)[0].any()


@pytest.mark.parametrize("block,likely", [(2048, (4, 8, 32)), (4, (1,)), (3, (1, 2))])
def test_near_texts_that_share_a_passage(spark, monkeypatch, block, likely):
    monkeypatch.setattr(editprint, "BLOCK", block)
    monkeypatch.setattr(editprint, "LIKELY", likely)
    rng = random.Random(16)
    passage = words(rng, 30)
    texts = [passage + words(rng, 40) for _ in range(20)]
    texts += [edits(rng, texts[k % 3], 1 + k) for k in range(15)]
    codes = [editprint.codes_of(t) for t in texts]
    linked = [(b, a) for a in range(len(texts)) for b in range(a) if
              editprint.edit_distance(codes[a], codes[b], (m := int(max(len(codes[a]), len(codes[b])) * editprint.SHARE))) <= m]
    label = components(len(texts), linked)
    want = sorted((k, min(m for m in range(len(texts)) if label[m] == label[k])) for k in range(len(texts)))
    found = editprint.near_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    assert sorted(tuple(r) for r in found.select("doc_id", "component_id").collect()) == want


def test_empty_tables(no_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for df in (
        minhash.near_duplicates(no_docs), repeats.remove_repeats(no_docs), bpe.encode_decode(no_docs, TOKENIZER), sharding.shard_documents(no_docs),
        mixing.mix_sources(no_docs), linededup.dedup_lines(no_docs), quality.classify(no_docs, labels), editprint.edited_likeness(no_docs),
        editprint.near_texts(no_docs),
    ):
        assert df.count() == 0
