"""The pipeline against plain Python, stage by stage, and its stages on odd rows."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from strandline.llm import quality
from tests.llm.test_texts import components, shingle_set

DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=repr)


def plain_lines(rows):
    """Pairs of neighbouring lines that occur before go, and documents of which nothing is left; all ids differ here."""
    first, out = {}, []
    for i, text, *rest in sorted(rows):
        lines, gone = text.split("\n"), set()
        for k, pair in enumerate(zip(lines, lines[1:])):
            home = first.setdefault(pair, (i, k))
            if home != (i, k):
                gone |= {k, k + 1} - ({home[1], home[1] + 1} if home[0] == i else set())
        kept = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        if len(gone) < len(lines):
            out.append((i, kept, *rest[:2], len(kept)))
    return out


def plain_groups(rows):
    """All pairs of sets."""
    sets = [shingle_set(r[1]) for r in rows]
    linked = [
        (b, a) for a in range(len(rows)) for b in range(a)
        if sets[a] and sets[b] and len(sets[a] & sets[b]) * 100 >= 75 * len(sets[a] | sets[b])
    ]
    label = components(len(rows), linked)
    return [r for k, r in enumerate(rows) if not sets[k] or label[k] == k]


def plain_mix(rows):
    """Targets by filling up, then slots of the golden ratio one by one."""
    size = {r[0]: len(r[1].encode().split()) for r in rows}
    sources = sorted({r[3] for r in rows})
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    have = {s: sum(size[r[0]] for r in rows if r[3] == s) for s in sources}
    target, open_ = {}, set(sources)
    while open_:
        left = sum(have.values()) - sum(target.values())
        over = {s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 3 * have[s]}
        if not over:
            target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
            break
        target |= {s: 3 * have[s] for s in over}
        open_ -= over
    block = 16
    blocks = {s: -(-have[s] // block) for s in sources}
    units = {s: int(target[s] / have[s] * blocks[s] * 65536) for s in sources}
    stretch, low = {}, 0
    for s in sources:
        high = low + int(units[s] / sum(units.values()) * ((1 << 31) - len(sources))) + 1
        stretch[s], low = (low, high), high
    seen, times = Counter(), Counter()
    for slot in range(-(-sum(units.values()) // 65536)):
        point = (slot + 1) * 1327217885 % (1 << 31)
        for s in sources:
            if stretch[s][0] <= point < stretch[s][1]:
                if seen[s] < 3 * blocks[s]:
                    times[s, seen[s] % blocks[s]] += 1
                seen[s] += 1
    out = []
    for s in sources:
        place = 0
        for r in sorted((r for r in rows if r[3] == s), key=lambda r: hashlib.md5(f"{r[0]}:mix".encode()).hexdigest()):
            taken = sum(times[s, w // block] for w in range(place, place + size[r[0]]))
            place += size[r[0]]
            if size[r[0]]:
                out += [r] * int(taken / size[r[0]] + 0.5)
    return out


def test_pipeline_equals_plain_python(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    rows = [tuple(r) for r in docs.select(COLUMNS).collect()]
    score = lambda text: model.score(quality.features((text or "").encode())[None])[0]
    want = {"quality_classifier": [r for r in rows if score(r[1]) >= 0.3]}
    want["line_dedup"] = plain_lines(want["quality_classifier"])
    want["minhash_near_dedup"] = plain_groups(sorted(want["line_dedup"]))
    want["mix_sources"] = plain_mix(want["minhash_near_dedup"])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert rows_of(docs) == sorted(want[name], key=repr), name
        assert docs.columns == COLUMNS
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coded = []
    for i, text, lang, source, _ in want["mix_sources"]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        coded.append((i, lang, source, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    found = corpus_pipeline.run(spark, DIR).select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, found.collect())) == sorted(coded)


def test_near_dedup_loses_no_text(spark):
    x, y = (" ".join(f"{k}{n}" for n in range(30)) for k in "xy")
    rows = [(1, x), (5, x), (5, y), (6, y + " end"), (7, "lone " * 9), (7, "lone " * 9), (8, None), (8, None), (9, ""), (None, x), (None, x)]
    docs = spark.createDataFrame([(*r, "en", "s", 0, "h", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, text_hash string, rows int")
    kept = corpus_pipeline.dedup_near(spark, docs, DIR)
    assert kept.columns == COLUMNS
    want = [(1, x), (5, y), (7, "lone " * 9), (8, None), (8, None), (9, ""), (None, x), (None, x)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, docs, no_docs, name, stage):
    clash = docs.withColumns({c: F.lit("other") for c in ("score", "text_hash", "words_here", "copies", "copy", "row", "id", "words", "n_gone")})
    found = stage(spark, clash, DIR)
    assert found.count() > 0 and (name == "bpe_encode" or found.columns == COLUMNS)
    assert stage(spark, no_docs, DIR).count() == 0
    if name == "mix_sources":
        assert all(r.text.split() for r in found.select("text").distinct().collect())
