"""Quality classification by positive-unlabelled learning with a non-negative risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.lineage import cut, map_arrow
from strandline.llm.words import word_hashes

#: Bounds of the samples the model is fitted on; everything else covers all rows.
POSITIVES = 8_000
UNLABELLED = 12_000
#: Shares of the positives above a score at which the class prior is read off, and positives below which it is not.
SHARES = tuple(k / 100 for k in range(50, 99, 2))
FEW, UNKNOWN = 20, 0.5
#: Every FOLDS-th document, by the checksum of its id, is held out of learning.
FOLDS = 5
#: Score from which a document is predicted to be good.
CUT = 0.3
#: Bytes of text handled at a time.
SLICE = 1 << 20

#: Classes of bytes whose neighbourhoods are counted.
CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" ",
    b"\n",
    b".",
    b",",
    b"!?",
    b"$%",
    b"#&*",
    b"|",
    b"()[]{}\"'",
    b"-_/:;@=+~^<>\\`",
    bytes(range(0x80, 0x100)),
)
_CLASS = np.full(256, len(CLASSES), np.int64)
for _i, _members in enumerate(CLASSES):
    _CLASS[list(_members)] = _i
_KINDS = len(CLASSES) + 1
N_FEATURES = _KINDS * _KINDS + 7


def features(data: bytes) -> np.ndarray:
    """What a score sees of a whole text: shares of neighbouring byte classes, and its variety."""
    out = np.zeros(N_FEATURES)
    n = len(data)
    if not n:
        return out
    flat = np.frombuffer(data, np.uint8)
    for at in range(0, n, SLICE):
        kinds = _CLASS[flat[max(at - 1, 0) : at + SLICE]]
        out[: _KINDS * _KINDS] += np.bincount(kinds[:-1] * _KINDS + kinds[1:], minlength=_KINDS * _KINDS)
    out[: _KINDS * _KINDS] = np.sqrt(out[: _KINDS * _KINDS] / n)
    words = word_hashes(data)
    lines = bytes(data).split(b"\n")
    last = _KINDS * _KINDS
    out[last] = np.log1p(n)
    out[last + 1] = np.log1p(n / max(1, len(words)))
    out[last + 2] = len(np.unique(words)) / max(1, len(words))
    out[last + 3] = len(set(lines)) / len(lines)
    out[last + 4] = np.log1p(n / len(lines))
    out[last + 5] = np.log1p(len(words))
    out[last + 6] = (words[1:] == words[:-1]).sum() / max(1, len(words))
    return out


@dataclass
class Model:
    """A linear score of standardised features; its logistic function is the probability of label 1."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.spread, -8, 8) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -500, 500)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, decay: float = 1e-3) -> Model:
    """Minimise the non-negative unbiased risk of logistic loss.

    The risk of the negatives is what the unlabelled rows have as negatives less the prior times what the
    positives have; where that falls below zero, the step goes back up its gradient instead.
    """
    count = len(positive) + len(unlabelled)
    centre = (positive.sum(axis=0, dtype=float) + unlabelled.sum(axis=0, dtype=float)) / count
    spread = np.sqrt((((positive - centre) ** 2).sum(axis=0) + ((unlabelled - centre) ** 2).sum(axis=0)) / count) + 1e-3
    p, u = (np.clip((side - centre) / spread, -8, 8).astype(np.float32) for side in (positive, unlabelled))
    w, b = np.zeros(p.shape[1]), 0.0
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        now = w.astype(np.float32)
        at_p, at_u = (1 / (1 + np.exp(-(side @ now + b).astype(float))) for side in (p, u))
        negative = -np.log(np.maximum(1 - at_u, 1e-12)).mean() + prior * np.log(np.maximum(1 - at_p, 1e-12)).mean()
        of_u, of_p = (at_u / len(u)).astype(np.float32), (at_p * prior / len(p)).astype(np.float32)
        down_w, down_b = u.T @ of_u - p.T @ of_p, of_u.sum() - of_p.sum()
        if negative < 0:
            grad_w, grad_b = -down_w, -down_b
        else:
            up = ((at_p - 1) * prior / len(p)).astype(np.float32)
            grad_w, grad_b = down_w + p.T @ up, down_b + up.sum()
        grad = np.append(grad_w + decay * w, grad_b)
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        move = 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(centre, spread, w, float(b), prior)


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled rows.

    If a share f of the positives scores above a cut, at least the prior times f of the unlabelled rows does, and
    no more where hardly a negative scores so high. So the prior is the ratio of both shares at the cut with the
    lowest upper bound (two standard errors), less two standard errors, as too high a prior takes negatives for
    positives. One half of the rows makes the scores, the other is counted.
    """
    if len(positive) < FEW or len(unlabelled) < FEW:
        return UNKNOWN
    judge = fit(positive[::2], unlabelled[::2], UNKNOWN)
    p, u = np.sort(judge.margin(positive[1::2])), np.sort(judge.margin(unlabelled[1::2]))
    found = []
    for share in SHARES:
        cut_at = p[int(len(p) * (1 - share))]
        of_p, of_u = (p >= cut_at).mean(), (u >= cut_at).mean()
        if of_u > 0:
            error = np.sqrt((1 - of_p) / (of_p * len(p)) + (1 - of_u) / (of_u * len(u)))
            found.append((of_u / of_p * (1 + 2 * error), of_u / of_p * (1 - 2 * error)))
    return float(np.clip(min(found, default=(UNKNOWN, UNKNOWN))[1], 0.01, 0.99))


def _described(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        rows = [features(x.as_buffer() if x.is_valid else b"").astype("<f4").tobytes() for x in frame.column(1)]
        yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(rows, pa.binary())], names=["doc_id", "x"])


def _scored(model: Model | None):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            text = frame.column(frame.num_columns - 1)
            scores = [0.5] * len(text)
            if model is not None:
                rows = [features(x.as_buffer() if x.is_valid else b"") for x in text]
                scores = model.score(np.array(rows).reshape(-1, N_FEATURES))
            kept = [frame.column(i) for i in range(frame.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(scores, pa.float64())], names=[*frame.schema.names[:-1], "score"]
            )

    return run


def held_out(id_col: str):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Fit on bounded samples: the rows with the lowest hashes of their ids, none held out.

    Trusted positives are rows labelled 1 (the least label, where rows of ``labels`` repeat an id), unlabelled
    rows are drawn from all documents whatever their labels. Label 0 is not used: the class prior is estimated
    from how both samples score, and the risk gives probabilities without calibration. Of texts that
    share an id the first in order counts. Without a label 1 there is no model.
    """
    known = labels.groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).alias("label"))
    ids = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("doc_id")).distinct()
    marked = ids.join(known, "doc_id", "left").withColumn("order", F.xxhash64("doc_id"))

    def lowest(rows: DataFrame, n: int, role: str) -> DataFrame:
        return rows.orderBy("order", "doc_id").limit(n).select("doc_id", F.lit(role).alias("role"))

    drawn = lowest(marked.where("label = 1"), POSITIVES, "p").unionByName(lowest(marked, UNLABELLED, "u"))
    chosen = cut(drawn.groupBy("doc_id").agg(F.collect_set("role").alias("roles")))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    wanted = source.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    x = map_arrow(wanted, _described, "doc_id long, x binary").join(F.broadcast(chosen), "doc_id").orderBy("doc_id")
    sample = x.select("x", *[F.array_contains("roles", role).alias(role) for role in "pu"]).toArrow()
    role = {r: sample[r].to_numpy() for r in "pu"}
    if not role["p"].any():
        return None
    rows = np.frombuffer(b"".join(v.as_buffer() for v in sample["x"]), "<f4").reshape(-1, N_FEATURES)
    positive, unlabelled = rows[role["p"]], rows[role["u"]]
    return fit(positive, unlabelled, estimated_prior(positive, unlabelled))


def score_documents(docs: DataFrame, model: Model | None, text_col: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns of the input with the score (a column of its ``name`` is replaced), the probability of label 1.

    Scores depend on the whole text alone; null counts as empty. Without a model every score is 0.5.
    """
    names = [c for c in docs.columns if c != name]
    rows = docs.select(F.struct(*names).alias("row"), F.col(text_col).alias("text"))
    kind = rows.select("row").schema[0].dataType.simpleString()
    scored = map_arrow(rows, _scored(model), f"row {kind}, score double")
    return scored.select(*[F.col("row")[c].alias(c) for c in names], F.col("score").alias(name))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Score the quality of each document, as the labels mark it.

    Returns the id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from a score of CUT). See
    train() for what is learnt from which rows. Null and empty texts are scored like any text;
    repeated rows repeat their score; rows with a null id are scored but never learnt from; other
    columns are ignored; an empty table gives no rows.
    """
    model = train(docs, labels, id_col, text_col, label_col)
    scored = score_documents(docs.select(F.col(id_col), F.col(text_col)), model, text_col)
    return scored.select(
        id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )
