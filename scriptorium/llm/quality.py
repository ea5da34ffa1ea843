"""Quality classifier from positive and unlabelled documents.

A linear model on style features minimises the non-negative positive-unlabelled risk with the logistic loss,

    pi * mean over trusted positives of l(g) + max(0, mean over unlabelled of l(-g) - pi * mean over positives of l(-g)),

plus a ridge. pi is the class prior, estimated as the share of good labels among the labels learned from; that holds if labels
fall on documents without regard to their quality, otherwise pass ``prior``. As l(-g) = l(g) + g, the risk is the larger of two
convex functions of the weights, the first term and the unbiased risk, so its minimum is that of the first term plus
lam times the bracket for the largest lam up to 1 at which the bracket isn't negative; lam is bisected, with Newton
steps for each. They run over all rows of a written feature table, with sums per task added up in two levels, so neither driver
nor tasks see more than one matrix of fixed size.

Inputs of a score are computed from the text alone. A null or empty text has defined features and gets a score. Repeated
rows are scored each; the result has the four named columns alone, so columns of docs clash with nothing. A document with labels of
both kinds is no trusted positive. Null labels don't count. Without trusted positives every score is 0.5. Null ids are no key for
labels. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import NULL_ID, id_text, null_id, tidy, work_dir, write_once

THRESHOLD = 0.3
RIDGE = 1e-1
STEPS, HALVINGS = 6, 10
MERGERS = 8
SLACK = 1e-2  # a bracket this close above 0 ends the search for lam
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLASS = np.full(256, 7, np.int64)  # 0 lower, 1 upper, 2 digit, 3 space, 4 line end, 5 mark, 6 control, 7 beyond ASCII
_CLASS[:128] = 6
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", _MARKS)):
    _CLASS[list(_chars)] = _k
WIDTH = len(_MARKS) + 8 + 64 + 16


def features(text: bytes) -> np.ndarray:
    """Fixed-width style features of a whole text; shares are square-rooted so that rare signs show."""
    data = np.frombuffer(text, np.uint8)
    n, words, lines = max(1, len(data)), text.split(), [x for x in text.split(b"\n") if x.strip()]
    kinds, nw, nl = _CLASS[data], max(1, len(words)), max(1, len(lines))
    marks = np.bincount(data, minlength=256)[list(_MARKS)] / n
    shares = np.bincount(kinds, minlength=8) / n
    steps = np.bincount(kinds[:-1] * 8 + kinds[1:], minlength=64)[:64] / n if len(kinds) else np.zeros(64)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:])))
    size = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    own = [
        len(counts) / nw, pairs / max(1, nw - 1), max(counts.values(), default=0) / nw, sum(a == b for a, b in zip(words, words[1:])) / nw,
        sum(map(bytes.isupper, words)) / nw, sum(map(bytes.isalpha, words)) / nw, sum(map(bytes.istitle, words)) / nw,
        float(np.mean(size)) / 10, float(np.std(size)) / 10, min(1.0, float(np.max(size)) / 100), float(np.mean(size == 1)),
        np.log1p(len(data)) / 10, np.log1p(nl) / 10, len(set(lines)) / nl, nw / nl / (20 + nw / nl), sum(x.rstrip()[-1:] in b".!?" for x in lines) / nl,
    ]
    return np.concatenate((np.sqrt(marks), np.sqrt(shares), np.sqrt(steps), own)).astype("<f4")


def feature_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, f (the features as bytes)."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                p = b.slice(at, 1024)
                yield pa.RecordBatch.from_arrays([p.column(0), pa.array([features(t).tobytes() for t in p.column(1).to_pylist()], pa.binary())], ["doc_id", "f"])

    return id_text(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, f binary")


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<f4").reshape(len(col), WIDTH).astype(np.float64)


def _total(df: DataFrame, one) -> np.ndarray:
    """Sum over all rows of one(features, kind), an array of fixed size; added per task, then in MERGERS tasks, then here."""

    def partial(batches):
        from pyspark import TaskContext

        total = None
        for b in batches:
            for at in range(0, b.num_rows, 8192):
                p = b.slice(at, 8192)
                s = one(_matrix(p.column("f")), np.asarray(p.column("kind")))
                total = s if total is None else total + s
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % MERGERS]), pa.array([total.tobytes()], pa.binary())], ["k", "s"])

    def merge(batches):
        total = sum(np.frombuffer(x) for b in batches for x in b.column("s").to_pylist())
        if not isinstance(total, int):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

    parts = df.mapInArrow(tidy(partial), "k long, s binary").repartition(MERGERS, "k").mapInArrow(tidy(merge), "s binary")
    return sum((np.frombuffer(r["s"]) for r in parts.collect()), 0)


class Model:
    def __init__(self, mean, scale, w, prior):
        self.mean, self.scale, self.w, self.prior = mean, scale, w, prior

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.hstack((np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1)))) @ self.w

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def fit(train: DataFrame, prior: float) -> Model | None:
    """Train on rows of (f, kind), kind 1: trusted positive, 0: unlabelled. None without both kinds."""

    def moments(x, kind):
        return np.concatenate(([np.sum(kind == 1), np.sum(kind == 0)], x.sum(axis=0), (x * x).sum(axis=0)))

    m = _total(train, moments)
    if isinstance(m, int) or not m[0] or not m[1]:
        return None
    n_pos, n_un, n = m[0], m[1], m[0] + m[1]
    mean = m[2 : 2 + WIDTH] / n
    scale = np.sqrt(np.maximum(m[2 + WIDTH :] / n - mean**2, 1e-6))
    model, d = Model(mean, scale, np.zeros(WIDTH + 1), prior), WIDTH + 1

    def at(w):
        """Risk of the positives, bracket, and gradient and curvature of both at w."""

        def sums(x, kind):
            x = np.hstack((np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))))
            out = []
            for one, part in ((kind == 1, prior / n_pos), (kind == 0, 1 / n_un)):  # weights of a row: positives stand in the bracket too
                y = x[one]
                g = y @ w
                p = 1 / (1 + np.exp(-np.clip(g, -40, 40)))
                out += [[part * np.logaddexp(0, -g).sum(), part * np.logaddexp(0, g).sum()], part * (p - 1) @ y, part * p @ y, (part * (y.T * (p * (1 - p))) @ y).ravel()]
            return np.concatenate(out)

        s, n = _total(train, sums), 2 + 2 * d + d * d
        (p, q), (u, v) = ((x[:2], (x[2 : 2 + d], x[2 + d : 2 + 2 * d], x[2 + 2 * d :].reshape(d, d))) for x in (s[:n], s[n:]))
        return p[0], u[1] - p[1], q[0], v[1] - q[1], q[2], v[2] - q[2]

    weight = np.append(np.ones(d - 1), 1e-6)

    def newton(w, now, lam):
        """Minimise the positives' risk + lam * bracket + ridge from w on."""
        value = lambda n, v: n[0] + lam * n[1] + RIDGE * (weight @ v**2)
        for _ in range(STEPS):
            step = np.linalg.solve(now[4] + lam * now[5] + np.diag(2 * RIDGE * weight), now[2] + lam * now[3] + 2 * RIDGE * weight * w)
            t, was = 1.0, value(now, w)
            while value(new := at(w - t * step), w - t * step) > was + 1e-9 and t > 0.05:
                t /= 4
            w, now = w - t * step, new
            if was - value(now, w) < 1e-4:
                break
        return w, now

    w, now = newton(np.zeros(d), at(np.zeros(d)), 1.0)
    low, high = 0.0, 1.0
    for _ in range(HALVINGS if now[1] < 0 else 0):
        lam = (low + high) / 2
        w, now = newton(w, now, lam)
        if 0 <= now[1] < SLACK:
            break
        low, high = (lam, high) if now[1] >= 0 else (low, lam)
    if now[1] < 0:  # the bracket at the last step; at low it isn't negative
        w, now = newton(w, now, low)
    model.w = w
    return model


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", held_out=None, prior: float | None = None) -> tuple[Model | None, DataFrame]:
    """The model and the feature table (doc_id, f) of all documents.

    held_out(id column as text) says which labels must not be learned from. Documents without a label to learn from are the unlabelled ones.
    """
    held, uri = held_out or held_out_fifth, work_dir(docs.sparkSession, "quality")
    known = labels.where(F.col(label_id).isNotNull() & F.col(label_col).isNotNull() & ~held(F.col(label_id).cast("string")))
    known = known.groupBy(F.col(label_id).cast("long").alias("doc_id")).agg(F.min(F.col(label_col).cast("int")).alias("label"))
    rate = known.agg(F.avg((F.col("label") == 1).cast("double")).alias("p")).first()["p"]
    plain = feature_table(docs, id_col, text_col)
    keyed = plain.where(F.col("doc_id") != NULL_ID).join(known, "doc_id", "left")
    rows = keyed.unionByName(plain.where(F.col("doc_id") == NULL_ID).withColumn("label", F.lit(None).cast("int")))  # null ids meet no label
    # kind: 1 trusted positive, 0 unlabelled, -1 a label that isn't used
    rows = rows.select("doc_id", "f", F.expr("case when label is null then 0 when label = 1 then 1 else -1 end").cast("int").alias("kind"))
    table = write_once(rows, f"{uri}/features")
    model = None if rate is None else fit(table.where("kind >= 0").select("f", "kind"), min(0.99, max(0.01, rate if prior is None else prior)))
    return model, table.select("doc_id", "f")


def held_out_fifth(id_text_col):
    return F.crc32(id_text_col.cast("binary")) % 5 == 0


def scores(model: Model | None, f: np.ndarray) -> np.ndarray:
    return model.score(f) if model else np.full(len(f), 0.5)


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, held_out=None, **names) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; the other parameters are those of train()."""
    model, table = train(docs, labels, held_out=held_out, **names)
    held = held_out or held_out_fifth

    def score(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores(model, _matrix(b.column("f"))))], ["doc_id", "score"])

    out = table.mapInArrow(tidy(score), "doc_id long, score double").select(null_id(), "score")
    return out.select("doc_id", F.coalesce(held(F.col("doc_id").cast("string")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, text_col: str = "text", **names) -> DataFrame:
    """The rows of docs whose score reaches the threshold, with all their columns; nothing is shuffled for that."""
    model, _ = train(docs, labels, text_col=text_col, **names)

    def keep(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                p = b.slice(at, 1024)
                text = p.column(b.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
                f = np.stack([features(t or b"") for t in text]).astype(np.float64)
                yield p.filter(pa.array(scores(model, f) >= threshold))

    return docs.mapInArrow(tidy(keep), docs.schema)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
