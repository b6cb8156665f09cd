"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= g) = sigmoid(threshold_g - s), with one score s = w . x for all
grades and rising thresholds. x marks the text's distinct words, hashed, and a
few figures of its form. The model is trained in numpy on a bounded sample of
labelled documents; a text's expected grade and the probability of the top grade
follow from s.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusqa.llm.common import byte_values, pieces, widen

BUCKETS = 1 << 18
MAX_LABELLED = 10_000  # bound of the training sample
MIN_DOCS = 4  # documents of the sample in which a bucket must stand to have a weight
STEPS = 250
LASSO = 0.02  # by which each step draws a word's weight towards zero: most words get none
TOP_AT_LEAST = 0.4  # probability of the top grade from which a document is kept
MEMO = 300_000

# A-Z to a-z; all but letters and bytes from 0x80 on to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_UPPER = bytes(range(65, 91))
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,'-")
FORM = 7


def grade(quality, toxic):
    """The graded rating of a label: 0 toxic, 1 poor, 2 good."""
    return F.when(toxic == 1, 0).when(quality == 1, 2).otherwise(1)


def features(raw: bytes) -> tuple[list[bytes], list[float]]:
    """The distinct words of a UTF-8 text and the figures of its form."""
    words = raw.translate(_FOLD).split()
    distinct = set(words)
    n, size = max(len(words), 1), max(len(raw), 1)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    signs = len(raw) - len(raw.translate(None, _SIGNS))
    lines = raw.count(b"\n") + 1
    form = [
        upper / size * 4,
        signs / size * 8,
        1 - len(distinct) / n,
        math.log1p(len(words)) / 5,
        math.log1p(sum(map(len, distinct)) / max(len(distinct), 1)) / 2,
        math.log1p(n / lines) / 4,
        min(len(raw.split()) / n, 3.0),
    ]
    return list(distinct), form


def bucket(word: bytes) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(word) % BUCKETS


@dataclass
class Model:
    weights: object  # by bucket
    form: object
    centre: object  # of the figures of form
    spread: object
    thresholds: object  # rising; one fewer than grades

    def at_most(self, s: float) -> list[float]:
        """P(grade <= g) for all grades but the top one."""
        return [1 / (1 + math.exp(min(max(s - t, -500.0), 500.0))) for t in self.thresholds]


def train(rows: list[tuple], grades: int = 3, steps: int = STEPS) -> Model:
    """Full-batch Adam on the log-likelihood, with a ridge and a lasso on the words, over
    (grade, buckets, form) rows."""
    import numpy as np

    y = np.array([r[0] for r in rows])
    size = np.array([len(r[1]) for r in rows])
    flat = np.concatenate([np.asarray(r[1], np.int32) for r in rows])
    row = np.repeat(np.arange(len(rows), dtype=np.int32), size)
    seen = np.bincount(flat, minlength=BUCKETS) >= MIN_DOCS
    use = seen[flat]
    own, flat = np.unique(flat[use], return_inverse=True)
    flat = flat.astype(np.int32)
    row = row[use]
    form = np.array([r[2] for r in rows], float)
    centre, spread = form.mean(axis=0), form.std(axis=0) + 1e-6
    form = (form - centre) / spread
    share = np.array([(y <= g).mean() for g in range(grades - 1)]).clip(1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(grades - 1))
    # thresholds as the first and the logarithms of the steps between them
    p = {"w": np.zeros(len(own)), "f": np.zeros(FORM), "t": np.append(start[:1], np.log(np.maximum(np.diff(start), 1e-2)))}
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    ridge = {"w": 2e-5, "f": 1e-4, "t": 0.0}
    sigmoid = lambda z: 1 / (1 + np.exp(-z.clip(-50, 50)))
    n = len(rows)
    for step in range(1, steps + 1):
        gaps = np.exp(p["t"][1:])
        thresholds = np.cumsum(np.append(p["t"][0], gaps))
        s = np.bincount(row, p["w"][flat], minlength=n) + form @ p["f"]
        below = sigmoid(thresholds[None] - s[:, None])  # P(grade <= g)
        cum = np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1)
        hi, lo = cum[np.arange(n), y + 1], cum[np.arange(n), y]
        ds = 1 - hi - lo  # of -log P(grade), by s
        slope = below * (1 - below) / np.maximum(hi - lo, 1e-12)[:, None]
        dt = np.stack([slope[:, g] * ((y == g) * 1.0 - (y == g + 1)) for g in range(grades - 1)]).sum(axis=1) / n
        g = {"w": np.bincount(flat, ds[row], minlength=len(own)) / n, "f": form.T @ ds / n}
        later = np.cumsum(dt[::-1])[::-1]  # a step moves all thresholds after it
        g["t"] = -np.append(later[0], later[1:] * gaps)
        for k, v in p.items():
            d = g[k] + ridge[k] * v
            m, q = moment[k]
            m += 0.1 * (d - m)
            q += 0.01 * (d * d - q)
            v -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.99**step)) + 1e-8)
        p["w"] = np.sign(p["w"]) * np.maximum(np.abs(p["w"]) - LASSO, 0)
    weights = np.zeros(BUCKETS, np.float32)
    weights[own] = p["w"]
    thresholds = np.cumsum(np.append(p["t"][0], np.exp(p["t"][1:]))).tolist()
    return Model(weights, p["f"], centre, spread, thresholds)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED) -> Model | None:
    """A model of ``labels`` (doc_id, quality, toxic; rows with a null are left out)
    and the texts of ``docs``, learned from the first ``max_labelled`` labels by a
    hash of their id; of documents that share an id one is learned from. None without a
    labelled text."""
    import numpy as np

    rated = labels.select("doc_id", grade(F.col("quality"), F.col("toxic")).alias("grade"), "quality", "toxic").dropna()
    rated = rated.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(max_labelled).select(F.col("doc_id").alias("rated_id"), "grade")
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).filter(F.col("text").isNotNull())
    rows = rows.join(F.broadcast(rated), F.col("id") == F.col("rated_id")).select("id", "grade", "text")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in pieces(batch, 500):
                found = [features(raw) for raw in byte_values(part.column(2))]
                own = [np.array(sorted({bucket(w) for w in f[0]}), "<i4").tobytes() for f in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(own, pa.binary()), pa.array([f[1] for f in found], pa.list_(pa.float64()))],
                    names=["id", "grade", "buckets", "form"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    sample = rows.mapInArrow(run, f"id {kind}, grade int, buckets binary, form array<double>")
    sample = sample.groupBy("id", "grade").agg(F.min(F.struct("buckets", "form")).alias("own")).collect()
    sample = sorted((r.id, r.grade, bytes(r.own.buckets), r.own.form) for r in sample)
    return train([(grade, np.frombuffer(own, "<i4"), form) for _, grade, own, form in sample]) if sample else None


def rate(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` (in ``row``) with expected_grade (0 to 2) and p_top, the
    tail probability of the top grade. Null texts are empty. Without a model both
    are null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        import pyarrow as pa

        model, memo = shared.value, {}
        for batch in batches:
            for part in pieces(batch, 500):
                expected, top = [], []
                for raw in byte_values(part.column(1)) if model else []:
                    words, form = features(raw)
                    if len(memo) > MEMO:
                        memo.clear()
                    s = 0.0
                    for w in words:
                        weight = memo.get(w)
                        if weight is None:
                            weight = memo[w] = float(model.weights[bucket(w)])
                        s += weight
                    s = math.fsum([s, *(f * (x - c) / d for f, x, c, d in zip(model.form, form, model.centre, model.spread))])
                    below = model.at_most(s)
                    expected.append(sum(1 - b for b in below))
                    top.append(1 - below[-1])
                none = [None] * part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(expected if model else none, pa.float64()), pa.array(top if model else none, pa.float64())],
                    names=["row", "expected_grade", "p_top"],
                )

    return rows.mapInArrow(run, widen(rows.select("row").schema, "expected_grade double, p_top double"))


def select(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", top_at_least: float = TOP_AT_LEAST) -> DataFrame:
    """``rate`` by a model fitted on ``docs`` and ``labels``, and ``keep``: the top
    grade's probability reaches ``top_at_least`` (always, without a model). Rows
    that repeat are rated each by itself; an empty table gives an empty result."""
    rated = rate(docs, fit(docs, labels, doc_id, text), text)
    return rated.withColumn("keep", F.coalesce(F.col("p_top") >= top_at_least, F.lit(True)))
