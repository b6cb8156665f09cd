"""Language identification with a byte convolutional network.

A text is cut into windows of ``WINDOW`` bytes. Bytes are embedded, filters of
widths 2, 3 and 4 run over each window, max pooling and ReLU follow, then a
softmax over the learned languages. A text's probabilities are the mean over all
its windows. The network is trained in numpy on a bounded sample of labelled
documents; prediction folds embedding and filters into two tables indexed by
byte pairs, which gives the same sums with two lookups for each position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusqa.llm.common import byte_values, crc32_mod, pieces, widen

WINDOW = 256
WIDTHS = (2, 3, 4)
REACH = max(WIDTHS)
FILTERS = 12  # of each width
EMBED = 8
DOCS_PER_LANG = 300  # bound of the training sample
WINDOWS_PER_DOC = 6
EPOCHS = 6
UNKNOWN = "und"


@dataclass
class Model:
    langs: list
    embed: object  # 256 x EMBED
    filters: object  # REACH x EMBED x F; offsets beyond a filter's width are zero
    bias: object
    out: object  # F x langs
    out_bias: object


def windows(raw: bytes):
    """The bytes of a text as rows of ``WINDOW``, the last filled up with zeros."""
    import numpy as np

    n = max(1, -(-len(raw) // WINDOW))
    return np.frombuffer(raw.lower().ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train(x, y, langs: list, seed: int = 7) -> Model:
    """Adam on the cross-entropy of windows ``x`` (n x WINDOW bytes) and language numbers ``y``."""
    import numpy as np

    rng = np.random.default_rng(seed)
    width = np.repeat(WIDTHS, FILTERS)
    inside = (np.arange(REACH)[:, None] < width)[:, None, :].astype(np.float32)
    p = {
        "embed": rng.normal(0, 0.5, (256, EMBED)),
        "filters": rng.normal(0, 0.3, (REACH, EMBED, len(width))),
        "bias": np.zeros(len(width)),
        "out": rng.normal(0, 0.3, (len(width), len(langs))),
        "out_bias": np.zeros(len(langs)),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    p["filters"] *= inside
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    every, step, batch, span = np.arange(len(width)), 0, 64, WINDOW - REACH + 1
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
            xb, yb, n = x[rows], y[rows], len(rows)
            tables = np.einsum("be,oef->obf", p["embed"], p["filters"])
            z = tables[0][xb[:, :span]]
            for o in range(1, REACH):
                z += tables[o][xb[:, o : o + span]]
            at = z.argmax(axis=1)  # n x F
            top = np.take_along_axis(z, at[:, None, :], 1)[:, 0] + p["bias"]
            h = np.maximum(top, 0)
            logit = h @ p["out"] + p["out_bias"]
            prob = np.exp(logit - logit.max(axis=1, keepdims=True))
            prob /= prob.sum(axis=1, keepdims=True)
            prob[np.arange(n), yb] -= 1
            prob /= n
            dh = (prob @ p["out"].T) * (top > 0)
            g = {"out": h.T @ prob, "out_bias": prob.sum(axis=0), "bias": dh.sum(axis=0)}
            g["filters"], g["embed"] = np.zeros_like(p["filters"]), np.zeros_like(p["embed"])
            for o in range(REACH):
                byte = xb[np.arange(n)[:, None], at + o]
                g["filters"][o] = np.einsum("nfe,nf->ef", p["embed"][byte], dh)
                np.add.at(g["embed"], byte, dh[..., None] * p["filters"][o].T[every][None])
            g["filters"] *= inside
            step += 1
            for k, v in p.items():
                m, s = moment[k]
                m += 0.1 * (g[k] - m)
                s += 0.01 * (g[k] * g[k] - s)
                v -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return Model(langs, p["embed"], p["filters"], p["bias"], p["out"], p["out_bias"])


class Predictor:
    """A model with its tables of byte pairs."""

    def __init__(self, model: Model):
        import numpy as np

        t = np.einsum("be,oef->obf", model.embed, model.filters).astype(np.float32)
        n = t.shape[2]
        self.first = (t[0][:, None] + t[1][None]).reshape(65536, n)
        self.second = (t[2][:, None] + t[3][None]).reshape(65536, n)
        self.model = model

    def probabilities(self, x):
        """Softmax of each window of ``x`` (n x WINDOW bytes)."""
        import numpy as np

        model, span, out = self.model, WINDOW - REACH + 1, []
        for i in range(0, len(x), 64):
            own = x[i : i + 64].astype(np.uint16)
            pair = (own[:, :-1] << 8) | own[:, 1:]
            z = self.first[pair[:, :span]]
            z += self.second[pair[:, 2 : 2 + span]]
            h = np.maximum(z.max(axis=1) + model.bias, 0)
            logit = h @ model.out + model.out_bias
            prob = np.exp(logit - logit.max(axis=1, keepdims=True))
            out.append(prob / prob.sum(axis=1, keepdims=True))
        return np.concatenate(out)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", docs_per_lang: int = DOCS_PER_LANG, windows_per_doc: int = WINDOWS_PER_DOC) -> Model | None:
    """A model learned from up to ``docs_per_lang`` labelled documents of each
    language (of the first by a hash of their id), ``windows_per_doc`` windows of each
    spread over its text. An id that repeats counts once. None if no labelled document
    has a letter."""
    import numpy as np

    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # the first by hash lie, but for chance, below this share of the hashes: only
    # they go to the task that ranks a language, however many tasks read it
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("id", 0.02).alias("of"))
    low = F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(1 << 30)) / F.lit(1 << 30) <= F.lit(4 * docs_per_lang + 100) / F.col("of")
    # one row a language, so the share is known before any key is shuffled
    keys = rows.select("id", "lang").join(F.broadcast(counts), "lang").filter(low).distinct()
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(1 << 30)), "id"))
    chosen = keys.withColumn("n", first).filter(F.col("n") <= docs_per_lang).select("id", "lang")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            for part in pieces(batch):
                own = []
                for raw in byte_values(part.column(2)):
                    x = windows(raw)
                    own.append([x[i].tobytes() for i in sorted({len(x) * k // windows_per_doc for k in range(windows_per_doc)})])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(own, pa.list_(pa.binary()))], names=["id", "lang", "x"])

    kind = rows.schema["id"].dataType.simpleString()
    cuts = rows.join(F.broadcast(chosen), ["id", "lang"]).select("id", "lang", "text").mapInArrow(cut, f"id {kind}, lang string, x array<binary>")
    sample = cuts.groupBy("id", "lang").agg(F.min("x").alias("x")).collect()  # one for each chosen id
    sample = sorted((r.lang, bytes(x)) for r in sample for x in r.x)
    if not sample:
        return None
    langs = sorted({lang for lang, _ in sample})
    x = np.frombuffer(b"".join(x for _, x in sample), np.uint8).reshape(-1, WINDOW)
    return train(x, np.array([langs.index(lang) for lang, _ in sample]), langs)


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` (other columns in ``row``) with lang_pred and score, the
    mean probability of that language. A null text, one without a letter, or no
    model gives ``und`` and score 0. Ties go to the first language by name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    rows = docs.select(own.alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        net = Predictor(shared.value) if shared.value else None
        for batch in batches:
            for part in pieces(batch, 200):
                lang, score = [UNKNOWN] * part.num_rows, [0.0] * part.num_rows
                known = [i for i, t in enumerate(part.column(1).to_pylist()) if net and t and has_letter(t)]
                if known:
                    raw = byte_values(part.column(1))
                    x = [windows(raw[i]) for i in known]
                    ends = np.cumsum([len(w) for w in x])
                    prob = net.probabilities(np.concatenate(x))
                    mean = np.add.reduceat(prob.astype(float), np.append(0, ends[:-1]), axis=0) / np.diff(ends, prepend=0)[:, None]
                    for i, m in zip(known, mean):
                        lang[i], score[i] = net.model.langs[int(m.argmax())], float(min(m.max(), 1.0))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["row", "lang_pred", "score"])

    return rows.mapInArrow(run, widen(rows.select("row").schema, "lang_pred string, score double"))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, held: int = 2) -> DataFrame:
    """Learn from the documents whose crc32(doc_id as text) mod ``folds`` is not
    ``held`` and predict all: doc_id, held_out, lang_pred, score. Only text is read
    for a prediction. A null doc_id is neither held out nor learned from."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    fold = crc32_mod("doc_id", folds)
    model = fit(rows.filter(fold != held), "doc_id")
    out = predict(rows.select("doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "text"), model)
    return out.select("row.doc_id", "row.held_out", "lang_pred", "score")
