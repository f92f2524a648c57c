"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by SGD in numpy.

A text is its lower-cased UTF-8 bytes; every run of 2, 3 and 4 bytes is hashed to a bucket, the
buckets' embeddings are averaged over the whole text and a linear layer gives the languages' logits.
Fitting sees a bounded sample: FIT_DOCS documents in all, shared equally among all labels, but FIT_LEAST a label where there
are that many labels; they are drawn by a hash of the text, equal texts once, of at most FIT_CHARS characters each (longer ones are not drawn).
A part of the sample stays out of training and sets the softmax temperature and the score below
which a prediction is rejected. Prediction sends only the product of embeddings and linear layer.

Defined cases: a null text or one without a letter is `und` with score 0; an empty table, or one
without labels, predicts `und`; both are rejected; rows that repeat a doc_id are predicted each; extra columns pass
through `identify`, columns named like its results are replaced. The score of a short text is that of the softmax, so
that texts of another script, whose subwords training never saw, fall below the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from framewright.llm.common import table, unit

BUCKETS, WIDTH, EPOCHS, BATCH, RATE = 1 << 14, 16, 12, 32, 0.5
FIT_DOCS, FIT_LEAST, FIT_CHARS, CLIP = 1200, 4, 40_000, 60
REJECT_RATE, REJECT_MOST = 0.001, 0.5
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def gram_counts(text: str) -> np.ndarray:
    """How often each bucket occurs in the whole text."""
    b = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + b[2:] * np.uint32(0x27D4EB2F)
    four = three[:-1] * np.uint32(0x165667B1) + b[3:] * np.uint32(0x9E3779B1)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    mixed = [((g ^ (g >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> shift for g in (two, three, four)]
    return np.bincount(np.concatenate(mixed), minlength=BUCKETS)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # a row of logits for each bucket, the linear layer applied to its embedding
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def scores(self, counts: np.ndarray) -> np.ndarray:
        used = np.flatnonzero(counts)
        logits = (counts[used] @ self.table[used] / counts.sum() + self.bias) / self.temperature
        e = np.exp(logits - logits.max())
        return e / e.sum()

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or text is None or not LETTER.search(text):
            return UNKNOWN, 0.0
        p = self.scores(gram_counts(text))
        return self.langs[int(p.argmax())], float(p.max())


def train(rows: list[tuple[str, str]], seed: int = 8) -> Model:
    """rows: (text, language), whole texts. Each gives two examples: itself and a short cut from its middle."""
    langs = sorted({lang for _, lang in rows})
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    rng = np.random.default_rng(seed)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    held = len(rows) // 6
    number = {lang: i for i, lang in enumerate(langs)}

    def examples(part: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
        texts = [x for t, lang in part for x in ((t, lang), (t[len(t) // 2 : len(t) // 2 + CLIP], lang)) if LETTER.search(x[0])]
        x = np.zeros((len(texts), BUCKETS), np.float32)
        for row, (t, _) in zip(x, texts, strict=True):
            c = gram_counts(t)
            row[:] = c / c.sum()
        return x, np.asarray([number[lang] for _, lang in texts], np.int64)

    x, y = examples(rows[held:])
    emb = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (WIDTH, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
    target = np.eye(len(langs), dtype=np.float32)[y]
    steps, done = EPOCHS * -(-len(x) // BATCH), 0
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(len(x)), max(1, -(-len(x) // BATCH))):
            rate = RATE * (1 - done / steps)
            done += 1
            mean = x[at] @ emb
            z = mean @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            gap = p / p.sum(axis=1, keepdims=True) - target[at]
            back = gap @ out.T
            out -= rate * mean.T @ gap / len(at) * 10
            bias -= rate * gap.mean(axis=0)
            emb -= rate * (x[at].T @ back) * 10
    model = Model(langs, (emb @ out).astype(np.float32), bias)
    x, y = examples(rows[:held] or rows)
    z = x @ model.table + model.bias

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    model.temperature = min(np.geomspace(0.05, 20, 121), key=loss)
    s = np.exp((z - z.max(axis=1, keepdims=True)) / model.temperature)
    best, right = (s / s.sum(axis=1, keepdims=True)).max(axis=1), z.argmax(axis=1) == y
    model.reject_below = min(REJECT_MOST, float(np.quantile(best[right], REJECT_RATE))) if right.any() else 0.0
    return model


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, seed: int = 8) -> Model:
    """Train on a bounded sample of the labelled rows of docs (text, lang)."""
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length("text") <= FIT_CHARS))
    texts = usable.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n"))
    counts = [(r["lang"], max(1, r["n"])) for r in texts.orderBy("lang").collect()]  # a row a label, as the model has
    if not counts:
        return train([])
    most = max(FIT_LEAST, FIT_DOCS // len(counts))
    shares = docs.sparkSession.createDataFrame([(lang, min(1.0, 1.3 * most / n)) for lang, n in counts], "known string, share double")
    drawn = usable.select("lang", "text", unit(F.col("text"), F.lit(seed)).alias("h")).join(F.broadcast(shares), F.col("lang") == F.col("known")).where(F.col("h") < F.col("share")).dropDuplicates(["lang", "text"])
    nth = F.row_number().over(W.partitionBy("lang").orderBy("h", "text"))  # of little more than the sample
    rows = drawn.select("lang", "text", "h", nth.alias("nth")).where(F.col("nth") <= most).collect()
    return train([(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"], r["nth"]))], seed)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, score and rejected."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            lang, score = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            no = pa.array([f[0] == UNKNOWN or f[1] < model.reject_below for f in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lang, score, no], names=[*kept, "lang_pred", "score", "rejected"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.select(*kept, F.col("text").cast("string").alias("__text")).mapInArrow(predict, f"{fields}, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs whose language is accepted, in docs' own columns."""
    return identify(docs, model).where(~F.col("rejected")).select(*docs.columns)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
