"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character 1- to 3-grams: letters are
lower-cased, digits and everything else fold to a blank. Document frequencies
come from all training rows; the weights are learnt from a bounded sample of
them with follow-the-regularised-leader (per-coordinate rates, L1 and L2
penalties, so most weights are exactly zero). Shards of the sample learn in
parallel from the same state; the states are averaged after each round. A
temperature fitted on a part of the sample that no shard saw calibrates the
scores.

State and weights have ``buckets`` x languages entries whatever the input; they
pass through the driver and are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ordermill.llm.common import id_remainder, slices

BUCKETS = 1 << 15
PER_LANGUAGE = 2_000
SHARDS = 6
ROUNDS = 2
MINI_BATCH = 32
ALPHA, BETA = 0.5, 1.0
L1, L2 = 0.0005, 0.001
UNDETERMINED = "und"

_BLANK = np.uint32(32)
_MIX = np.uint32(2654435761)


def _folded(text: str) -> np.ndarray:
    """Code points of the text, runs of non-letters as one blank."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype="<u4").copy()
    ascii_letter = (codes >= 97) & (codes <= 122)
    codes[~ascii_letter & (codes < 192)] = _BLANK
    blank = codes == _BLANK
    return codes[~(blank & np.concatenate([[False], blank[:-1]]))]


def gram_counts(text: str, buckets: int) -> np.ndarray:
    """How often each hashed 1- to 3-gram occurs."""
    codes = _folded(text)
    total = np.zeros(buckets, dtype=np.int64)
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    for at in range(0, max(len(codes) - 2, 1), 1 << 20):
        part = codes[at : at + (1 << 20) + 2]
        gram = part
        last = at + (1 << 20) + 2 >= len(codes)
        for n in (1, 2, 3):
            if n > 1:
                if len(part) < n:
                    break
                gram = gram[:-1] * np.uint32(1000003) + part[n - 1 :] + np.uint32(n)
            own = gram if last else gram[: 1 << 20]
            total += np.bincount((own * _MIX) >> shift, minlength=buckets)
    return total


def _weighted(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one."""
    rows = np.empty((len(texts), len(idf)), dtype=np.float32)
    for i, text in enumerate(texts):
        counts = gram_counts(text, len(idf))
        rows[i] = np.log1p(counts) * idf
        norm = np.sqrt((rows[i] ** 2).sum())
        rows[i] /= norm or 1.0
    return rows


@dataclass
class Leader:
    """State of follow-the-regularised-leader: linear terms and squared gradients."""

    z: np.ndarray
    n: np.ndarray

    def weights(self) -> np.ndarray:
        shrunk = np.sign(self.z) * np.maximum(np.abs(self.z) - L1, 0)
        return (-shrunk / ((BETA + np.sqrt(self.n)) / ALPHA + L2)).astype(np.float32)

    def learn(self, rows: np.ndarray, classes: np.ndarray) -> None:
        for at in range(0, len(rows), MINI_BATCH):
            x, y = rows[at : at + MINI_BATCH], classes[at : at + MINI_BATCH]
            w = self.weights()
            error = _softmax(x @ w)
            error[np.arange(len(y)), y] -= 1
            g = (x.T @ error / len(y)).astype(np.float64)
            rate = (np.sqrt(self.n + g * g) - np.sqrt(self.n)) / ALPHA
            self.z += g - rate * w
            self.n += g * g


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The factor on the logits with the best likelihood, by ternary search on its log.

    Targets are smoothed by one pseudo count over all rows, so that rows without
    any error do not make the factor grow without end.
    """
    if not len(logits):
        return 1.0

    def loss(t: float) -> float:
        p = np.log(np.maximum(_softmax(logits * np.exp(t)), 1e-12))
        own = p[np.arange(len(classes)), classes]
        return float(-(own + (p.mean(axis=1) - own) / (len(p) + 1)).mean())

    low, high = -4.0, 6.0
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        p = _softmax(_weighted(texts, self.idf) @ self.weights * self.temperature)
        return p.argmax(axis=1), p.max(axis=1)


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, buckets: int = BUCKETS) -> Model:
    """A model for the languages of ``labelled`` (text, lang), rows without nulls."""
    spark = labelled.sparkSession

    def frequencies(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, dtype=np.int64)
        rows = 0
        for batch in slices(parts, "text", 8 << 20):
            for text in batch.column("text").to_pylist():
                seen += gram_counts(text, buckets) > 0
                rows += 1
        if rows:
            at = np.flatnonzero(seen)
            yield pa.record_batch(
                [np.concatenate([[-1], at]), np.concatenate([[rows], seen[at]])],
                names=["bucket", "n"])

    sums = {r.bucket: r.n for r in labelled.select("text").mapInArrow(
        frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    rows = sums.pop(-1, 0)
    seen = np.zeros(buckets)
    seen[list(sums)] = list(sums.values())
    idf = (np.log((1 + rows) / (1 + seen)) + 1).astype(np.float32)

    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("of"))
    place = F.xxhash64("text", F.lit("sample")).cast("double") / 2.0**64 + 0.5
    part = F.pmod(F.xxhash64("text", F.lit("part")), F.lit(SHARDS + 1))
    sample = (
        labelled.join(F.broadcast(counts), "lang")
        .filter(place * F.col("of") < per_language)
        .select("text", "lang", part.alias("part"))
    )
    languages = sorted(r.lang for r in counts.collect())
    number = {name: i for i, name in enumerate(languages)}
    if not languages:
        return Model([], idf, np.zeros((buckets, 0), dtype=np.float32))

    state = Leader(np.zeros((buckets, len(languages))), np.zeros((buckets, len(languages))))
    model = Model(languages, idf, state.weights())
    sample = sample.repartition(SHARDS + 1, "part").persist()
    try:
        for _ in range(ROUNDS):
            start = spark.sparkContext.broadcast((state, idf))

            def shard(key: tuple, rows: pa.Table) -> pa.Table:
                own, idf = start.value
                own = Leader(own.z.copy(), own.n.copy())
                texts = rows.column("text").to_pylist()
                classes = np.array([number[x] for x in rows.column("lang").to_pylist()])
                order = np.random.default_rng(0).permutation(len(texts))
                for at in range(0, len(texts), 256):
                    some = order[at : at + 256]
                    own.learn(_weighted([texts[i] for i in some], idf), classes[some])
                return pa.table({"z": [own.z.tobytes()], "n": [own.n.tobytes()]})

            states = sample.filter(F.col("part") < SHARDS).groupBy("part").applyInArrow(
                shard, "z binary, n binary").collect()
            if states:
                z, n = (
                    np.mean([np.frombuffer(bytes(s[k])) for s in states], axis=0).reshape(state.z.shape)
                    for k in ("z", "n"))
                state = Leader(z, n)
        model.weights = state.weights()
        shared = spark.sparkContext.broadcast(model)

        def logits(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(parts, "text", 4 << 20):
                out = _weighted(batch.column("text").to_pylist(), shared.value.idf) @ shared.value.weights
                yield pa.record_batch(
                    [batch.column("lang"), pa.array(out.astype(float).tolist(), pa.list_(pa.float64()))],
                    names=["lang", "logits"])

        kept = sample.filter(F.col("part") == SHARDS).select("text", "lang").mapInArrow(
            logits, "lang string, logits array<double>").collect()
    finally:
        sample.unpersist()
    if kept:
        model.temperature = _temperature(
            np.array([r.logits for r in kept]), np.array([number[r.lang] for r in kept]))
    return model


def identify(
    docs: DataFrame,
    held_divisor: int = 5,
    held_remainder: int = 0,
    per_language: int = PER_LANGUAGE,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Rows held out by the crc32 of their id, rows without text or language teach
    nothing. Null texts and texts without a letter are ``und`` with score 1;
    so is every text, with score 0, if there is nothing to learn from. Repeated
    rows and null ids are rows like any other. About ``per_language`` rows of
    each language, those of the smallest text hash, are learnt from.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"))
    held = id_remainder(held_divisor) == held_remainder
    labelled = rows.filter(~held & F.col("text").isNotNull() & F.col("lang").isNotNull())
    shared = docs.sparkSession.sparkContext.broadcast(
        train(labelled.select("text", "lang"), per_language, buckets))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNDETERMINED], dtype=object)
        for batch in slices(parts, "text", 4 << 20):
            texts = batch.column("text").to_pylist()
            best = np.full(len(texts), len(model.languages))
            score = np.ones(len(texts))
            told = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))]
            if not model.languages:
                score[told] = 0.0
            elif told:
                for at in range(0, len(told), 512):
                    some = told[at : at + 512]
                    best[some], score[some] = model.predict([texts[i] for i in some])
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array(names[best].tolist(), pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.select(
        "doc_id", held.alias("held_out"), F.coalesce("text", F.lit("")).alias("text")
    ).mapInArrow(batches, "doc_id long, held_out boolean, lang_pred string, score double")
