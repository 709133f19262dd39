"""Language mixtures of documents by expectation-maximisation over n-grams.

The likelihood of a language is a smoothed distribution over hashed byte
trigrams, counted over every training row. A document is a mixture of languages;
EM estimates the proportions, and the set of languages is chosen by penalised
likelihood: a further language has to raise the log-likelihood by more than
``PENALTY * log(n)`` per proportion.

The model has ``BUCKETS`` numbers per language and so does not grow with the
data; the number of languages is that of the language codes in the table.

Defined results: null texts and texts without a letter are ``und`` with score 0,
as is every text if there is nothing to learn from; rows with a null language
are predicted but not learned from; equal proportions go to the language whose
code sorts first. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
PENALTY = 3.0
ROUNDS = 10
PIECE = 1 << 16
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the byte trigrams of a text, in pieces."""
    raw = np.frombuffer(b" " + text.lower().encode() + b" ", dtype=np.uint8)
    for at in range(0, len(raw) - 2, PIECE):
        part = raw[at : at + PIECE + 2].astype(np.uint32)
        code = (part[:-2] << 16) | (part[1:-1] << 8) | part[2:]
        yield ((code * np.uint32(2654435769)) >> np.uint32(32 - 15)).astype(np.int64)


def counts(rows: DataFrame) -> DataFrame:
    """(lang, bucket, n) summed over rows of (text, lang)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                total = totals.setdefault(lang.as_py(), np.zeros(BUCKETS, dtype=np.int64))
                for part in grams(text.as_py()):
                    if len(part) > BUCKETS // 8:
                        total += np.bincount(part, minlength=BUCKETS)
                    else:
                        np.add.at(total, part, 1)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at])],
                names=["lang", "bucket", "n"],
            )

    return (
        rows.where("text is not null and lang is not null")
        .select("text", "lang")
        .mapInArrow(counted, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


class Mixtures:
    """Likelihoods of all languages per bucket, scaled by the best of the bucket."""

    def __init__(self, languages: list[str], totals: np.ndarray):
        self.languages = languages
        if not languages:
            return
        share = (totals + 0.5) / (totals.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
        self.likelihood = (share / share.max(axis=0)).T.astype(np.float32).copy()

    def proportions(self, text: str) -> tuple[np.ndarray, int]:
        """Proportion of each language and the number of n-grams."""
        if len(text) <= PIECE // 4:
            found = np.concatenate(list(grams(text)))
            rows, weight, n = self.likelihood[found], None, len(found)
        else:
            total = np.zeros(BUCKETS, dtype=np.int64)
            for part in grams(text):
                total += np.bincount(part, minlength=BUCKETS)
            at = np.flatnonzero(total)
            rows, weight, n = self.likelihood[at], total[at].astype(np.float32), int(total.sum())

        def score(value: np.ndarray) -> float:
            logs = np.log(value)
            return float(logs.sum(dtype=np.float64) if weight is None else logs @ weight)

        def mixture(chosen: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
            own = rows[:, chosen] if len(chosen) < rows.shape[1] else rows
            share = np.full(len(chosen), 1 / len(chosen), dtype=np.float32)
            for _ in range(rounds):
                pull = 1 / (own @ share)
                share = share * (own.T @ (pull if weight is None else pull * weight)) / n
            return share, score(own @ share)

        every = np.arange(rows.shape[1])
        whole, limit = mixture(every, ROUNDS if len(every) > 1 else 0)
        order = np.argsort(-whole, kind="stable")
        cost = PENALTY * np.log(n)
        best, chosen = score(rows[:, order[0]]), (order[:1], np.ones(1))
        for k in range(2, len(every) + 1):
            if limit - (k - 1) * cost <= best:  # no larger set can do better
                break
            share, value = mixture(order[:k], ROUNDS)
            if value - (k - 1) * cost <= best:
                break
            best, chosen = value - (k - 1) * cost, (order[:k], share)
        out = np.zeros(len(every))
        out[chosen[0]] = chosen[1]
        return out, n

    def predict(self, text: str | None) -> tuple[str, float, dict[str, float]]:
        if not self.languages or not text or not LETTER.search(text):
            return UNKNOWN, 0.0, {}
        share, n = self.proportions(text)
        k = int(share.argmax())
        mixed = {self.languages[i]: float(share[i]) for i in np.flatnonzero(share)}
        return self.languages[k], min(1.0, float(share[k])) * n / (n + 10), mixed


def learned(rows: DataFrame) -> Mixtures:
    """The model of rows (text, lang): BUCKETS numbers per language reach the driver."""
    table = counts(rows).toPandas()
    languages = sorted(table["lang"].unique())
    totals = np.zeros((len(languages), BUCKETS))
    at = {lang: k for k, lang in enumerate(languages)}
    totals[table["lang"].map(at).to_numpy(dtype=int), table["bucket"].to_numpy(dtype=int)] = table["n"]
    return Mixtures(languages, totals)


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo a number."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def predicted(docs: DataFrame, model: Mixtures, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score and the mixture of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found]),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([list(f[2].items()) for f in found], pa.map_(pa.string(), pa.float64())),
                ],
                names=["id", "lang_pred", "score", "mixture"],
            )

    return docs.select(key, text).mapInArrow(
        scored, f"{key} {kind}, lang_pred string, score double, mixture map<string,double>"
    )


def training(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(text, lang) of the rows that are not held out."""
    return docs.where(remainder(key, 4) != 2).select(
        F.col(text).alias("text"), F.col(lang).alias("lang")
    )


def determined(docs: DataFrame, model: Mixtures, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose language can be told."""
    at = docs.columns.index(text)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = [model.predict(t.as_py())[0] != UNKNOWN for t in batch.column(at)]
            yield batch.filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """key, held_out, lang_pred, score and mixture; rows with remainder 2 of 4 are held out."""
    model = learned(training(docs, key, text, lang))
    return predicted(docs, model, key, text).withColumn(
        "held_out", F.coalesce(remainder(key, 4) == 2, F.lit(False))
    )
