"""Benchmark passages in documents: BM25 with block-max pruning, then overlap.

Test items are indexed by word; every passage of every document is a query.

* Item weights are divided by the score of the item with itself, so one
  threshold holds for all.
* Items stand in blocks. Common words are left out of the first pass (their
  greatest possible sum is added instead, as for non-essential lists), and a
  passage is scored only in blocks whose summed maxima reach the threshold.
* Items that reach the threshold are compared by word shingles, for the question
  (all but the last sentence) and the answer (the last sentence) apart and for
  the whole item. An item is found where the whole overlap is high enough, or the
  overlaps of question and answer both are, each in its best window of the document.

Passages are windows of twice the longest item, every half window, so any copy of
an item lies inside one. Of a whole question and a whole answer that stand apart, one
window holds half the weight of the item, so the item is retrieved. Word weights
come from all items. Benchmarks are published lists of items; the index is
sent to the tasks for ``ITEMS`` items at a time, whatever their number.

Defined results: case of A-Z is ignored; null or blank texts and items find
nothing; an item shorter than a shingle is one shingle; repeated items are found
each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from wellspring.llm.stages import without
from wellspring.llm.words import Stretches, slices, words

K1, B = 1.2, 0.75
ITEMS = 2_000
BLOCK_ITEMS = 4
#: Words in more than this share of the items are common.
COMMON = 0.1
THRESHOLD = 0.5
OVERLAP = 0.8
SHINGLE = 5
SENTENCE = re.compile(r"(?<=[.?!])\s+|\n+")


def _hashes(text: str) -> np.ndarray:
    return words(next(slices(pa.array([text]))), lower=True).hashes


def _shingles(hashes: np.ndarray) -> tuple[np.ndarray, int]:
    width = min(SHINGLE, len(hashes))
    if not width:
        return np.zeros(0, np.uint64), 0
    return np.unique(Stretches(hashes)(np.arange(len(hashes) - width + 1), width)), width


@dataclass
class Postings:
    """For each term the entries first[t] : first[t + 1] of (slot, weight)."""

    first: np.ndarray
    slot: np.ndarray
    weight: np.ndarray

    def of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into terms, entry) of all entries of some terms."""
        n = self.first[terms + 1] - self.first[terms]
        which = np.repeat(np.arange(len(terms)), n)
        entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[terms], n)
        return which, entry


@dataclass
class Frequencies:
    """Of all items: their number, mean length, and the items each word stands in."""

    n: int
    mean: float
    terms: np.ndarray
    df: np.ndarray

    @classmethod
    def of(cls, groups) -> Frequencies:
        """Summed over groups of (id, text)."""
        n = length = 0
        terms, df = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for rows in groups:
            hashed = [_hashes(t or "") for _, t in rows]
            n, length = n + len(hashed), length + sum(map(len, hashed))
            own = np.concatenate([terms, *map(np.unique, hashed)])
            terms, at = np.unique(own, return_inverse=True)
            df = np.bincount(at, np.append(df, np.ones(len(own) - len(df))), len(terms)).astype(int)
        return cls(n, max(1.0, length / max(1, n)), terms, df)


class Index:
    def __init__(self, items: list[tuple], every: Frequencies | None = None):
        texts = [(i, t or "") for i, t in items]
        self.ids = [i for i, t in texts]
        hashed = [_hashes(t) for _, t in texts]
        self.longest = max(map(len, hashed), default=0)
        every = every or Frequencies.of([items])
        mean = every.mean
        self.terms = np.unique(np.concatenate(hashed))
        term, slot, tf = [], [], []
        for k, h in enumerate(hashed):
            own, n = np.unique(h, return_counts=True)
            term.append(np.searchsorted(self.terms, own))
            slot.append(np.full(len(own), k))
            tf.append(n)
        term, slot, tf = (np.concatenate(x) for x in (term, slot, tf))
        df = every.df[np.searchsorted(every.terms, self.terms)]
        length = np.array([len(h) for h in hashed])[slot]
        weight = np.log(1 + (every.n - df + 0.5) / (df + 0.5))[term]
        weight = weight * tf * (1 + K1) / (tf + K1 * (1 - B + B * length / mean))
        self_score = np.bincount(slot, weight, len(hashed))
        weight = weight / self_score[slot]
        self.items = self._postings(term, slot, weight)
        common = (df > max(1, COMMON * every.n))[term]
        self.blocks_n = -(-len(hashed) // BLOCK_ITEMS)
        # an item made of common words keeps them all in the first pass, so that what
        # is left out never reaches the threshold by itself
        rest = np.bincount(slot[common], weight[common], len(hashed))
        common &= (rest < 0.8 * THRESHOLD)[slot]
        rest = np.bincount(slot[common], weight[common], len(hashed))
        self.rest = np.zeros(self.blocks_n)
        np.maximum.at(self.rest, np.arange(len(hashed)) // BLOCK_ITEMS, rest)
        key = term[~common] * self.blocks_n + slot[~common] // BLOCK_ITEMS
        cells, inverse = np.unique(key, return_inverse=True)
        highest = np.zeros(len(cells))
        np.maximum.at(highest, inverse, weight[~common])
        self.blocks = self._postings(cells // self.blocks_n, cells % self.blocks_n, highest)
        self.parts = []
        for (_, text), h in zip(texts, hashed):
            sentences = [s for s in SENTENCE.split(text) if s.strip()]
            answer = len(_hashes(sentences[-1])) if len(sentences) > 1 else 0
            split = len(h) - answer
            self.parts.append((_shingles(h), _shingles(h[:split]), _shingles(h[split:])))

    def _postings(self, term, slot, weight) -> Postings:
        order = np.lexsort((slot, term))
        first = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        return Postings(first, slot[order], weight[order])

    def retrieved(self, terms: np.ndarray, at: np.ndarray, windows: int):
        """(window, item, score) of all scores from the threshold on.

        terms: known terms of a document at word windows ``at`` (each word stands
        in its own half window and the one before).
        """
        window = np.concatenate((at, at - 1))
        term = np.concatenate((terms, terms))
        inside = (window >= 0) & (window < windows)
        pairs = np.unique(window[inside] * len(self.terms) + term[inside])
        window, term = pairs // len(self.terms), pairs % len(self.terms)
        which, entry = self.blocks.of(term)
        bound = np.bincount(
            window[which] * self.blocks_n + self.blocks.slot[entry],
            self.blocks.weight[entry],
            windows * self.blocks_n,
        ).reshape(windows, self.blocks_n)
        admitted = (bound > 0) & (bound + self.rest >= THRESHOLD - 1e-9)
        if not admitted.any():
            return ()
        wanted = admitted.any(axis=1)[window]
        window, term = window[wanted], term[wanted]
        which, entry = self.items.of(term)
        open_ = admitted[window[which], self.items.slot[entry] // BLOCK_ITEMS]
        which, entry = which[open_], entry[open_]
        cells, inverse = np.unique(
            window[which] * len(self.ids) + self.items.slot[entry], return_inverse=True
        )
        score = np.bincount(inverse, self.items.weight[entry], len(cells))
        return [
            (int(c) // len(self.ids), int(c) % len(self.ids), float(s))
            for c, s in zip(cells, score)
            if s >= THRESHOLD - 1e-9
        ]

    @staticmethod
    def best_share(stretch: Stretches, n: int, stride: int, own: np.ndarray, width: int) -> float:
        """The greatest share of some shingles that one window of a document holds.

        Shares below OVERLAP may come out as 0.
        """
        there = stretch(np.arange(max(0, n - width + 1)), width)
        place = np.searchsorted(own, there)
        place[place == len(own)] = 0
        at = np.flatnonzero(own[place] == there)
        if len(np.unique(place[at])) < OVERLAP * len(own):
            return 0.0
        most = 0
        for begin in np.unique(np.maximum(0, at // stride - np.arange(2)[:, None])) * stride:
            inside = at[(at >= begin) & (at + width <= begin + 2 * stride)]
            most = max(most, len(np.unique(place[inside])))
        return most / len(own)

    def found(self, hashes: np.ndarray) -> list[tuple]:
        """(item id, score, overlaps, first word) of the items in a document."""
        place = np.searchsorted(self.terms, hashes)
        place[place == len(self.terms)] = 0
        at = np.flatnonzero(self.terms[place] == hashes)
        if not len(at):
            return []
        stride = max(32, self.longest)
        windows = -(-len(hashes) // stride)
        best: dict[int, tuple] = {}
        apart: dict[int, tuple] = {}
        stretch = None
        for window, item, score in self.retrieved(place[at], at // stride, windows):
            stretch = stretch or Stretches(hashes)
            begin, end = window * stride, min((window + 2) * stride, len(hashes))
            shares = []
            for own, width in self.parts[item]:
                if not width:
                    shares.append(None)
                    continue
                there = stretch(np.arange(begin, max(begin, end - width + 1)), width)
                shares.append(float(np.isin(own, there).mean()))
            if shares[0] >= OVERLAP and (item not in best or shares[0] > best[item][1]):
                best[item] = (score, *shares, begin)
            if None not in shares and (item not in apart or score > apart[item][0]):
                apart[item] = (score, shares[0], begin)
        for item in apart.keys() - best.keys():
            score, whole, begin = apart[item]
            parts = [
                self.best_share(stretch, len(hashes), stride, *part) for part in self.parts[item][1:]
            ]
            if min(parts) >= OVERLAP:
                best[item] = (score, whole, *parts, begin)
        return [(self.ids[k], *v) for k, v in sorted(best.items())]


def leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and item found in it, with score and overlaps."""
    kind = docs.schema[key].dataType.simpleString()
    item_kind = items.schema[item_key].dataType.simpleString()
    item_type = to_arrow_type(items.schema[item_key].dataType)
    chosen = items.where(F.length(F.trim(item_text)) > 0).select(item_key, item_text)
    parts = -(-chosen.count() // ITEMS)
    schema = (
        f"{key} {kind}, {item_key} {item_kind}, score double, overlap double, "
        "question_overlap double, answer_overlap double, window_start long"
    )

    def rows_of(part: int) -> list[tuple]:
        own = chosen.where(F.pmod(F.xxhash64(item_key, item_text), F.lit(parts)) == part)
        rows = own.orderBy(item_key).collect()  # about ITEMS rows
        return [tuple(r) for r in rows if _hashes(r[1]).size]

    out = None
    every = Frequencies.of(map(rows_of, range(parts)))  # the vocabulary of the items
    for part in range(parts):
        rows = rows_of(part)
        if not rows:
            continue
        index = Index(rows, every)
        found = docs.select(key, text).mapInArrow(_searching(index, item_type), schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    return out


def _searching(index: Index, item_type: pa.DataType):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                w = words(part, lower=True)
                rows, found = [], []
                for k in range(part.rows):
                    for hit in index.found(w.hashes[w.first[k] : w.first[k + 1]]):
                        rows.append(part.first + k)
                        found.append(hit)
                if found:
                    item, *figures = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(rows)),
                            pa.array(item, item_type),
                            *[pa.array(f, pa.float64()) for f in figures[:4]],
                            pa.array(figures[4], pa.int64()),
                        ],
                        names=["a", "b", "c", "d", "e", "f", "g"],
                    )

    return search


def without_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents in which no item was found, with their own columns."""
    return without(docs, leaks(docs, items, key, text), key)
