"""A naive Bayes model of pages that hold an error, placeholders or filler, learned from positive and unlabelled records.

Every record (a scrape with html) is passages: the lines near or in the place
of the main body, and notices for browsers without scripts. Trusted records
are positives, all others unlabelled; expectation-maximization over all of
them finds the weights of words and of the amount of body. Words are counted in
a fixed number of slots by their hash, so that what reaches the driver is
bounded however many records and words there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from math import exp

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots that words are counted in.
SLOTS = 1 << 18
#: Lines that score lower are no passages.
NEAR_BODY = -3.0
#: Edges of the amounts of body: expected letters of lines of the body that are no headings.
EDGES = np.array([1, 3, 10, 30, 60, 120, 250, 500, 1000], float)
#: Trusted records hold less body than this, and so do the unlabelled ones that begin as doubtful.
LITTLE, DOUBTFUL = 120.0, 0.3
#: What one passage can add to or take from a record's log odds; rounds of expectation-maximization; beliefs below FLOOR are none.
CLIP, ROUNDS, FLOOR = 6.0, 6, 1e-6
#: Words that a Python worker remembers the slots of; the memory is emptied between pages when full.
MEMORY = 200_000

# Marks of templates that were not filled.
_PLACEHOLDER = re.compile(
    r"\{\{[^|{}]*\}\}|<\?=.*?\?>|<%=?.*?%>|\$\{[^}]*\}|\{\$[^}]*\}|@@\w[\w.]*@@|%%[A-Z_]+%%|\[\[\w+\.\w+\]\]|\b__\w+__\b"
)
_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]")
_NOTICE, _MARKUP = re.compile(r"<noscript\b[^>]*>(.*?)(?:</noscript\s*>|\Z)", re.I | re.S), re.compile(r"<[^>]*>")

EVIDENCE = pa.schema(
    [
        pa.field("cells", pa.binary()),
        pa.field("sizes", pa.binary()),
        pa.field("weights", pa.binary()),
        pa.field("amount", pa.float64()),
        pa.field("trusted", pa.bool_()),
    ]
)
EVIDENCE_DDL = "cells binary, sizes binary, weights binary, amount double, trusted boolean"


def noscript_texts(html: str) -> list[str]:
    """Texts that a page shows only where scripts are off."""
    if "<noscript" not in html and "<noscript" not in html.lower():
        return []
    found = [" ".join(unescape(_MARKUP.sub(" ", x)).split()) for x in _NOTICE.findall(html)]
    return [x for x in found if x]


class _Slots(dict):
    def __missing__(self, word: str) -> int:
        found = self[word] = xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass")) % SLOTS
        return found


_slots = _Slots()


def _has_placeholder(text: str) -> bool:
    likely = "{" in text or "<" in text or "%" in text or "@@" in text or "[[" in text or "__" in text
    return likely and _PLACEHOLDER.search(text) is not None


def _share(score: float) -> float:
    return 1 / (1 + exp(-score)) if score > -30 else 0.0


def evidence_of(html: str | None, status: str | None, lines: list[tuple], scores: list[float]) -> tuple:
    """The columns of EVIDENCE of one record; the amount is null for one without any text.

    Words of headings and of notices count apart from those of other passages.
    A passage may speak against residue as far as it is likely to be body; a
    heading may not, since a title alone is no body.
    """
    if len(_slots) > MEMORY:
        _slots.clear()
    cells: list[int] = []
    sizes, weights, amount, marked = [], [], 0.0, False
    for (_, item, words, _), score in zip(lines, scores):
        head = item[3][:1] == "#"
        if not head:
            amount += _share(score) * len(item[2])
        if score <= NEAR_BODY:
            continue
        cells += map(_slots.__getitem__, ["#" + w for w in words] if head else words)
        sizes.append(len(words))
        weights.append(0.0 if head else _share(score))
        marked = marked or _has_placeholder(item[2])
    notices = noscript_texts(html) if html else []
    for text in notices:
        own = {"!" + ("0" if w.isdigit() else w) for w in _WORD.findall(text.lower())}
        cells += map(_slots.__getitem__, sorted(own))
        sizes.append(len(own))
        weights.append(0.0)
    trusted = amount < LITTLE and (marked or status == "failed") and bool(lines or notices)
    packed = (np.array(x, t).tobytes() for x, t in ((cells, "<u4"), (sizes, "<u4"), (weights, "<f4")))
    return (*packed, amount if lines or notices else None, trusted)


@dataclass
class ResidueModel:
    odds: np.ndarray  # of a passage with a word in the slot
    amounts: np.ndarray
    prior: float


class _Records:
    """The records of a batch as arrays."""

    def __init__(self, batch: pa.RecordBatch):
        joined = lambda name, kind: np.frombuffer(b"".join(x or b"" for x in batch.column(name).to_pylist()), kind)
        amount = batch.column("amount")
        self.known = ~np.asarray(amount.is_null().to_numpy(zero_copy_only=False), bool)
        self.amounts = np.searchsorted(EDGES, np.asarray(amount.fill_null(0.0), float))
        self.little = np.asarray(amount.fill_null(9e9), float) < LITTLE
        self.trusted = np.asarray(batch.column("trusted").fill_null(False).to_numpy(zero_copy_only=False), bool)
        self.cells, sizes, self.weights = joined("cells", "<u4").astype(np.int64), joined("sizes", "<u4").astype(np.int64), joined("weights", "<f4")
        self.passage = np.repeat(np.arange(len(sizes)), sizes)
        self.record = np.repeat(np.arange(batch.num_rows), [len(x or b"") // 4 for x in batch.column("sizes").to_pylist()])

    def log_odds(self, model: ResidueModel) -> np.ndarray:
        each = np.clip(np.bincount(self.passage, model.odds[self.cells], len(self.record)), -CLIP, CLIP)
        each = np.where(each < 0, each * self.weights, each)
        return np.bincount(self.record, each, len(self.known)) + model.amounts[self.amounts] + model.prior

    def beliefs(self, model: ResidueModel | None) -> np.ndarray:
        if model is None:
            out = np.where(self.trusted, 1.0, np.where(self.little, DOUBTFUL, 0.0))
        else:
            out = 1 / (1 + np.exp(-np.clip(self.log_odds(model), -30, 30)))
        return np.where(self.known & (out >= FLOOR), out, 0.0)


_N = len(EDGES) + 1
_END = SLOTS + _N + 2  # slots, amounts, passages, records


def _summed(records: DataFrame, weigh) -> np.ndarray:
    """Sums over all records, each weighed by `weigh(batch records)`; per partition first, then over all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_END)
        for batch in batches:
            r = _Records(batch)
            w = weigh(r)
            each = w[r.record]
            total[:SLOTS] += np.bincount(r.cells, each[r.passage], SLOTS)
            total[SLOTS : SLOTS + _N] += np.bincount(r.amounts, w, _N)
            total[-2:] += each.sum(), w.sum()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.float64())], names=["slot", "n"])

    got = records.select(*EVIDENCE.names).mapInArrow(run, "slot bigint, n double").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(_END)
    out[np.asarray(got["slot"], np.int64)] = np.asarray(got["n"], float)
    return out


def fit_residue(records: DataFrame, rounds: int = ROUNDS) -> ResidueModel | None:
    """The model of all records of a table that has the columns of EVIDENCE; None without trusted or without other records.

    The table is read once for the counts of all records and once a round, so
    it should be kept. At most SLOTS sums reach the driver each time.
    """
    context = records.sparkSession.sparkContext
    whole = _summed(records, lambda r: r.known.astype(float))
    sure = records.where("trusted").limit(1).count()
    if not sure or not whole[-1]:
        return None
    model = None
    for _ in range(rounds):
        shared = context.broadcast(model)
        yes = _summed(records, lambda r: r.beliefs(shared.value))
        no = np.maximum(whole - yes, 0.0)
        if yes[-1] <= 0 or no[-1] <= 0:
            return None
        ratio = lambda a, b, by: np.log(a + by) - np.log(b + by)
        odds = ratio(yes[:SLOTS], no[:SLOTS], 0.1) - ratio(yes[-2], no[-2], 1.0)
        have, miss = (x[SLOTS : SLOTS + _N] + 0.1 for x in (yes, no))
        amounts = np.log(have / have.sum()) - np.log(miss / miss.sum())
        model = ResidueModel(odds.astype(np.float32), amounts, float(ratio(yes[-1], no[-1], 0.0)))
    return model


def with_residue(records: DataFrame, model: ResidueModel | None) -> DataFrame:
    """`records` with the column residue in place of the evidence: whether the log odds of a record are above 0."""
    kept = [f for f in records.schema.fields if f.name not in EVIDENCE.names]
    if model is None:
        return records.select(*[f.name for f in kept], F.lit(False).alias("residue"))
    shared = records.sparkSession.sparkContext.broadcast(model)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", residue boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = _Records(batch)
            flags = r.known & (r.log_odds(shared.value) > 0)
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(flags)], names=[*[f.name for f in kept], "residue"])

    return records.mapInArrow(run, ddl)
