"""Toxicity: a factorization machine over hashed terms.

A text's terms are its words (letters and digits, lower case) and their 4-, 5- and
6-letter beginnings, hashed to ``2 ** HASH_BITS`` slots.  The machine has a weight and ``FACTORS`` factors for
every slot that ``SEEN`` sample rows hold, whatever their labels, so a pair of terms, such as an
insult and a group's name, is learned even where either alone says nothing.  Weights and factors shrink to
exact zeros where the rows do not hold them up; only slots that are not zero are shipped.
It is fitted on at most ``MAX_ROWS`` labelled rows, taken by the least hash of the doc_id, in
``STEPS`` minibatches whatever their number; a row reaches the driver as its distinct slots, so
rows times slots bound what does.  Every whole text is scored.

Nulls and edge cases: a null or blank text has no terms and gets the machine's base score; rows whose
label is null are no training rows; a doc_id that labels repeat is used with its largest label;
without training rows of both labels every score is the share of toxic ones (0.5 without
any); repeated rows are scored one by one; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclonespark.llm.common import ship

HASH_BITS = 22
FACTORS = 6
#: sample rows that must hold a term, of either label
SEEN = 4
MAX_ROWS = 20_000
STEPS = 800
BATCH = 128
RATE = 0.05
#: what a step takes off a weight, and off the length of a slot's factors, in units of the loss
SPARSE_WEIGHT, SPARSE_FACTORS = 0.7, 0.3
MEMO = 400_000

_WORD = re.compile(r"[^\W_]+")


def hashed(word: str) -> list[int]:
    """Hashes of a lower-case word and of its beginnings."""
    parts = {f"w:{word}", *(f"p:{word[:n]}" for n in (4, 5, 6) if len(word) > n)}
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) & ((1 << HASH_BITS) - 1) for p in parts]


@dataclass
class Machine:
    """score = sigmoid(bias + sum of weights + sum over pairs of the product of factors)."""

    terms: np.ndarray  # slots, ascending
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(rows), self.bias)
        for i, at in enumerate(rows):
            if len(at):
                v = self.factors[at]
                total = v.sum(0)
                out[i] += self.weights[at].sum() + 0.5 * float(total @ total - (v * v).sum())
        return out


def held_out(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def _terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for t in batch["text"]:
            words = set(_WORD.findall((t or "").lower()))
            found.append(sorted({h for w in words for h in hashed(w)}))
        yield pd.DataFrame({"label": batch["label"], "terms": found})


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, steps: int = STEPS) -> Machine:
    """Fit on ``docs(doc_id, text)`` joined with ``labels(doc_id, label)``, at most ``max_rows`` rows."""
    ship(docs.sparkSession)
    marked = labels.filter("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # ids and labels of max_rows rows at most go to the documents, so that no text is shuffled
    train = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").mapInPandas(_terms, "label int, terms array<int>")
    rows = train.toArrow().combine_chunks()
    if not rows.num_rows:
        return _empty(0.0)
    y = (rows.column("label").to_numpy() > 0).astype(float)
    lists = rows.column("terms").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    terms, at, counts = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    if not y.any() or y.all():
        return _empty(base)
    kept = counts >= SEEN
    place = np.cumsum(kept) - 1
    owner = np.repeat(np.arange(len(y)), sizes)[kept[at]]
    at = place[at[kept[at]]]
    # rows in an order of their own, so that the fit does not depend on how the table is split
    each = np.split(at, np.cumsum(np.bincount(owner, minlength=len(y)))[:-1])
    order = sorted(range(len(y)), key=lambda i: (y[i], each[i].tobytes()))
    return _descend([each[i] for i in order], y[order], terms[kept].astype(np.int64), base, steps)


def _empty(base: float) -> Machine:
    return Machine(np.zeros(0, np.int64), base, np.zeros(0), np.zeros((0, FACTORS)))


def _descend(rows: list[np.ndarray], y: np.ndarray, terms: np.ndarray, bias: float, steps: int) -> Machine:
    """Minibatch AdaGrad on the logistic loss; after each step the touched weights, and factors as a
    group a slot, move towards zero by a fixed amount and stay there once they reach it."""
    rng = np.random.default_rng(11)
    # the rarer label weighs as much as the square root of its rarity
    heavy = np.where(y > 0, np.sqrt((y == 0).sum() / y.sum()), 1.0)
    # column 0: weights; the others: factors
    model = np.concatenate([np.zeros((len(terms), 1)), rng.normal(0, 0.02, (len(terms), FACTORS))], 1)
    seen, seen_bias = np.full(model.shape, 1e-8), 1e-8
    order = rng.permutation(len(rows))
    for step in range(steps):
        part = order[:BATCH]
        order = order[BATCH:]
        if not len(order):
            order = rng.permutation(len(rows))
        size = np.array([len(rows[i]) for i in part])
        cols, back = np.unique(np.concatenate([rows[i] for i in part]), return_inverse=True)
        owner = np.repeat(np.arange(len(part)), size)
        got = model[cols][back]
        sums, squares = np.zeros((len(part), FACTORS + 1)), np.zeros((len(part), FACTORS))
        full = size > 0
        if full.any():
            begins = (np.cumsum(size) - size)[full]
            sums[full] = np.add.reduceat(got, begins)
            squares[full] = np.add.reduceat(got[:, 1:] ** 2, begins)
        z = bias + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2 - squares).sum(1)
        miss = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * heavy[part] / len(part)
        up = miss[owner, None] * np.concatenate([np.ones((len(owner), 1)), sums[owner, 1:] - got[:, 1:]], 1)
        grad = np.stack([np.bincount(back, up[:, k], len(cols)) for k in range(FACTORS + 1)], 1)
        seen[cols] += grad * grad
        rate = RATE / np.sqrt(seen[cols])
        new = model[cols] - rate * grad
        new[:, 0] = np.sign(new[:, 0]) * np.maximum(np.abs(new[:, 0]) - rate[:, 0] * SPARSE_WEIGHT / len(part), 0)
        long = np.sqrt((new[:, 1:] ** 2).sum(1))
        less = RATE / np.sqrt(seen[cols, 1:].mean(1)) * SPARSE_FACTORS / len(part)
        new[:, 1:] *= np.maximum(1 - less / np.maximum(long, 1e-12), 0)[:, None]
        model[cols] = new
        seen_bias += miss.sum() ** 2
        bias -= RATE * miss.sum() / np.sqrt(seen_bias)
    held = (model != 0).any(1)
    return Machine(terms[held], float(bias), model[held, 0], model[held, 1:])


def score(docs: DataFrame, machine: Machine, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score and predicted of every whole text."""
    ship(docs.sparkSession)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {int(t): i for i, t in enumerate(machine.terms)}
        memo: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            rows = []
            for t in batch["text"]:
                at: set[int] = set()
                for w in set(_WORD.findall((t or "").lower())):
                    got = memo.get(w)
                    if got is None:
                        got = memo[w] = tuple(place[h] for h in hashed(w) if h in place)
                    if got:
                        at.update(got)
                rows.append(np.fromiter(sorted(at), np.int64, len(at)))
            if len(memo) > MEMO:
                memo = {}
            p = 1 / (1 + np.exp(-np.clip(machine.raw(rows), -700, 700)))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": p, "predicted": (p >= 0.5).astype("int32")})

    columns = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return columns.mapInPandas(task, "doc_id long, score double, predicted int")
