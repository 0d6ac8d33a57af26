"""The body model that problems 1, 3, 4 and 6 share, fitted on labelled pages.

Words and tags of a line have weights, and a line scores their sum. A scan
finds the contiguous regions of a page with the largest total score, each of
which costs a fixed amount. Weights and cost are fitted together, so that the
regions the scan prefers are the labelled ones.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..operators.html_walk import walk
from .lines import lines_of

#: Words and tags count from this many labelled lines on.
LEAST_LINES = 4
#: The cost of a region before it is fitted, and what it never falls below.
COST, LEAST_COST = 1.0, 0.1


@dataclass
class PageModel:
    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    cost: float = COST
    fitted: bool = False
    #: The residue model once it is fitted, None before that or without trusted records.
    residue: object = None
    residue_fitted: bool = False

    def scores(self, lines: list[tuple]) -> list[float]:
        w, t = self.words.get, self.tags.get
        bias = self.bias
        return [
            sum([w(a, 0.0) for a in words], bias) + sum([t(a, 0.0) for a in dict.fromkeys(tags)]) for _, _, words, tags in lines
        ]


def best_regions(scores: list[float], cost: float) -> list[tuple[int, int]]:
    """First and last index of the contiguous regions whose scores less `cost` a region sum up highest.

    One linear scan keeps the best total with and without an open region, and
    where each came from. Lines that score below 0 are kept inside a region
    unless leaving them out gains more than the region that begins behind them
    costs. Of equal totals the one with fewer lines counts.
    """
    outside, inside = 0.0, float("-inf")
    opened, closed = [], []
    for x in scores:
        go_on, begin = inside, outside - cost
        opened.append(begin > go_on)
        closed.append(inside > outside)
        outside, inside = max(outside, inside), max(go_on, begin) + x
    regions, at, within, last = [], len(scores) - 1, inside > outside, len(scores) - 1
    while at >= 0:
        if within:
            if opened[at]:
                regions.append((at, last))
                within = False
        elif closed[at]:
            within, last = True, at - 1
        at -= 1
    return regions[::-1]


def body_lines(lines: list[tuple], scores: list[float], cost: float) -> list[int]:
    """Numbers of the lines of the main body: those of the best regions."""
    return [lines[i][0] for first, last in best_regions(scores, cost) for i in range(first, last + 1)]


# ---------------------------------------------------------------- samples

#: What a labelled page tells the driver: its different words and tags, for each line which of them it has
#: (`cells`, `sizes` many), and whether it is labelled as content.
SAMPLE = pa.schema(
    [
        pa.field("tokens", pa.list_(pa.string())),
        pa.field("cells", pa.list_(pa.int32())),
        pa.field("sizes", pa.list_(pa.int32())),
        pa.field("truth", pa.list_(pa.bool_())),
    ]
)
_WORD = "w "  # before words, so that they differ from tags


def sample_page(html: str, url: str, ranges: list | None) -> dict[str, list | np.ndarray]:
    """The columns of SAMPLE of one page."""
    inside = [(r["start"], r["end"]) for r in ranges or [] if r["start"] is not None and r["end"] is not None]
    known: dict[str, int] = {}
    cells, sizes, truth = array("i"), [], []
    for number, _, words, tags in lines_of(walk(html or "", url or "")):
        # A tag may come twice (from the heading and the element's surroundings); it counts once.
        row = {known.setdefault(_WORD + w, len(known)) for w in words}
        row.update([known.setdefault(t, len(known)) for t in tags])
        cells.extend(sorted(row))
        sizes.append(len(row))
        truth.append(any(a <= number <= b for a, b in inside))
    return {"tokens": list(known), "cells": np.array(cells, np.int32), "sizes": sizes, "truth": truth}


def fit_body(model: PageModel, sample: pa.Table, epochs: int = 20, rate: float = 0.05) -> None:
    """Fit weights and cost to the labelled lines of a sample; without content lines the model stays empty.

    The pages are sequences of lines that lie in a region or not; the weights
    are those under which the labelled regions are likeliest.
    """
    model.fitted = True
    sample = sample.filter(pc.greater(pc.list_value_length(sample["sizes"]), 0))
    if not len(sample):
        return
    column = lambda n: sample[n].combine_chunks()
    each = lambda n: np.asarray(pc.list_value_length(column(n)), np.int64)
    coded = column("tokens").flatten().dictionary_encode()
    names: list[str] = coded.dictionary.to_pylist()
    begin = np.concatenate(([0], np.cumsum(each("tokens"))[:-1]))
    local = np.asarray(column("cells").flatten(), np.int64) + np.repeat(begin, each("cells"))
    token, sizes = np.asarray(coded.indices, np.int64)[local], np.asarray(column("sizes").flatten(), np.int64)
    truth = np.asarray(column("truth").flatten().to_numpy(zero_copy_only=False), float)
    if not truth.any():
        return
    kept = np.bincount(token, minlength=len(names)) >= LEAST_LINES
    place, inside = np.cumsum(kept) - 1, kept[token]
    starts = np.concatenate(([0], np.cumsum(inside)))[np.concatenate(([0], np.cumsum(sizes)))]
    found = _fit_chain(place[token[inside]], starts, truth, each("sizes"), int(kept.sum()), epochs, rate)
    model.bias, model.cost = float(found[-2]), max(LEAST_COST, float(found[-1]))
    for i in np.flatnonzero(kept):
        name = names[i]
        if name.startswith(_WORD):
            model.words[name[len(_WORD) :]] = float(found[place[i]])
        else:
            model.tags[name] = float(found[place[i]])


def _fit_chain(index, starts, y, lengths, n, epochs, rate, l2=2e-5, batch=96):
    """Minibatch Adam on the likelihood of the labelled regions; the last two weights are the bias and the cost."""
    w, m, v = np.zeros(n + 2), np.zeros(n + 2), np.zeros(n + 2)
    w[n + 1] = COST
    first, cells_of = np.concatenate(([0], np.cumsum(lengths))), np.diff(starts)
    random, order, step = np.random.default_rng(0), np.arange(len(lengths)), 0
    for epoch in range(epochs):
        random.shuffle(order)
        for at in range(0, len(order), batch):
            pages = order[at : at + batch]
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in pages])
            count = cells_of[rows]
            begin = np.concatenate(([0], np.cumsum(count)[:-1]))
            cells = index[np.repeat(starts[rows] - begin, count) + np.arange(count.sum())]
            row = np.repeat(np.arange(len(rows)), count)
            z = np.bincount(row, w[cells], len(rows)) + w[n]
            is_line = np.arange(lengths[pages].max()) < lengths[pages][:, None]
            scores, truth = np.zeros(is_line.shape), np.zeros(is_line.shape)
            scores[is_line], truth[is_line] = z, y[rows]
            expected, regions = _expected(scores, is_line, w[n + 1])
            before = np.concatenate((np.zeros((len(pages), 1)), truth[:, :-1]), axis=1)
            error = (expected - truth)[is_line]
            g = np.bincount(cells, error[row], n + 2) / len(rows)
            g[n], g[n + 1] = error.mean(), (((truth == 1) & (before == 0)).sum() - regions) / len(rows)
            g[:n] += l2 * w[:n]
            step += 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            w = w - rate * (1 - epoch / epochs) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def _expected(scores: np.ndarray, is_line: np.ndarray, cost: float) -> tuple[np.ndarray, float]:
    """Probability of every line to lie in a region, and the expected number of regions, over all choices of regions."""
    pages, length = scores.shape
    add = np.logaddexp
    outside, inside = np.zeros((length + 1, pages)), np.full((length + 1, pages), -1e9)
    for t in range(length):
        k, x = is_line[:, t], scores[:, t]
        inside[t + 1] = np.where(k, add(inside[t], outside[t] - cost) + x, inside[t])
        outside[t + 1] = np.where(k, add(outside[t], inside[t]), outside[t])
    whole = add(outside[length], inside[length])
    rest_out, rest_in = np.zeros(pages), np.zeros(pages)
    out, regions = np.zeros(scores.shape), 0.0
    for t in range(length - 1, -1, -1):
        k, x = is_line[:, t], scores[:, t]
        out[:, t] = np.where(k, np.exp(np.minimum(inside[t + 1] + rest_in - whole, 0)), 0)
        regions += np.where(k, np.exp(np.minimum(outside[t] - cost + x + rest_in - whole, 0)), 0).sum()
        now_in, now_out = add(x + rest_in, rest_out), add(rest_out, x - cost + rest_in)
        rest_in, rest_out = np.where(k, now_in, rest_in), np.where(k, now_out, rest_out)
    return out, float(regions)
