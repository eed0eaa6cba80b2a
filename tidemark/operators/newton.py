"""Logistic regression with L2 penalties by Newton's method, for all penalties in the same passes.

A pass sums, over the rows, the loss, its gradient and its curvature at the current coefficients of
every penalty: tasks add up their own rows with numpy, Spark adds up the tasks by cell of the
curvature, and the driver gets as many cells as the slots have pairs, however many rows there are.
Few passes are needed, since a step follows from the whole curvature and not from earlier gradients.

The loss is that of Spark's ``LogisticRegression`` without standardization: mean log loss plus
penalty / 2 times the squared coefficients, none for the intercept. Where more than one fit has the
least loss (slots that always add up to the same, no penalty), the one returned is the one that
Spark's solver tends to: least in squares of coefficient times deviation. A slot that does not vary
gets 0. Rows that repeat count each.

Rows are written in blocks once; moments, passes and the proof of a fit all read those.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.shared import written

# Tasks hold one square of this many slots for each penalty, 32 MB at most.
WIDEST = 2000
# A step that lowers the mean loss by no more than this is the last.
LEAST_GAIN = 1e-7
# After a step that lowers the loss by more than this times what the curvature foretold, the next pass
# tries longer steps beside the plain one: classes that the slots tell apart have no least loss, and
# plain steps then gain but a factor of e each.
SURPRISE = 1.15
LONGER = (1.0, 2.0, 4.0, 8.0)
# Slots that more than this share of the rows has are summed as columns, others by place.
DENSE_SHARE = 0.25
# Pairs of places that are summed at once: about what a core's own cache holds.
PAIRS = 1 << 16
# Rows of a block.
BLOCK = 16


@dataclass(frozen=True)
class Moments:
    n: int
    positives: float
    mean: np.ndarray
    deviation: np.ndarray
    present: np.ndarray


@dataclass(frozen=True)
class Blocks:
    """Rows of ``label, features`` written in blocks, and what is known of their slots."""

    frame: DataFrame
    known: Moments

    @property
    def dense(self) -> np.ndarray:
        return np.flatnonzero(self.known.present > DENSE_SHARE * self.known.n)


@dataclass
class _Basis:
    """The columns that tasks sum over: the constant, then the slots, of which those that most rows
    have are taken less their mean."""

    dense: np.ndarray
    mean: np.ndarray
    size: int

    def __post_init__(self):
        self.sparse = np.setdiff1d(np.arange(self.size), self.dense)
        self.column = np.full(self.size, -1)
        self.column[self.dense] = 1 + np.arange(len(self.dense))
        self.place = np.full(self.size, -1)
        self.place[self.sparse] = np.arange(len(self.sparse))

    def parts(self, batch: pa.RecordBatch, pairs: _Pairs | None = None) -> Iterator[tuple]:
        """Of a batch of blocks, a few rows at a time: labels, columns of the dense slots, and places
        and values of the others, one line per place. With ``pairs`` so many rows as have about
        ``PAIRS`` pairs, or as many as were met, since each part costs a sum over those."""
        for pattern, label, common, counts, indices, values in _rows(batch):
            bounds = np.append(0, np.cumsum(counts))
            widest = int(counts.max(initial=0)) + len(pattern)
            widest -= int((self.column[pattern] >= 0).sum())
            summed = widest if pairs is None else widest * (widest + 1) // 2
            last = 0
            while last < len(label):
                most = PAIRS if pairs is None else max(PAIRS, len(pairs.met))
                first, last = last, min(last + max(1, most // max(16, summed)), len(label))
                rows, part = slice(first, last), slice(bounds[first], bounds[last])
                yield label[rows], *self._part(
                    pattern, common[rows], counts[rows], indices[part], values[part]
                )

    def _part(self, pattern, common, counts, indices, values):
        n = len(counts)
        columns = np.empty((n, 1 + len(self.dense)))
        columns[:] = np.append(1.0, -self.mean[self.dense])
        at = self.column[pattern]
        columns[:, at[at >= 0]] += common[:, at >= 0]
        at, place = self.column[indices], self.place[indices]
        if held := np.count_nonzero(at >= 0):
            owner, held = np.repeat(np.arange(n), counts), at >= 0
            columns[owner[held], at[held]] += values[held]
            values, place = values[~held], place[~held]
            counts = np.bincount(owner[~held], minlength=n)
        most = int(counts.max(initial=0))
        if len(place) == most * n:
            places = np.ascontiguousarray(place.reshape(n, most).T)
            weights = np.ascontiguousarray(values.reshape(n, most).T)
        else:
            owner = np.repeat(np.arange(n), counts)
            line = np.arange(len(place)) - np.repeat(np.cumsum(counts) - counts, counts)
            places, weights = np.zeros((most, n), np.int64), np.zeros((most, n))
            places[line, owner], weights[line, owner] = place, values
        more = self.place[pattern]
        if (more >= 0).any():
            own = np.repeat(more[more >= 0], n).reshape(-1, n)
            places = np.concatenate([places, own])
            weights = np.concatenate([weights, common[:, more >= 0].T])
        return columns, places, weights


class _Pairs:
    """The pairs of places that a task has met, numbered as they come."""

    def __init__(self, n_sparse: int):
        self.n_sparse = n_sparse
        self.number = np.full(n_sparse * n_sparse, -1, np.int32)
        self.met = np.zeros(0, np.int64)

    def numbered(self, places: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one, two = np.triu_indices(len(places))
        low, high = np.minimum(places[one], places[two]), np.maximum(places[one], places[two])
        pairs = (low * self.n_sparse + high).ravel()
        numbers = self.number[pairs]
        if len(numbers) and numbers.min() < 0:
            new = np.unique(pairs[numbers < 0])
            self.number[new] = len(self.met) + np.arange(len(new))
            self.met = np.append(self.met, new)
            numbers = self.number[pairs]
        return numbers.astype(np.int64), weights[one] * weights[two]


class _Point:
    """What the rows of a task are scored with."""

    def __init__(self, basis: _Basis, constant: float, coefficients: np.ndarray):
        self.along = np.append(constant, coefficients[basis.dense])
        self.beside = coefficients[basis.sparse]

    def scores(self, columns, places, weights):
        """Margin, score, its slope, and exp(-|margin|), which never overflows."""
        margin = columns @ self.along
        if len(places):
            margin += (self.beside[places] * weights).sum(axis=0)
        small = np.exp(-np.abs(margin))
        score = np.where(margin >= 0, 1.0, small) / (1 + small)
        return margin, score, small / (1 + small) ** 2, small


class _Sums(_Point):
    """Loss, gradient and curvature of one penalty over the rows of a task."""

    def __init__(self, basis: _Basis, constant: float, coefficients: np.ndarray):
        super().__init__(basis, constant, coefficients)
        n_dense, n_sparse = len(basis.dense) + 1, len(basis.sparse)
        self.loss = 0.0
        self.slope_dense, self.slope_sparse = np.zeros(n_dense), np.zeros(n_sparse)
        self.dense = np.zeros((n_dense, n_dense))
        self.mixed = np.zeros((n_dense, n_sparse))
        self.sparse = np.zeros(0)

    def add(self, label, columns, places, weights, numbers, products, n_pairs) -> None:
        margin, score, bend, small = self.scores(columns, places, weights)
        self.loss += float((np.maximum(margin, 0) + np.log1p(small) - label * margin).sum())
        self.slope_dense += columns.T @ (score - label)
        bent = columns.T * bend
        self.dense += bent @ columns
        if not len(places):
            return
        size, flat = self.mixed.shape[1], places.ravel()
        self.slope_sparse += np.bincount(flat, ((score - label) * weights).ravel(), size)
        for line, column in enumerate(bent):
            self.mixed[line] += np.bincount(flat, (weights * column).ravel(), size)
        added = np.bincount(numbers, (products * bend).ravel(), n_pairs)
        added[: len(self.sparse)] += self.sparse
        self.sparse = added

    def cells(self, basis: _Basis, met: np.ndarray) -> np.ndarray:
        """The square of sums by column and slot, bordered by gradient and loss."""
        whole = np.zeros((basis.size + 2, basis.size + 2))
        along, beside = np.append(0, basis.dense + 1), basis.sparse + 1
        whole[np.ix_(along, along)] = self.dense
        whole[np.ix_(along, beside)] = self.mixed
        whole[np.ix_(beside, along)] = self.mixed.T
        one, two = np.divmod(met[: len(self.sparse)], max(len(beside), 1))
        whole[beside[one], beside[two]] = self.sparse
        whole[along, -1], whole[beside, -1] = self.slope_dense, self.slope_sparse
        whole[-1, -1] = self.loss
        return whole


# What a block holds of its rows, as bytes. Slots that most rows of a batch have are its pattern;
# ``common`` has their values row by row, 0 where a row lacks one. The other slots of a row are
# ``counts`` of ``indices``, whose ``values`` are left out in a block where all are 1.
_KINDS = {"label": "<f8", "pattern": "<i4", "common": "<f8", "counts": "<i4", "indices": "<i4",
          "values": "<f8"}


def _binary(numbers: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The numbers as one binary value per pair of neighbouring bounds."""
    data = pa.py_buffer(np.ascontiguousarray(numbers).tobytes())
    offsets = pa.py_buffer((bounds * numbers.itemsize).astype("<i4").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, data])


def _blocks(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in blocks, which pass from Spark to numpy as bytes and not number by number. ``unfit`` counts
    the rows that Newton's method cannot take."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            label = batch.column("label").to_numpy(zero_copy_only=False).astype("<f8")
            width = batch.column("size").fill_null(-1).to_numpy()
            unfit = ~np.isin(label, (0.0, 1.0)) | (width != size)
            counts = pc.list_value_length(batch.column("indices")).fill_null(0).to_numpy()
            indices = batch.column("indices").flatten().to_numpy().astype("<i4")
            values = batch.column("values").flatten().to_numpy().astype("<f8")
            if unfit.any():
                # The whole is refused: only the counts of these rows matter.
                label, counts = np.zeros(n, "<f8"), np.zeros(n, "<i4")
                indices, values = indices[:0], values[:0]
            owner = np.repeat(np.arange(n), counts)
            pattern = np.flatnonzero(np.bincount(indices, minlength=1) > n / 2).astype("<i4")
            column = np.full(size, -1)
            column[pattern] = np.arange(len(pattern))
            at = column[indices]
            held = at >= 0
            common = np.zeros((n, len(pattern)), "<f8")
            common[owner[held], at[held]] = values[held]
            indices, values = indices[~held], values[~held]
            counts = np.bincount(owner[~held], minlength=n).astype("<i4")
            rows = np.append(np.arange(0, n, BLOCK), n)
            entries = np.append(0, np.cumsum(counts))[rows]
            # Bounds of the values that blocks keep.
            other = np.append(0, np.cumsum(values != 1.0))[entries]
            kept = np.diff(other) > 0
            lengths = np.where(kept, np.diff(entries), 0)
            values = values[np.repeat(kept, np.diff(entries))]
            blocks_ = len(rows) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    _binary(label, rows),
                    _binary(np.tile(pattern, blocks_), len(pattern) * np.arange(blocks_ + 1)),
                    _binary(common.ravel(), rows * len(pattern)),
                    _binary(counts, rows),
                    _binary(indices, entries),
                    _binary(values, np.append(0, np.cumsum(lengths))),
                    pa.array(np.add.reduceat(unfit, rows[:-1], dtype=np.int64), pa.int64()),
                ],
                [*_KINDS, "unfit"],
            )

    return blocks


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all blocks of a column, one after the other, and how many each has."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)
    bounds = bounds[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], np.diff(bounds)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Pattern, labels, common values, counts, indices and values of the rows of each pattern."""
    patterns = batch.column("pattern").dictionary_encode()
    for number, pattern in enumerate(patterns.dictionary):
        own = batch
        if len(patterns.dictionary) > 1:
            own = batch.filter(pc.equal(patterns.indices, number))
        found = {name: _bytes(own.column(name)) for name in _KINDS}
        label, _, common, counts, indices, values = (
            found[name][0].view(kind) for name, kind in _KINDS.items()
        )
        if len(values) < len(indices):
            kept = np.repeat(found["values"][1] > 0, found["indices"][1] // indices.itemsize)
            whole = np.ones(len(indices))
            whole[kept] = values
            values = whole
        slots = np.frombuffer(pattern.as_py(), _KINDS["pattern"])
        yield slots, label, common.reshape(len(label), len(slots)), counts, indices, values


def _counted(origin: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per slot, of its distances from ``origin`` the sum and that of squares, and how often it is not
    0; in slot -1 rows and positive labels."""
    size = len(origin)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, positives, unfit = 0, 0.0, 0
        off, squares, present = np.zeros(size), np.zeros(size), np.zeros(size)
        for batch in batches:
            unfit += pc.sum(batch.column("unfit")).as_py() or 0
            for pattern, label, common, _, indices, values in _rows(batch):
                rows = len(label)
                n, positives = n + rows, positives + float(label.sum())
                # What a row lacks is 0.
                held = np.bincount(indices, minlength=size)
                held[pattern] += rows
                off -= (rows - held) * origin
                squares += (rows - held) * origin**2
                gap = values - origin[indices]
                off += np.bincount(indices, gap, size)
                squares += np.bincount(indices, gap * gap, size)
                present += np.bincount(indices, values != 0, size)
                step = max(1, PAIRS // max(16, len(pattern)))
                for first in range(0, rows, step):
                    gap = common[first : first + step] - origin[pattern]
                    off[pattern] += gap.sum(axis=0)
                    squares[pattern] += (gap * gap).sum(axis=0)
                present[pattern] += np.count_nonzero(common, axis=0)
        yield pa.RecordBatch.from_pydict(
            {
                "slot": pa.array(np.arange(-1, size), pa.int64()),
                "off": pa.array(np.append(float(n), off)),
                "squares": pa.array(np.append(positives, squares)),
                "present": pa.array(np.append(float(unfit), present)),
            }
        )

    return counted


def moments(blocks: DataFrame, origin: np.ndarray) -> Moments | None:
    """Means and deviations of the slots from their distances from ``origin``, a row's values: a slot
    varies if any row is off. None where Newton's method does not apply: no rows, one class, or
    rows that Spark's solver refuses."""
    counted = blocks.mapInArrow(_counted(origin), "slot long, off double, squares double, present double")
    sums = [F.sum(name).alias(name) for name in ("off", "squares", "present")]
    total = counted.groupBy("slot").agg(*sums).toArrow().sort_by("slot")
    if not total.num_rows:
        return None
    off, squares, present = (total.column(name).to_numpy() for name in total.column_names[1:])
    n, positives, unfit = int(off[0]), float(squares[0]), present[0]
    off, squares = off[1:], squares[1:]
    if unfit or not 0 < positives < n or not np.isfinite([off, squares]).all():
        return None
    spread = np.maximum(squares - off * off / n, np.finfo(float).eps * squares)
    return Moments(n, positives, origin + off / n, np.sqrt(spread / (n - 1)), present[1:])


@contextmanager
def in_blocks(training: DataFrame) -> Iterator[Blocks | None]:
    """The rows of ``label, features`` written in blocks for the length of a block; ``training`` is read
    once, but for its first row. None as told at :func:`moments`, and for too many slots."""
    vector = F.unwrap_udt("features")
    size = F.coalesce(vector["size"], F.size(vector["values"]))
    first = training.select(size.alias("size"), "features").first()
    if first is None or first["features"] is None or not 0 < first["size"] <= WIDEST:
        yield None
        return
    origin = first["features"].toArray()
    every = F.sequence(F.lit(0), F.size(vector["values"]) - 1)
    rows = training.select(
        F.col("label").cast("double").alias("label"),
        F.when(F.col("features").isNotNull(), size).alias("size"),
        F.coalesce(vector["indices"], every).alias("indices"),
        vector["values"].alias("values"),
    )
    schema = ", ".join([*(f"{name} binary" for name in _KINDS), "unfit long"])
    with written(rows.mapInArrow(_blocks(len(origin)), schema), "blocks") as frame:
        known = moments(frame, origin)
        yield known and Blocks(frame, known)


def _summed(
    basis: _Basis, at: Sequence[tuple[float, np.ndarray]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, pairs = [_Sums(basis, *point) for point in at], _Pairs(len(basis.sparse))
        for batch in batches:
            for label, columns, places, weights in basis.parts(batch, pairs):
                numbers, products = pairs.numbered(places, weights)
                for each in sums:
                    each.add(label, columns, places, weights, numbers, products, len(pairs.met))
        wholes = [np.triu(each.cells(basis, pairs.met)).ravel() for each in sums]
        cell = np.flatnonzero(np.any(wholes, axis=0))
        yield pa.RecordBatch.from_pydict(
            {"cell": pa.array(cell, pa.int64()),
             **{f"s{i}": pa.array(whole[cell]) for i, whole in enumerate(wholes)}}
        )

    return summed


def _pass(
    rows: DataFrame, basis: _Basis, at: Sequence[tuple[float, np.ndarray]]
) -> list[np.ndarray]:
    """The bordered square of every point, whole."""
    names = [f"s{i}" for i in range(len(at))]
    schema = ", ".join(["cell long", *(f"{name} double" for name in names)])
    partial = rows.mapInArrow(_summed(basis, at), schema)
    total = partial.groupBy("cell").agg(*[F.sum(name).alias(name) for name in names]).toArrow()
    wholes, width = [], basis.size + 2
    for name in names:
        whole = np.zeros(width * width)
        whole[total.column("cell").to_numpy()] = total.column(name).to_numpy()
        upper = whole.reshape(width, width)
        wholes.append(upper + np.triu(upper, 1).T)
    return wholes


def _sloped(
    basis: _Basis, at: Sequence[tuple[float, np.ndarray]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sloped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = [_Point(basis, *point) for point in at]
        along, beside = np.append(0, basis.dense + 1), basis.sparse + 1
        sums = np.zeros((2 + 2 * len(points), basis.size + 1))
        for batch in batches:
            for label, columns, places, weights in basis.parts(batch):
                flat = places.ravel()

                def add(line: int, factor: np.ndarray, power: int) -> None:
                    sums[line, along] += (columns**power).T @ factor
                    spread = (weights**power * factor).ravel()
                    sums[line, beside] += np.bincount(flat, spread, len(beside))

                add(0, np.ones(len(label)), 1)
                add(1, label, 1)
                for i, point in enumerate(points):
                    _, score, bend, _ = point.scores(columns, places, weights)
                    add(2 + 2 * i, score, 1)
                    add(3 + 2 * i, bend, 2)
        yield pa.RecordBatch.from_pydict(
            {"slot": pa.array(np.arange(-1, basis.size), pa.int64()),
             **{f"s{i}": pa.array(line) for i, line in enumerate(sums)}}
        )

    return sloped


def slot_sums(
    blocks: Blocks, at: Sequence[tuple[float, np.ndarray]]
) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Sums over all rows, the constant first and then every slot x: of x, of x by label, and per
    ``intercept, coefficients`` of x by score and of x squared by score x (1 - score)."""
    size = len(blocks.known.mean)
    basis = _Basis(blocks.dense, np.zeros(size), size)
    names = [f"s{i}" for i in range(2 + 2 * len(at))]
    schema = ", ".join(["slot long", *(f"{name} double" for name in names)])
    partial = blocks.frame.mapInArrow(_sloped(basis, at), schema)
    total = partial.groupBy("slot").agg(*[F.sum(name).alias(name) for name in names]).toArrow()
    total = total.sort_by("slot")
    first, second, *others = (total.column(name).to_numpy() for name in names)
    return first, second, list(zip(others[::2], others[1::2]))


@dataclass
class _Search:
    """The way to the least loss of one penalty, in coefficients times deviations."""

    penalty: np.ndarray
    # Where to begin: no coefficients first, then what may be nearer.
    begun: list[np.ndarray]
    trial: np.ndarray = field(init=False)
    best: np.ndarray | None = None
    loss: float = np.inf
    gain: float = np.inf
    step: np.ndarray = field(default_factory=lambda: np.zeros(0))
    lengths: tuple[float, ...] = (1.0,)
    steps: int = 0
    done: bool = False

    def __post_init__(self):
        self.trial = self.begun[0]

    def trials(self) -> list[np.ndarray]:
        """The points of the next pass."""
        if self.best is None:
            return self.begun
        return [self.best + length * self.step for length in self.lengths]

    def move(
        self, losses: Sequence[float], bent: Callable[[int], tuple[np.ndarray, np.ndarray]],
        most: int,
    ) -> None:
        """On from the losses at the trials; ``bent`` has slope and curvature at one of them."""
        trials = self.trials()
        losses = [loss + float(self.penalty @ at**2) / 2 for loss, at in zip(losses, trials)]
        chosen = int(np.argmin([np.inf if np.isnan(loss) else loss for loss in losses]))
        loss = losses[chosen]
        if self.best is not None and not loss <= self.loss * (1 + 1e-12):
            self.step, self.lengths = self.step / 2, (1.0,)
            # The foretold gain does not hold for a halved step.
            self.gain = np.inf
            gain = np.inf if np.abs(self.step).max() > 1e-12 else 0.0
        else:
            self.lengths = LONGER if self.loss - loss > SURPRISE * self.gain else (1.0,)
            first, self.best, self.loss = self.best is None, trials[chosen], loss
            if first and chosen and not self.penalty.any():
                # What no row's score depends on is left out, as steps from no coefficients do.
                self.best = _along(bent(0)[1], self.best)
            slope, bend = bent(chosen)
            slope = slope + self.penalty * self.best
            self.step = -_solved(bend + np.diag(self.penalty), slope, self.penalty.any())
            self.gain = gain = float(-slope @ self.step) / 2
        if self.steps == most or gain == 0:
            self.trial, self.done = self.best, True
            return
        self.trial, self.steps = self.best + self.step, self.steps + 1
        self.done = gain <= LEAST_GAIN


def _along(bend: np.ndarray, point: np.ndarray) -> np.ndarray:
    """The point without its part in directions that have no curvature."""
    values, vectors = np.linalg.eigh(bend)
    vectors = vectors[:, values > values[-1] * 1e-11]
    return vectors @ (vectors.T @ point)


def _solved(bend: np.ndarray, slope: np.ndarray, definite: bool) -> np.ndarray:
    """The least solution; where it is the only one, unequal curvatures are evened out first."""
    even = 1 / np.sqrt(np.diag(bend)) if definite else np.ones(len(bend))
    values, vectors = np.linalg.eigh(bend * np.outer(even, even))
    kept = values > values[-1] * (1e-13 if definite else 1e-11)
    vectors = vectors[:, kept]
    return even * (vectors @ ((vectors.T @ (even * slope)) / values[kept]))


def fit_points(
    blocks: Blocks,
    reg_params: Sequence[float],
    max_iterations: int,
    starts: Mapping[float, tuple[np.ndarray, float]] | None = None,
) -> Mapping[float, tuple[np.ndarray, float, int]]:
    """Coefficients, intercept and number of steps by penalty.

    ``blocks`` are read once per step. A step that does not lower the loss is halved; of several
    lengths tried in one pass the one of least loss is taken, and it counts as one step. ``starts``
    has coefficients and intercept that may lie near the least loss; they are begun from where
    their loss is less than that of no coefficients.
    """
    known = blocks.known
    n, size = known.n, len(known.mean)
    basis = _Basis(blocks.dense, known.mean, size)
    # From sums over the basis to slots less their mean and over their deviation.
    varying = np.flatnonzero(known.deviation > 0)
    deviation = known.deviation[varying]
    shift = np.where(basis.place >= 0, known.mean, 0.0)[varying]
    to_even = np.zeros((len(varying) + 1, size + 1))
    to_even[0, 0] = 1
    to_even[np.arange(len(varying)) + 1, varying + 1] = 1 / deviation
    to_even[1:, 0] = -shift / deviation
    plain = np.zeros(len(varying) + 1)
    plain[0] = np.log(known.positives / (n - known.positives))
    searches = {}
    for reg in reg_params:
        begun = [plain]
        if starts and reg in starts:
            coefficients, intercept = starts[reg]
            constant = intercept + float(coefficients @ known.mean)
            begun.append(np.append(constant, coefficients[varying] * deviation))
        searches[reg] = _Search(np.append(0.0, float(reg) / deviation**2), begun)
    while open_ := [search for search in searches.values() if not search.done]:
        points = [at @ to_even for search in open_ for at in search.trials()]
        wholes = iter(_pass(blocks.frame, basis, [(point[0], point[1:]) for point in points]))
        for search in open_:
            sums = [next(wholes) / n for _ in search.trials()]

            def bent(i: int, sums: list[np.ndarray] = sums) -> tuple[np.ndarray, np.ndarray]:
                slope, bend = sums[i][:-1, -1], sums[i][:-1, :-1]
                return to_even @ slope, to_even @ bend @ to_even.T

            search.move([whole[-1, -1] for whole in sums], bent, max_iterations)
    found = {}
    for reg, search in searches.items():
        coefficients = np.zeros(size)
        coefficients[varying] = search.trial[1:] / deviation
        intercept = float(search.trial[0] - coefficients @ known.mean)
        found[reg] = coefficients, intercept, search.steps
    return found
