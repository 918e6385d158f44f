"""Linear algebra over rows of sparse vectors: passes that give sums over all rows, whatever the number of features.

The rows are written once as blocks in compressed form. A pass sends one matrix (features times right-hand sides) to the tasks, each
task adds up its own sums, and these are added by ranges of features, so no task adds up whole matrices of many others. The
matrix is bounded: callers take the right-hand sides in groups of at most ``group_size`` columns.

Rows can count as standardised without being made dense: ``Moments`` hold the mean and the deviation of each feature, and a
pass works with (X - 1 m') D instead of X.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import batch_bytes, materialise

SENT_BYTES = 64 << 20  # the matrix that one pass sends
BLOCK_NUMBERS = 100_000  # stored numbers of one block of rows
BATCH_BYTES = 8 << 20  # of the blocks that travel to Python together
STORED_BLOCKS = 8  # blocks of a row group, which a reader holds whole, several times in arrays that it doubles
WORK_NUMBERS = 2_000_000  # products that a task holds at once
RANGE = 512  # features whose sums travel together
GRAM_FEATURES = 4096  # up to here a hinge fit is preconditioned with the products of all features
DENSE_SHARE = 32  # a block with one stored number in so many is made dense for products

_BLOCK = "rows long, first binary, feature binary, value binary, label_row binary, label binary"


def width_of(df: DataFrame, col: str) -> int:
    first = df.select(F.col(col)).first()
    return 0 if first is None else first[0].size


def group_size(width: int) -> int:
    """How many right-hand sides one pass takes."""
    return max(1, SENT_BYTES // (8 * max(width, 1)))


@dataclass
class Block:
    """Rows ``value[first[i] : first[i + 1]]`` at the features of the same places; ``label_row``, ``label``: which rows have which labels."""

    first: np.ndarray
    feature: np.ndarray
    value: np.ndarray
    label_row: np.ndarray
    label: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.first) - 1

    def times(self, w: np.ndarray) -> np.ndarray:
        """X w."""
        out = np.zeros((self.rows, w.shape[1]))
        full = np.flatnonzero(np.diff(self.first))
        if not len(full):
            return out
        step = max(1, WORK_NUMBERS // len(self.value))
        for a in range(0, w.shape[1], step):
            products = w[self.feature, a : a + step] * self.value[:, None]
            out[full, a : a + step] = np.add.reduceat(products, self.first[full], axis=0)
        return out

    def add_transposed(self, r: np.ndarray, out: np.ndarray) -> None:
        """``out`` += X' r."""
        if not len(self.value):
            return
        order = np.argsort(self.feature, kind="stable")
        row = np.repeat(np.arange(self.rows), np.diff(self.first))[order]
        feature, value = self.feature[order], self.value[order]
        heads = np.flatnonzero(np.r_[True, feature[1:] != feature[:-1]])
        step = max(1, WORK_NUMBERS // len(value))
        for a in range(0, r.shape[1], step):
            out[feature[heads], a : a + step] += np.add.reduceat(r[row, a : a + step] * value[:, None], heads, axis=0)

    def dense_parts(self, width: int) -> Iterator[tuple[slice, np.ndarray]]:
        """A few rows at a time, and these as a matrix."""
        step = max(1, WORK_NUMBERS // max(width, 1))
        row = np.repeat(np.arange(self.rows), np.diff(self.first))
        for a in range(0, self.rows, step):
            b = min(a + step, self.rows)
            mine, x = slice(self.first[a], self.first[b]), np.zeros((b - a, width))
            x[row[mine] - a, self.feature[mine]] = self.value[mine]
            yield slice(a, b), x

    def is_full(self, width: int) -> bool:
        """Whether products with dense rows are cheaper than with the stored numbers."""
        return len(self.value) * DENSE_SHARE >= self.rows * width

    def signs(self, low: int, high: int) -> np.ndarray:
        """+1 where a row has a label, else -1, for the labels from ``low`` to below ``high``."""
        y = np.full((self.rows, high - low), -1.0)
        mine = (self.label >= low) & (self.label < high)
        y[self.label_row[mine], self.label[mine] - low] = 1.0
        return y


def sparse_rows(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first, feature, value`` of a column of dense or sparse vectors; a null vector has no numbers."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    _, _, indices, values = vectors.flatten()
    sizes, listed = (np.asarray(pc.fill_null(pc.list_value_length(x), 0)).astype(np.int64) for x in (values, indices))
    first = np.r_[0, np.cumsum(sizes)]
    feature = np.arange(first[-1]) - np.repeat(first[:-1], sizes)  # right for dense vectors, which list no features
    feature[np.repeat(listed > 0, sizes)] = np.asarray(indices.flatten())
    return first, feature, np.asarray(values.flatten(), dtype=float)


def row_blocks(
    df: DataFrame, features: str, tags: str | None = None, classes: Sequence[str] = (), numbers: int = BLOCK_NUMBERS
) -> DataFrame:
    """The rows of ``df`` as a written table of blocks of about ``numbers`` stored numbers. Places of the tags among ``classes`` are found before Python."""
    if tags is None:
        labels = F.array().cast("array<int>")
    else:
        known = F.array(*[F.lit(c) for c in classes]).cast("array<string>")
        labels = F.transform(F.array_intersect(F.coalesce(tags, F.array().cast("array<string>")), known), lambda t: F.array_position(known, t).cast("int") - 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, feature, value = sparse_rows(batch["x"])
            lists = batch["labels"]
            ends = np.r_[0, np.cumsum(np.asarray(pc.list_value_length(lists)))].astype(np.int64)
            label = np.asarray(lists.flatten()).astype(np.int64)
            a, n = 0, batch.num_rows
            while a < n:
                b = max(a + 1, int(np.searchsorted(first, first[a] + numbers, side="right")) - 1)
                b = min(b, a + 4096, n)
                mine = slice(ends[a], ends[b])
                row = np.repeat(np.arange(b - a), np.diff(ends[a : b + 1]))
                parts = [first[a : b + 1] - first[a], feature[first[a] : first[b]], value[first[a] : first[b]], row, label[mine]]
                parts = [p if k == 2 else p.astype(np.int32) for k, p in enumerate(parts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b - a], pa.int64()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                    [c.split()[0] for c in _BLOCK.split(", ")],
                )
                a = b

    rows = df.select(F.col(features).alias("x"), labels.alias("labels"))
    with batch_bytes(df.sparkSession, BATCH_BYTES):
        return materialise(rows.mapInArrow(cut, _BLOCK), **{"parquet.block.row.count.limit": STORED_BLOCKS})


def _blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    columns = [batch[c] for c in ("first", "feature", "value", "label_row", "label")]
    for row in zip(*columns, strict=True):
        numbers = [np.frombuffer(row[k].as_py(), np.float64 if k == 2 else np.int32) for k in range(5)]
        yield Block(*[x if k == 2 else x.astype(np.int64) for k, x in enumerate(numbers)])


def summed(blocks: DataFrame, shape: tuple[int, int], more: tuple[int, int], one: Callable, sent) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all blocks of what ``one(block, sent value, matrix, rest)`` adds to a matrix of ``shape`` and to a few numbers of
    shape ``more``. Both come to the driver, bounded by their shapes."""
    shared = blocks.sparkSession.sparkContext.broadcast(sent)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rest, met = None, np.zeros(more), False
        for batch in batches:
            for block in _blocks(batch):
                if total is None:
                    total = np.zeros(shape)
                one(block, shared.value, total, rest)
                met = True
        if not met:
            return
        yield _sums([-1], [rest])
        for a in range(0, shape[0], RANGE):
            if total[a : a + RANGE].any():
                yield _sums([a], [total[a : a + RANGE]])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _added(batches)
        if made:
            yield _sums(list(made), list(made.values()))

    kind = "key long, numbers binary"
    tasks = 4 * blocks.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(tasks, -(-shape[0] // (8 * RANGE))))
    partials = blocks.coalesce(tasks).mapInArrow(partial, kind)
    with batch_bytes(blocks.sparkSession, BATCH_BYTES):
        if tasks * shape[0] * shape[1] * 8 <= SENT_BYTES:  # few enough numbers to be added up here: a stage less for each pass
            rows = _added(partials.toArrow().to_batches())
        else:
            found = partials.repartition(parts, "key").mapInArrow(add, kind)
            rows = {r.key: np.frombuffer(r.numbers) for r in found.collect()}
    shared.destroy()  # the driver's copy too: a fit makes hundreds of passes
    out, rest = np.zeros(shape), np.zeros(more)
    for key, numbers in rows.items():
        if key < 0:
            rest = numbers.reshape(more)
        else:
            part = numbers.reshape(-1, shape[1])
            out[key : key + len(part)] = part
    return out, rest


def _added(batches: Iterable[pa.RecordBatch]) -> dict[int, np.ndarray]:
    """The sums of the numbers of each key."""
    made: dict[int, np.ndarray] = {}
    for batch in batches:
        for key, numbers in zip(batch["key"].to_pylist(), batch["numbers"].to_pylist(), strict=True):
            found = np.frombuffer(numbers)
            made[key] = made[key] + found if key in made else found
    return made


def _sums(keys: list[int], arrays: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([a.tobytes() for a in arrays], pa.binary())], ["key", "numbers"])


@dataclass
class Moments:
    """``rows``, and the mean and population deviation of each feature (1 where it does not vary)."""

    rows: int
    mean: np.ndarray
    deviation: np.ndarray

    def weights(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights and constants for raw rows that score as ``w`` does for standardised ones."""
        scaled = w / self.deviation[:, None]
        return scaled, -self.mean @ scaled


def moments(blocks: DataFrame, width: int, scale: bool = True) -> Moments:
    """Of all features, in one pass. Without ``scale`` means of 0 and deviations of 1."""

    def one(block: Block, _, out: np.ndarray, rest: np.ndarray) -> None:
        ones = np.ones((block.rows, 1))
        if scale:
            block.add_transposed(ones, out[:, :1])
            Block(block.first, block.feature, block.value**2, block.label_row, block.label).add_transposed(ones, out[:, 1:])
        rest[0, 0] += block.rows

    sums, rest = summed(blocks, (width, 2) if scale else (0, 2), (1, 1), one, None)
    n = int(rest[0, 0])
    if not scale or not n:
        return Moments(n, np.zeros(width), np.ones(width))
    mean = sums[:, 0] / n
    deviation = np.sqrt(np.maximum(sums[:, 1] / n - mean**2, 0))
    deviation[deviation <= 1e-12 * np.maximum(1, np.abs(mean))] = 1.0
    return Moments(n, mean, deviation)


def gram_times(blocks: DataFrame, v: np.ndarray, stats: Moments) -> np.ndarray:
    """Z'Z v for the standardised rows Z."""
    scaled, constant = stats.weights(v)

    def one(block: Block, sent, out: np.ndarray, rest: np.ndarray) -> None:
        r = block.times(sent[0]) + sent[1]
        block.add_transposed(r, out)
        rest += r.sum(axis=0)

    total, sums = summed(blocks, v.shape, (1, v.shape[1]), one, (scaled, constant))
    return (total - stats.mean[:, None] * sums) / stats.deviation[:, None]


def label_sums(blocks: DataFrame, width: int, classes: Sequence[int], stats: Moments) -> np.ndarray:
    """Z'Y for the standardised rows Z and labels of +1 and -1."""
    low, high = classes[0], classes[-1] + 1

    def one(block: Block, _, out: np.ndarray, rest: np.ndarray) -> None:
        y = block.signs(low, high)
        block.add_transposed(y, out)
        rest += y.sum(axis=0)

    total, sums = summed(blocks, (width, high - low), (1, high - low), one, None)
    return (total - stats.mean[:, None] * sums) / stats.deviation[:, None]


# --- squared error: conjugate gradients ----------------------------------------------------


def conjugate_gradients(right: np.ndarray, image_of: Callable[[np.ndarray], np.ndarray], tolerance: float, most: int) -> np.ndarray:
    """Solves for all columns of ``right`` at once; each call of ``image_of`` is one product with the matrix."""
    w, residual = np.zeros_like(right), right.copy()
    step, size = residual.copy(), (residual**2).sum(axis=0)
    goal = tolerance**2 * np.maximum(size, 1e-300)
    for _ in range(most):
        if (size <= goal).all():
            break
        image = image_of(step)
        curve = (step * image).sum(axis=0)
        length = np.where(curve > 0, size / np.where(curve > 0, curve, 1), 0)
        w += length * step
        residual -= length * image
        new = (residual**2).sum(axis=0)
        step = residual + np.where(size > 0, new / np.where(size > 0, size, 1), 0) * step
        size = new
    return w


def solve_squared_error(
    blocks: DataFrame, width: int, classes: int, stats: Moments, penalty: float, tolerance: float = 1e-9, most: int = 1000
) -> np.ndarray:
    """Weights (features times classes) of least squares with ``penalty``, for all classes of a group at once, without a matrix of
    features by features. Each pass is one product with Z'Z; a class is done when its residual is ``tolerance`` of its right-hand side."""
    out, group = np.zeros((width, classes)), max(1, group_size(width) // 2)
    for low in range(0, classes, group):
        mine = range(low, min(low + group, classes))
        right = label_sums(blocks, width, mine, stats) / stats.rows
        out[:, low : mine[-1] + 1] = conjugate_gradients(
            right, lambda v: gram_times(blocks, v, stats) / stats.rows + penalty * v, tolerance, most)
    return out


# --- hinge: smoothed, preconditioned limited-memory quasi-Newton, with a duality gap --------


def feature_products(blocks: DataFrame, width: int, stats: Moments) -> np.ndarray:
    """Z'Z divided by the rows, for the standardised rows Z."""

    def one(block: Block, _, out: np.ndarray, rest: np.ndarray) -> None:
        for _, x in block.dense_parts(width):
            out += x.T @ x

    total, _ = summed(blocks, (width, width), (1, 1), one, None)
    return (total / stats.rows - np.outer(stats.mean, stats.mean)) / np.outer(stats.deviation, stats.deviation)


def _inverted(spark: SparkSession, a: np.ndarray) -> np.ndarray:
    """The inverse of a symmetric matrix, made in a task: there the matrix routines use one thread, while their threads were seen to
    hang in a process that started a session."""
    sent = spark.sparkContext.broadcast(a)

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _ in range(batch.num_rows):
                inverse = np.linalg.inv(sent.value)
                for low in range(0, len(inverse), RANGE):
                    yield _sums([low], [inverse[low : low + RANGE]])

    rows = spark.range(0, 1, 1, 1).mapInArrow(invert, "key long, numbers binary").collect()
    sent.destroy()
    inverse = np.concatenate([np.frombuffer(r.numbers).reshape(-1, len(a)) for r in sorted(rows, key=lambda r: r.key)])
    return (inverse + inverse.T) / 2


def _preconditioner(blocks: DataFrame, width: int, stats: Moments, penalty: float) -> Callable[[np.ndarray], np.ndarray]:
    """What takes a gradient to about the step of a least-squares fit: it undoes the different sizes and the correlation of the
    features, which cost a quasi-Newton method most of its passes. Beyond ``GRAM_FEATURES`` features only their sizes."""
    if width <= GRAM_FEATURES:
        inverse = _inverted(blocks.sparkSession, feature_products(blocks, width, stats) + penalty * np.eye(width))
        return lambda v: np.einsum("ij,jk->ik", inverse, v)

    def one(block: Block, _, out: np.ndarray, rest: np.ndarray) -> None:
        Block(block.first, block.feature, block.value**2, block.label_row, block.label).add_transposed(np.ones((block.rows, 1)), out)

    squares, _ = summed(blocks, (width, 1), (1, 1), one, None)
    sizes = (squares[:, 0] / stats.rows - stats.mean**2) / stats.deviation**2
    scale = 1 / (np.maximum(sizes, 0) + penalty)[:, None]
    return lambda v: scale * v


def _hinge_pass(blocks: DataFrame, w: np.ndarray, smooth: np.ndarray, low: int, mine: np.ndarray, stats: Moments):
    """``(gradient part, smoothed loss, hinge loss, mean of the dual variables)`` for the classes ``low + mine``.

    The dual variables are the slopes of the smoothed loss, so the gradient part is also the dual's vector.
    """
    scaled, constant = stats.weights(w)
    width, high = len(w), low + int(mine[-1]) + 1

    def slopes(y: np.ndarray, scores: np.ndarray, rest: np.ndarray) -> np.ndarray:
        gap = 1 - y * scores
        dual = np.clip(gap / smooth, 0, 1)
        r = dual * y
        rest[0] += r.sum(axis=0)
        rest[1] += (dual * gap - smooth / 2 * dual**2).sum(axis=0)
        rest[2] += np.maximum(gap, 0).sum(axis=0)
        rest[3] += dual.sum(axis=0)
        return r

    def one(block: Block, sent, out: np.ndarray, rest: np.ndarray) -> None:
        y = block.signs(low, high)[:, mine]
        if block.is_full(width):
            for part, x in block.dense_parts(width):
                out += x.T @ slopes(y[part], x @ sent[0] + sent[1], rest)
        else:
            block.add_transposed(slopes(y, block.times(sent[0]) + sent[1], rest), out)

    total, sums = summed(blocks, w.shape, (4, w.shape[1]), one, (scaled, constant))
    vector = (total - stats.mean[:, None] * sums[:1]) / stats.deviation[:, None] / stats.rows
    return vector, *(sums[1:] / stats.rows)


def solve_hinge(
    blocks: DataFrame, width: int, classes: int, stats: Moments, penalty: float, tolerance: float = 1e-3, most: int = 5000, memory: int = 20
) -> tuple[np.ndarray, np.ndarray, int]:
    """Weights for the mean hinge loss plus ``penalty`` / 2 times their squares, all classes of a group at once; the duality gap of
    each class; and the passes made. Stops at a gap of ``tolerance`` (the loss without weights is 1) or after ``most`` passes.

    The loss is smoothed within ``smooth`` of its kink, which shrinks as a class comes near its smoothed optimum; the gap is
    that of the hinge loss itself. Each pass tries one step of every class: a class whose step does not lower its value enough halves
    it for the next pass, and a class that is done takes no further part in the passes.
    """
    out, gaps, passes = np.zeros((width, classes)), np.zeros(classes), 0
    precondition = _preconditioner(blocks, width, stats, penalty)
    group = max(1, group_size(width) // 2)
    for low in range(0, classes, group):
        n = min(group, classes - low)
        w = trial = np.zeros((width, n))
        best, best_primal, best_dual = w, np.full(n, np.inf), np.full(n, -np.inf)
        smooth, value, gradient = np.full(n, 0.5), np.full(n, np.inf), np.zeros((width, n))
        length, slope, direction = np.zeros(n), np.zeros(n), np.zeros((width, n))
        pairs: list[list[np.ndarray]] = []
        vector, loss, hinge, dual = np.zeros((width, n)), np.zeros(n), np.zeros(n), np.zeros(n)
        done = np.zeros(n, dtype=bool)
        while True:
            mine = np.flatnonzero(~done)
            vector[:, mine], loss[mine], hinge[mine], dual[mine] = _hinge_pass(blocks, trial[:, mine], smooth[mine], low, mine, stats)
            passes += 1
            squares = penalty / 2 * (trial**2).sum(axis=0)
            best_dual = np.maximum(best_dual, dual - (vector**2).sum(axis=0) / (2 * penalty))
            better = ~done & (hinge + squares < best_primal)
            best, best_primal = np.where(better, trial, best), np.where(better, hinge + squares, best_primal)
            done |= best_primal - best_dual <= tolerance
            if done.all() or passes >= most:
                break
            fresh = np.isinf(value)  # evaluated anew where it is, after its smoothing changed
            taken = fresh | (loss + squares <= value + 1e-4 * length * slope)
            new = penalty * trial - vector
            delta, change = np.where(taken & ~fresh, trial - w, 0), np.where(taken & ~fresh, new - gradient, 0)
            inner = (delta * change).sum(axis=0)
            scale = np.where(inner > 1e-14, 1 / np.where(inner > 1e-14, inner, 1), 0)
            if scale.any():
                pairs = [*pairs, [delta, change, scale, (change * precondition(change)).sum(axis=0)]][-memory:]
            w, gradient = np.where(taken, trial, w), np.where(taken, new, gradient)
            value = np.where(taken, loss + squares, value)
            # Near the smoothed optimum what is left of the gap comes from the smoothing; so it does where no step helps.
            size = (gradient**2).sum(axis=0)
            sharper = taken & (size / (2 * penalty) <= np.maximum(best_primal - best_dual, tolerance) / 4)
            sharper |= ~taken & (length < 1e-8)
            sharper &= ~done & (smooth > 1e-6)
            smooth = np.where(sharper, smooth / 4, smooth)
            for pair in pairs:
                pair[2] = np.where(sharper, 0, pair[2])
            value = np.where(sharper, np.inf, value)
            following = -_two_loops(gradient, pairs, precondition)
            downhill = (following * gradient).sum(axis=0)
            following = np.where(downhill < 0, following, -precondition(gradient))
            known = np.any([pair[2] > 0 for pair in pairs], axis=0) if pairs else np.zeros(n, dtype=bool)
            direction = np.where(taken, following, direction)
            slope = np.where(taken, (direction * gradient).sum(axis=0), slope)
            length = np.where(taken, np.where(known, 1.0, smooth), length / 2)
            length = np.where(done | sharper, 0, length)
            trial = w + length * direction
        out[:, low : low + n], gaps[low : low + n] = best, best_primal - best_dual
    return out, gaps, passes


def _two_loops(gradient: np.ndarray, pairs: list[list[np.ndarray]], precondition: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The quasi-Newton direction of each column from its last steps, gradient changes and the sizes of these; a pair of scale 0
    tells a column nothing."""
    q, kept, size = gradient.copy(), [], np.ones(gradient.shape[1])
    for delta, change, scale, _ in reversed(pairs):
        a = scale * (delta * q).sum(axis=0)
        q -= a * change
        kept.append(a)
    for _, _, scale, square in pairs:  # the last that tells
        size = np.where(scale > 0, 1 / np.maximum(scale * square, 1e-300), size)
    q = precondition(q) * size
    for (delta, change, scale, _), a in zip(pairs, reversed(kept), strict=True):
        q += (a - scale * (change * q).sum(axis=0)) * delta
    return q


# --- principal components: randomised range finder -----------------------------------------


def principal_components(
    blocks: DataFrame, width: int, stats: Moments, most: int, level: float | None = None, seed: int = 42, tolerance: float = 1e-8, rounds: int = 60
) -> tuple[np.ndarray, np.ndarray]:
    """The leading components of the standardised rows as orthonormal columns, and their shares of the whole variance, falling.

    A random start is driven into the leading subspace by products with Z'Z, which never is a matrix, and made orthonormal after each
    (subspace iteration with a few columns to spare, the product's small projection solved exactly). At most ``most`` components;
    with ``level`` the subspace doubles until the shares reach it. Shares are taken when they change by less than ``tolerance``.
    """
    whole = _total_variance(blocks, width, stats)
    rank = min(width, max(stats.rows - 1, 0), most)
    if rank == 0 or whole <= 0:
        return np.zeros((width, 0)), np.zeros(0)
    rng = np.random.default_rng(seed)
    want = rank if level is None else min(rank, 32)
    basis = np.zeros((width, 0))
    while True:
        spare = min(width, want + max(8, want // 4))
        basis = np.c_[basis, rng.standard_normal((width, spare - basis.shape[1]))]
        basis = np.linalg.qr(basis)[0]
        last = np.zeros(spare)
        for _ in range(rounds):
            image = _grouped_gram(blocks, basis, stats)
            inner, turn = np.linalg.eigh(basis.T @ image)
            values, turn = inner[::-1], turn[:, ::-1]
            close = np.abs(values[:want] - last[:want]).max() <= tolerance * max(values[0], 1e-300)
            last = values
            components = basis @ turn
            if close:
                break
            basis = np.linalg.qr(image @ turn)[0]
        shares = np.maximum(last[:want], 0) / (stats.rows * whole)
        if level is None or want >= rank or shares.sum() >= level:
            return components[:, :want], shares
        basis, want = components, min(rank, 2 * want)


def _total_variance(blocks: DataFrame, width: int, stats: Moments) -> float:
    """The sum of the variances of the standardised features: 1 for each that varies."""

    def one(block: Block, _, out: np.ndarray, rest: np.ndarray) -> None:
        ones = np.ones((block.rows, 1))
        block.add_transposed(ones, out[:, :1])
        Block(block.first, block.feature, block.value**2, block.label_row, block.label).add_transposed(ones, out[:, 1:])

    sums, _ = summed(blocks, (width, 2), (1, 1), one, None)
    spread = sums[:, 1] / max(stats.rows, 1) - 2 * stats.mean * sums[:, 0] / max(stats.rows, 1) + stats.mean**2
    return float((spread / stats.deviation**2).sum())


def _grouped_gram(blocks: DataFrame, v: np.ndarray, stats: Moments) -> np.ndarray:
    group = max(1, group_size(len(v)) // 2)
    return np.concatenate([gram_times(blocks, v[:, a : a + group], stats) for a in range(0, v.shape[1], group)], axis=1)
