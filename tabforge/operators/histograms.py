"""Boosting rounds on rows stored as packed bins.

The rows of a fit are stored once, as blocks of files in the shared folder: a
row's bins, its label and a hash of its key. Features of which at most one is
not 0 in any row (the indicators of a category) share a column, and columns are
packed into codes of few thousand values, so a histogram takes a few counts
per row instead of one per feature; the sums per bin follow from the codes' sums
and are the same.

A fit is one stage whose tasks hold a share of the blocks each and stay until
the last round. The sums of a level meet in the first task, which chooses the
splits and tells the others, through small files in the shared folder: a Spark
job per level would take longer than its work. Gradients are rounded to a
multiple of a power of two at which their sums are exact, so the trees do not
depend on how rows lie in tasks.
"""

from __future__ import annotations

import itertools
import math
import os
import pickle
import random
import tempfile
import time
import uuid
from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.session import scratch_path

BLOCKS, BLOCK_ROWS = 64, (2**12, 2**17)  # wanted, with at least and at most so many rows
CELLS = (64, 4096)  # most values of a packed code, for few and for many rows
TOGETHER = 2**19  # rows of a task up to which its blocks are read once, as one
KEPT_ROWS = 2**22  # of a task whose state is in memory; beyond that predictions and nodes lie in a file on its disk
BUNDLED = 2048  # features up to which indicators are looked for
POISSON = np.array([round(2**32 * p) for p in itertools.accumulate(math.exp(-1) / math.factorial(k) for k in range(12))], np.uint64)  # of mean 1
PATIENCE_S = 6 * 3600  # without a word from another task


@dataclass
class Layout:
    """How features lie in columns and columns in codes.

    ``columns`` has the features of each column: several indicators, or one feature with its bins. ``groups`` has the columns
    of each code, ``cuts`` the possible splits ``(feature, bound, column, cell)`` in the order of features and bounds.
    """

    bounds: list[np.ndarray]
    columns: list[list[int]]
    shared: list[bool]
    groups: list[list[int]]

    def __post_init__(self) -> None:
        self.cards = [len(c) + 1 if s else len(self.bounds[c[0]]) + 1 for c, s in zip(self.columns, self.shared, strict=True)]
        self.starts = np.concatenate([[0], np.cumsum(self.cards)]).astype(int)
        self.widths = [math.prod(self.cards[c] for c in g) for g in self.groups]
        self.group_of = {c: k for k, g in enumerate(self.groups) for c in g}
        cuts = []
        for c, (features, together) in enumerate(zip(self.columns, self.shared, strict=True)):
            if together:
                cuts += [(f, 0, float(self.bounds[f][0]), c, j + 1) for j, f in enumerate(features)]
            else:
                cuts += [(features[0], b, float(v), c, b) for b, v in enumerate(self.bounds[features[0]])]
        self.cuts = sorted(cuts)
        self.cut_feature = np.array([f for f, *_ in self.cuts], int)
        self.cut_cell = np.array([self.starts[c] + j for *_, c, j in self.cuts], int)
        self.cut_shared = np.array([self.shared[c] for *_, c, _ in self.cuts], bool)

    def codes(self, x: np.ndarray) -> list[np.ndarray]:
        """The codes of rows of values. NaN lies below every bound, where trees send it."""
        out = []
        for group, width in zip(self.groups, self.widths, strict=True):
            code = np.zeros(len(x), np.int64)
            for c in group:
                features = self.columns[c]
                if self.shared[c]:
                    cell = sum((j + 1) * (x[:, f] != 0) for j, f in enumerate(features))
                else:
                    cell = np.searchsorted(self.bounds[features[0]], x[:, features[0]], side="left")
                    cell[np.isnan(x[:, features[0]])] = 0
                code = code * self.cards[c] + cell
            out.append(code.astype(np.uint16 if width <= 2**16 else np.uint32))
        return out

    def cells(self, k: int, sums: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """``(column, sums by its cells)`` from the sums (nodes x codes) of a group."""
        cube = sums.reshape(len(sums), *[self.cards[c] for c in self.groups[k]])
        for i, c in enumerate(self.groups[k]):
            yield c, cube.sum(tuple(j + 1 for j in range(cube.ndim - 1) if j != i))

    def column(self, sums: np.ndarray, c: int) -> np.ndarray:
        return sums[self.starts[c] : self.starts[c + 1]]

    def right_of(self, cut: int) -> tuple[int, np.ndarray]:
        """The group of a split's column and which of its codes go right."""
        _, _, _, c, cell = self.cuts[cut]
        k = self.group_of[c]
        inner = math.prod(self.cards[i] for i in self.groups[k][self.groups[k].index(c) + 1 :])
        at = np.arange(self.widths[k]) // inner % self.cards[c]
        return k, at == cell if self.shared[c] else at > cell

    def left_sums(self, sums: np.ndarray, whole: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the left side by cut, and of all (those of column ``whole``), of nodes x cells."""
        below = np.concatenate([np.cumsum(sums[:, a:b], 1) for a, b in zip(self.starts, self.starts[1:], strict=False)], 1)
        total = below[:, self.starts[whole + 1] - 1]
        return np.where(self.cut_shared, total[:, None] - sums[:, self.cut_cell], below[:, self.cut_cell]), total


def layout(bounds: list[np.ndarray], apart: np.ndarray | None, cells: int) -> Layout:
    """``apart[f, g]`` says that no row has both features, which are indicators, other than 0."""
    columns, shared, taken = [], [], {}
    for f, bound in enumerate(bounds):
        if not len(bound):
            continue
        if apart is not None and apart[f, f]:
            for at in taken.values():
                if len(columns[at]) < 255 and apart[f, columns[at]].all():
                    columns[at].append(f)
                    break
            else:
                taken[f] = len(columns)
                columns.append([f])
                shared.append(True)
        else:
            columns.append([f])
            shared.append(False)
    cards = [len(c) + 1 if s else len(bounds[c[0]]) + 1 for c, s in zip(columns, shared, strict=True)]
    groups: list[list[int]] = []
    for c in sorted(range(len(columns)), key=lambda i: -cards[i]):
        for g in groups:
            if math.prod(cards[i] for i in g) * cards[c] <= cells:
                g.append(c)
                break
        else:
            groups.append([c])
    return Layout(bounds, columns, shared, groups)


def shape(rows: DataFrame, size: int) -> tuple[list[list[float]], np.ndarray | None]:
    """Per feature its values if there are one or two, else none; and which pairs of indicators are never both set."""

    def empty() -> tuple[list[set[float] | None], np.ndarray | None]:
        return [set() for _ in range(size)], np.zeros((size, size)) if size <= BUNDLED else None

    def joined(a: set[float] | None, b: set[float] | None) -> set[float] | None:
        return None if a is None or b is None or len(a | b) > 2 else a | b

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few, met = empty()
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("_x").flatten().to_numpy().reshape(batch.num_rows, -1)
            low, high = x.min(0), x.max(0)
            two = ((x == low) | (x == high)).all(0)
            few = [joined(v, {float(a), float(b)} if t else None) for v, a, b, t in zip(few, low, high, two, strict=True)]
            if met is not None:
                on = (x != 0).astype(np.float32)
                met += on.T @ on
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((few, met))], pa.binary())], names=["part"])

    few, met = empty()
    for r in rows.select("_x").mapInArrow(seen, "part binary").collect():
        some, pairs = pickle.loads(r["part"])
        few, met = [joined(a, b) for a, b in zip(few, some, strict=True)], None if met is None else met + pairs
    values = [sorted(v or ()) for v in few]
    if met is None:
        return values, None
    flags = np.array([len(v) == 2 and v[0] == 0 for v in values], bool)
    apart = (met == 0) & flags[:, None] & flags
    apart[np.diag_indices(size)] = flags
    return values, apart


@dataclass
class Rows:
    """Stored rows: the names of the blocks in ``path`` with their numbers of rows, and how to read them."""

    path: str
    blocks: list[tuple[str, int]]
    lay: Layout
    size: int
    start: float
    train: int
    top: float  # at least the distance of any label from the start

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.blocks)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, which maps files of a local one instead of copying them."""
    if "://" in path or path.startswith("file:"):
        system, at = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
        if not isinstance(system, fs.LocalFileSystem):
            return system, at
        path = at
    return fs.LocalFileSystem(use_mmap=True), path


def _write(system: fs.FileSystem, name: str, parts: list[bytes | np.ndarray]) -> None:
    """A file that is there as a whole or not at all."""
    fresh = f"{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(fresh) as out:
        for part in parts:
            out.write(part if isinstance(part, bytes) else np.ascontiguousarray(part).data.cast("B"))
    system.move(fresh, name)


def store(spark: SparkSession, both: DataFrame, lay: Layout, size: int, start: float, train: int, top: float) -> Rows:
    """The rows ``(_x, _y, _hash, _val)`` as blocks; only the files that are named count, whatever other attempts wrote."""
    path, block = scratch_path(spark, "boosting-blocks"), min(max(train // BLOCKS, BLOCK_ROWS[0]), BLOCK_ROWS[1])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = _open(path)
        system.create_dir(at, recursive=True)
        held, n, names, counts = [], 0, [], []

        def flush() -> None:
            nonlocal held, n
            name = uuid.uuid4().hex
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            _write(system, f"{at}/{name}", columns)
            names.append(name)
            counts.append(n)
            held, n = [], 0

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("_x").flatten().to_numpy().reshape(batch.num_rows, -1)
            numbers = [batch.column("_y").to_numpy(), batch.column("_hash").to_numpy()]
            held.append([*numbers, *lay.codes(x), batch.column("_val").to_numpy(zero_copy_only=False).astype(np.uint8)])
            n += batch.num_rows
            if n >= block:
                flush()
        if n:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["name", "n"])

    blocks = [(r["name"], r["n"]) for r in both.select("_x", "_y", "_hash", "_val").mapInArrow(write, "name string, n long").collect()]
    return Rows(path, blocks, lay, size, start, train, top)


class _Block:
    """A stored block with the state of a fit."""

    def __init__(self, system: fs.FileSystem, name: str, n: int, widths: list[int], state: tuple[np.ndarray, ...]):
        self.system, self.name, self.n, self.widths = system, name, n, widths
        self.p, self.node, self.seen = state

    def read(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """Labels, hashes, codes by group and which rows are for validation."""
        with self.system.open_input_file(self.name) as f:
            data = f.read_buffer()
        at, out = 0, []
        for kind in (np.float64, np.int64, *[np.uint16 if w <= 2**16 else np.uint32 for w in self.widths], np.uint8):
            out.append(np.frombuffer(data, kind, self.n, at))
            at += self.n * np.dtype(kind).itemsize
        return out[0], out[1], out[2:-1], out[-1]


class _Together(_Block):
    """Some blocks as one, in memory."""

    def __init__(self, blocks: list[_Block], state: tuple[np.ndarray, ...]):
        y, hashes, codes, val = zip(*[b.read() for b in blocks], strict=True)
        self.n, (self.p, self.node, self.seen) = len(state[0]), state
        self.held = np.concatenate(y), np.concatenate(hashes), [np.concatenate(c) for c in zip(*codes, strict=True)], np.concatenate(val)

    def read(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        return self.held


def _space(n: int, kind: type, on_disk: bool) -> np.ndarray:
    if not on_disk or not n:
        return np.zeros(n, kind)
    with tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None) as f:
        return np.memmap(f, kind, "w+", shape=(n,))


def _chance(hashes: np.ndarray, salt: int) -> np.ndarray:
    """Numbers below 2^32 from the hashes of rows (splitmix64)."""
    z = hashes.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) >> np.uint64(32)


@dataclass
class Order:
    """What the first task has all do next: send rows down by ``splits`` ``(node, cut, left child)``; with ``weights``, add those of
    their nodes and begin round ``no``; then sum the rows of the nodes to ``build``."""

    splits: list[tuple[int, int, int]]
    nodes: int
    weights: np.ndarray | None
    no: int
    scale: float
    build: list[int]
    columns: list[int]


def _done(blocks: list[_Block], lay: Layout, order: Order, config) -> tuple[np.ndarray, float]:
    """Squared errors and numbers of training and validation rows, then the sums of the nodes to build; the largest gradient."""
    by_group: dict[int, list[tuple[int, np.ndarray, int]]] = {}
    for node, cut, left in order.splits:
        k, right = lay.right_of(cut)
        by_group.setdefault(k, []).append((node, right, left))
    moves = []
    for k, some in by_group.items():
        at, left = np.full(order.nodes, -1, np.int32), np.zeros(len(some), np.int32)
        for i, (node, _, child) in enumerate(some):
            at[node], left[i] = i, child
        moves.append((k, at, np.concatenate([r for _, r, _ in some]).view(np.int8), left))
    place = np.full(order.nodes if order.weights is None else 1, -1, np.int32)
    place[order.build] = range(len(order.build))
    wanted = set(order.columns)
    used = [k for k, g in enumerate(lay.groups) if any(wanted & set(lay.columns[c]) for c in g)]
    sums = {k: np.zeros((2, len(order.build) * lay.widths[k])) for k in used}
    errors, top = np.zeros(4), 0.0
    for block in blocks:
        y, hashes, codes, val = block.read()
        for k, at, right, left in moves:
            slot = at.take(block.node)
            here = np.flatnonzero(slot >= 0)
            slot = slot.take(here)
            block.node[here] = left.take(slot) + right.take(slot * np.int64(lay.widths[k]) + codes[k].take(here))
        if order.weights is not None:
            block.p += order.weights.take(block.node)
            block.node[:] = 0
            block.seen[:] = val == 0
            if config.bagged:
                block.seen *= np.searchsorted(POISSON, _chance(hashes, (config.seed << 20) + order.no), side="right").astype(np.int8)
            elif config.rows < 1:
                block.seen *= _chance(hashes, (config.seed << 20) + order.no) < np.uint64(round(config.rows * 2**32))
        g = block.p - y
        if order.weights is not None:
            held, known = val == 1, val == 0
            squares = g * g
            errors += squares[known].sum(), known.sum(), squares[held].sum(), held.sum()
            top = max(top, float(np.abs(g[known]).max(initial=0.0)))
        if not order.build:
            continue
        slot = place.take(block.node)
        here = np.flatnonzero((slot >= 0) & (block.seen > 0))
        slot, g, times = slot.take(here).astype(np.int64), np.rint(g.take(here) * order.scale), None
        if config.bagged:
            times = block.seen.take(here).astype(np.float64)
            g *= times
        for k in used:
            cell = slot * lay.widths[k] + codes[k].take(here)
            sums[k][0] += np.bincount(cell, g, sums[k].shape[1])
            sums[k][1] += np.bincount(cell, times, sums[k].shape[1])
    out = np.zeros((2, len(order.build), int(lay.starts[-1])))
    for k in used if order.build else ():
        for i in range(2):
            for c, found in lay.cells(k, sums[k][i].reshape(len(order.build), -1)):
                out[i, :, lay.starts[c] : lay.starts[c + 1]] = found
    return np.concatenate([errors, out.ravel()]), top


def chosen(lay: Layout, g: np.ndarray, n: np.ndarray, allowed: np.ndarray, whole: int, config) -> list[tuple[int, float, float, float] | None]:
    """Per node ``(cut, gain, left g, left rows)`` of its best split or None, from its sums by cell; ties to the first cut."""
    gl, total_g = lay.left_sums(g, whole)
    hl, total_h = lay.left_sums(n, whole)

    def quality(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        g = np.maximum(np.abs(g) - config.l1, 0) if config.l1 else g
        return g * g / np.maximum(h + config.l2, 1e-300)

    together = quality(total_g, total_h)
    hr, least = total_h[:, None] - hl, max(1, config.min_leaf, config.min_weight)
    gain = (quality(gl, hl) + quality(total_g[:, None] - gl, hr) - together[:, None]) / 2
    gain = np.where((hl >= least) & (hr >= least) & allowed, gain, -np.inf)
    best = gain.argmax(1)
    out = []
    for i, cut in enumerate(best):
        found = gain[i, cut]
        good = total_h[i] >= config.min_split and found > config.min_gain + 1e-12 * abs(together[i])
        out.append((int(cut), float(found), float(gl[i, cut]), float(hl[i, cut])) if good else None)
    return out


def rounds(rows: Rows, config) -> Generator[Order, tuple[np.ndarray, float], tuple[list, list[tuple[float, float]]]]:
    """The first task's part of a fit: orders out, sums in; returns the trees and the errors after each round."""
    from tabforge.operators.boosting import Tree, leaf_weight

    lay, rng = rows.lay, random.Random(config.seed)
    cells, trees, losses, best = int(lay.starts[-1]), [], [], 0
    splits, weights, nodes, top = [], np.array([rows.start]), 1, rows.top

    def weight(g: float, h: float) -> float:
        return config.rate * leaf_weight(g, h, config.l1, config.l2)

    def open_to(nodes: int) -> np.ndarray:
        """The cuts that the nodes of a level may take: those of the tree, or of a share of features drawn for each node."""
        if config.node_columns >= 1:
            return allowed
        some = np.zeros((nodes, rows.size), bool)
        for row in some:
            row[rng.sample(range(rows.size), max(1, math.ceil(config.node_columns * rows.size)))] = True
        return allowed & some[:, lay.cut_feature]

    for no in range(config.rounds + 1):
        features = set(rng.sample(range(rows.size), max(1, round(config.columns * rows.size))))
        if not np.isin(lay.cut_feature, list(features)).any():
            features |= set(lay.cut_feature[:1].tolist())
        allowed = np.isin(lay.cut_feature, list(features))
        used = [c for g in lay.groups if any(features & set(lay.columns[c]) for c in g) for c in g]
        whole, last = min(used, default=0), no == config.rounds or not lay.cuts and no > 0
        top += float(np.abs(weights).max()) if no else 0.0
        scale = 2.0 ** math.floor((46 if config.bagged else 51) - math.log2(max(rows.train, 1)) - math.log2(top)) if top > 0 else 1.0
        sums, top = yield Order(splits, nodes, weights, no, scale, [] if last or not cells else [0], sorted(features))
        if no:
            train, val = (sums[i] / sums[i + 1] if sums[i + 1] else None for i in (0, 2))
            losses.append((float(train), float(train if val is None else val)))
            if losses[-1][1] < losses[best][1]:
                best = no - 1
            elif no - 1 - best >= config.patience:
                break
        if last or not cells:
            break
        tree, level, splits = Tree(), [0], []
        known = {0: sums[4:].reshape(2, cells)}
        for depth in range(max(1, config.max_depth)):
            g, n = np.stack([known[node] for node in level], 1)
            totals = [(float(lay.column(x, whole).sum() / scale), float(lay.column(y, whole).sum())) for x, y in zip(g, n, strict=True)]
            if depth == 0:
                tree.weight[0] = weight(*totals[0])
            if not config.max_depth:
                break
            splits, halves = [], []
            for node, (total_g, total_h), split in zip(level, totals, chosen(lay, g / scale, n, open_to(len(level)), whole, config), strict=True):
                if split is None:
                    continue
                cut, gain, gl, hl = split
                left, right = tree.split(node, lay.cuts[cut][0], lay.cuts[cut][2], gain)
                tree.weight[left], tree.weight[right] = weight(gl, hl), weight(total_g - gl, total_h - hl)
                splits.append((node, cut, left))
                halves.append((node, left, right) if hl <= total_h - hl else (node, right, left))
            nodes = len(tree.feature)
            if not splits or depth + 1 >= config.max_depth:
                break
            sums, _ = yield Order(splits, nodes, None, no, scale, [small for _, small, _ in halves], sorted(features))
            found, parents, known = sums[4:].reshape(2, len(halves), cells), known, {}
            for i, (node, small, large) in enumerate(halves):  # the larger side is what remains of the parent
                known[small], known[large] = found[:, i], parents[node] - found[:, i]
            splits, level = [], sorted(known)
        trees.append(tree)
        weights = np.zeros(nodes) if config.bagged else np.array(tree.weight)
    return trees, losses


class _Team:
    """Tasks that add up their sums in the first one. Files are whole when they can be seen, and go once all have read them."""

    def __init__(self, path: str, rank: int, size: int):
        self.rank, self.size, self.step = rank, size, 0
        if size > 1:
            self.system, self.path = _open(path)
            self.system.create_dir(self.path, recursive=True)

    def _wait(self, name: str) -> bytes:
        began, pause = time.monotonic(), 0.0003
        local = isinstance(self.system, fs.LocalFileSystem)
        while not (os.path.exists(name) if local else self.system.get_file_info(name).type == fs.FileType.File):
            if time.monotonic() - began > PATIENCE_S:
                raise TimeoutError(f"no word from another task: {name}")
            time.sleep(pause)
            pause = min(pause * 1.3, 0.01 if local else 0.2)
        with self.system.open_input_file(name) as f:
            return f.read()

    def total(self, sums: np.ndarray, top: float) -> tuple[np.ndarray, float] | None:
        """The sums of all tasks, in the first one."""
        self.step += 1
        if self.rank:
            _write(self.system, f"{self.path}/{self.step}-{self.rank}", [np.append(sums, top)])
            return None
        for rank in range(1, self.size):
            name = f"{self.path}/{self.step}-{rank}"
            part = np.frombuffer(self._wait(name))
            sums, top = sums + part[:-1], max(top, float(part[-1]))
            self.system.delete_file(name)
        if self.size > 1 and self.step > 1:
            self.system.delete_file(f"{self.path}/{self.step - 1}")  # all have read it, as they have done what it says
        return sums, top

    def told(self, order: Order | None) -> Order | None:
        if self.size == 1:
            return order
        if self.rank:
            return pickle.loads(self._wait(f"{self.path}/{self.step}"))
        _write(self.system, f"{self.path}/{self.step}", [pickle.dumps(order)])
        return order


def _work(rows: Rows, config, team: _Team) -> tuple[list, list[tuple[float, float]]] | None:
    """A task's part of a fit; the first one returns the trees and errors."""
    system, at = _open(rows.path)
    mine = rows.blocks[team.rank :: team.size]
    total = sum(n for _, n in mine)
    p, node, seen = (_space(total, kind, total > KEPT_ROWS) for kind in (np.float64, np.int32, np.int8))
    blocks, a = [], 0
    for name, n in mine:
        blocks.append(_Block(system, f"{at}/{name}", n, rows.lay.widths, (p[a : a + n], node[a : a + n], seen[a : a + n])))
        a += n
    if 0 < total <= TOGETHER:
        blocks = [_Together(blocks, (p, node, seen))]
    brain = None if team.rank else rounds(rows, config)
    order, found = team.told(next(brain) if brain else None), None
    while order is not None:
        reply = team.total(*_done(blocks, rows.lay, order, config))
        if brain:
            try:
                order = brain.send(reply)
            except StopIteration as end:
                order, found = None, end.value
        order = team.told(order)
    return found


def prepare(rows: DataFrame, bins: int) -> Rows | None:
    """``rows(_x, _y, _hash, _val)``, features and label of which are known, stored for fits; None without training rows."""
    from tabforge.operators.boosting import bin_bounds

    train = rows.where("NOT _val")
    start, n, size, low, high = train.agg(F.avg("_y"), F.count("_y"), F.max(F.size("_x")), F.min("_y"), F.max("_y")).first()
    if start is None:
        return None
    few, apart = shape(rows, size)
    many = [f for f in range(size) if not few[f]]
    bounds: list[np.ndarray] = [np.array(v[:-1]) for v in few]
    for f, found in zip(many, bin_bounds(train, size, bins, many), strict=True):
        bounds[f] = found
    return store(rows.sparkSession, rows, layout(bounds, apart, min(max(n // 512, CELLS[0]), CELLS[1])), size, float(start), n, max(high - start, start - low))


def slots(spark: SparkSession) -> int:
    """Tasks that can run at the same time; 1 where executors come and go, as then no stage can hold several."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 1
    context = spark.sparkContext._jsc.sc()
    return max(1, context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile()))


def fit(spark: SparkSession, rows: Rows, config, tasks: int | None = None) -> tuple[list, list[tuple[float, float]]]:
    """All rounds in one stage of at most ``tasks`` tasks, as many as have a block."""
    size = max(1, min(tasks or slots(spark), len(rows.blocks)))
    path = scratch_path(spark, "boosting-words")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            pass
        at, rank = path, 0
        if size > 1:
            context = BarrierTaskContext.get()
            rank = context.partitionId()
            at = f"{path}/{context.allGather(uuid.uuid4().hex)[0]}"  # of this attempt alone
        found = _work(rows, config, _Team(at, rank, size))
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], names=["found"])

    out = spark.range(0, size, 1, size).mapInArrow(task, "found binary", barrier=size > 1).collect()
    return pickle.loads(out[0]["found"])
