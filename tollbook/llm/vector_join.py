"""Near-duplicate vectors by an exact cosine join: blocks of rotated coordinates, each
joined by range, and the union of what they find verified.

Unit vectors of cosine c or more lie within a squared distance of 2 - 2 c. Rotated
and cut into blocks, the squared distances of the blocks add up to that of the
vectors, so in some block it is at most the block's share of the budget; a pair is
counted in the first such block.

A block is joined by range over cells, which are the signs of its first coordinates
from their means. Of two vectors in range in different cells one is nearer to the
other's cell than half of the budget: going from one to the other, what each has to go to
reach the border of its cell adds up to at most the way between them. So a vector is
compared with the cells that it reaches with half of the budget, itself at most once
with each other. A block's vectors are stored once, in order of their cells; a task
holds one tile of them while others stream past, so nothing is sent twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.llm.common import clusters, discard, lookup, released, stored, with_row

#: Blocks; vectors and bytes of them that a task holds; vectors of a cell, cells that are
#: sorted out together, and signs of a cell at most.
BLOCKS, TILE, TILE_BYTES, LEAF, LEAVES, SIGNS = 4, 200_000, 96 << 20, 256, 32, 20
#: Vectors that stream past a tile at once, pairs that are compared at once, and verified.
CHUNK, PAIRS, EXACT = 100_000, 1 << 19, 16_384
#: Pairs that are verified at once where many are near.
DENSE = 1 << 16
#: Passes in which a block's vectors are shuffled, and vectors by which partitions are cut.
PASSES, SAMPLE = 4, 40_000
#: Against rounding: budgets are larger by this, and verified pairs are exact anyway.
SLACK = 1e-9
#: Sums of products in another order differ by less; where that could decide, they are taken anew.
CLOSE = 1e-10
PLACED = "place int, size int, code long, node long, n long, part binary, vector binary"
FOUND = "node long, links long, root long"


@lru_cache(8)
def rotation(size: int, seed: int = 20240229) -> np.ndarray:
    """An orthogonal matrix, the same on every executor; it spreads what differs over
    all coordinates, so that no block holds most of it."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def turned(units: np.ndarray) -> np.ndarray:
    """Rotated one coordinate after the other, so that a vector's bits do not depend on
    those that it is rotated with."""
    turn, out = rotation(units.shape[1]), np.zeros_like(units)
    for column, row in zip(units.T, turn, strict=True):
        out += column[:, None] * row
    return out


def blocks_of(size: int, blocks: int = BLOCKS) -> list[slice]:
    edges = np.linspace(0, size, min(blocks, size) + 1).round().astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def budget_of(cosine: float, blocks: int) -> float:
    """The squared distance of two near vectors, at most, in the block in which they are nearest."""
    return (2 - 2 * cosine) / blocks + SLACK


def slack_of(width: int) -> float:
    """More than squared distances in single precision can be wrong, of parts no longer than 2."""
    return 1e-6 * (width + 4)


def signs_of(count: int, width: int) -> int:
    return int(np.clip(np.log2(max(count, 1) / LEAF), 0, min(width, SIGNS)))


def units_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and which rows have one: not zero and not infinite ones."""
    raw = raw.astype(np.float64)
    valid = np.isfinite(raw).all(axis=1) & raw.any(axis=1)
    raw = raw[valid]
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)  # else squares of very large or small components are lost
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True)) + 0.0, valid


def by_size(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of each length and their values; without null and empty lists and those with nulls."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    offsets, values, usable = column.offsets.to_numpy(), column.values, lengths > 0
    if values.null_count:
        nulls = np.concatenate([[0], np.cumsum(values.is_null().to_numpy(zero_copy_only=False))])
        usable &= nulls[offsets[1:]] == nulls[offsets[:-1]]
        values = values.fill_null(0)
    flat = values.to_numpy()
    for size in np.unique(lengths[usable]).tolist():
        rows = np.flatnonzero(usable & (lengths == size))
        yield rows, flat[offsets[rows][:, None] + np.arange(size)]


def _digests(rows: DataFrame) -> DataFrame:
    """``_row``, the key and 128 bits of the unit vector; null without one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests: list[bytes | None] = [None] * batch.num_rows
            for at, raw in by_size(batch.column(2)):
                units, valid = units_of(raw)
                for k, u in zip(at[valid].tolist(), units, strict=True):
                    digests[k] = hashlib.blake2b(u.tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary())], ["_row", "key", "digest"]
            )

    return rows.select("_row", "key", "vector").mapInArrow(run, "_row long, key long, digest binary")


class Space:
    """What is known of the vectors of one length: how many there are, their rotated mean, and
    some of them with their nodes, by which tiles are cut (only their sizes depend on that)."""

    def __init__(self, size: int):
        self.count, self.total = 0, np.zeros(size)
        self.nodes, self.sample = np.zeros(0, np.int64), np.zeros((0, size), np.float32)

    def add(self, count: int, total: np.ndarray, nodes: np.ndarray, sample: np.ndarray) -> None:
        self.count, self.total = self.count + count, self.total + total
        self.nodes, self.sample = np.concatenate([self.nodes, nodes]), np.concatenate([self.sample, sample])

    def place(self, units: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        """The cells of vectors in a block, and what of them is in it."""
        size = units.shape[1]
        within, turn = blocks_of(size)[number], rotation(size)
        part = (units @ turn[:, within] - (self.total / self.count @ turn)[within]).astype(np.float32)
        signs = part[:, : signs_of(self.count, part.shape[1])] > 0
        return signs @ (1 << np.arange(signs.shape[1], dtype=np.int64)[::-1]), part


def spread(code: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The order of vectors in tiles, by their cells and within one by a hash."""
    return code.astype(np.int64) << 32 | (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64)


def _spaces(vectors: DataFrame) -> dict[int, Space]:
    tasks = vectors.rdd.getNumPartitions()
    most = max(1, SAMPLE // max(1, tasks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces: dict[int, Space] = {}
        for batch in batches:
            for at, raw in by_size(batch.column(1)):
                units, _ = units_of(raw)
                space = spaces.setdefault(raw.shape[1], Space(raw.shape[1]))
                some = np.arange(0, len(units), max(1, len(units) // most))[: max(1, most - len(space.nodes))]
                some = some if len(space.nodes) < most else some[:0]
                nodes = batch.column(0).to_numpy()[at]
                space.add(len(units), units.sum(axis=0), nodes[some], units[some].astype(np.float32))
        rows = [
            {"size": k, "count": s.count, "total": s.total.tobytes(), "nodes": s.nodes.tobytes(), "sample": s.sample.tobytes()}
            for k, s in spaces.items()
        ]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))]))

    schema = "size long, count long, total binary, nodes binary, sample binary"
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    found: dict[int, Space] = {}
    for row in vectors.select("node", "vector").mapInArrow(run, schema).collect():
        sample = np.frombuffer(row["sample"], np.float32).reshape(-1, row["size"])
        total, nodes = np.frombuffer(row["total"]), np.frombuffer(row["nodes"], np.int64)
        found.setdefault(row["size"], Space(row["size"])).add(row["count"], total, nodes, sample)
    return found


def _borders(spaces: dict[int, Space], number: int, count: int) -> dict[int, tuple[int, np.ndarray]]:
    """Where to cut the vectors, by length and order, into as many partitions: for each length
    the first partition, and the first of each later one."""
    orders = {}
    for size in sorted(s for s in spaces if number < len(blocks_of(s))):
        space = spaces[size]
        orders[size] = np.sort(spread(space.place(space.sample.astype(np.float64), number)[0], space.nodes))
    weights = {size: spaces[size].count for size in orders}
    total, before, found = sum(weights.values()), 0, {}
    for size, order in orders.items():
        first, after = (x * count // max(1, total) for x in (before, before + weights[size]))
        first, after = min(first, count - 1), min(after, count - 1)
        cuts = (np.arange(first + 1, after + 1) * total / count - before) / weights[size]
        found[size] = first, order[np.clip((cuts * len(order)).astype(int), 0, len(order) - 1)]
        before += weights[size]
    return found


def _binary(matrix: np.ndarray) -> pa.Array:
    """The rows' bytes."""
    matrix = np.ascontiguousarray(matrix)
    offsets = (np.arange(len(matrix) + 1) * matrix.strides[0]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(matrix)])


def _placed(vectors: DataFrame, number: int, spaces: dict[int, Space], count: int) -> DataFrame:
    """Every vector with its cell in a block, with what of it is in that block, and with its
    partition, in which are those whose cells come next to it."""
    borders = _borders(spaces, number, count)
    spaces = {size: _without_sample(space) for size, space in spaces.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, raw in by_size(batch.column(2)):
                size = raw.shape[1]
                if size not in borders:
                    continue
                code, part = spaces[size].place(units_of(raw)[0], number)
                first, cuts = borders[size]
                place = first + np.searchsorted(cuts, spread(code, batch.column(0).to_numpy()[at]), side="right")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place.astype(np.int32)),
                        pa.array(np.full(len(at), size, np.int32)),
                        pa.array(code),
                        *(batch.column(k).take(pa.array(at)) for k in (0, 1)),
                        _binary(part),
                        _binary(raw),
                    ],
                    [c.split()[0] for c in PLACED.split(", ")],
                )

    return vectors.select("node", "n", "vector").mapInArrow(run, PLACED)


def _without_sample(space: Space) -> Space:
    bare = Space(len(space.total))
    bare.count, bare.total = space.count, space.total
    return bare


class Tile:
    """Vectors of one length in the order of their cells; what they are verified by is
    read when it is needed."""

    def __init__(self, code: np.ndarray, node: np.ndarray, n: np.ndarray, part: np.ndarray, signs: int, raw: Callable[[], np.ndarray]):
        order = np.argsort(code, kind="stable")
        self.code, self.node, self.n, self.part = code[order], node[order], n[order], part[order]
        self.signs, self._raw, self._order, self._values = signs, raw, order, None

    def __len__(self) -> int:
        return len(self.code)

    def units(self, at: np.ndarray) -> np.ndarray:
        if self._values is None:
            self._values = self._raw()
        return units_of(self._values[self._order[at]])[0]

    def apart(self, left: bool) -> np.ndarray:
        """Of two tiles' products of these, one of them on the left, half of the squared distance, negative."""
        half = -0.5 * (self.part * self.part).sum(axis=1, keepdims=True)
        one = np.ones_like(half)
        return np.hstack([self.part, half, one] if left else [self.part, one, half])

    def ways(self) -> np.ndarray:
        """The squared way to the border of each coordinate, first of those above it and then of those below."""
        part = self.part[:, : self.signs]
        return np.hstack([np.maximum(part, 0) ** 2, np.minimum(part, 0) ** 2])

    def cells(self, start: int, stop: int, limit: int, depth: int = 0) -> list[tuple[int, int, int]]:
        """Ranges with the same signs, and how many; as few signs as hold the limit."""
        found, open_ = [], [(start, stop, depth)]
        while open_:
            start, stop, depth = open_.pop()
            if stop - start <= limit or depth == self.signs:
                found.append((start, stop, depth))
                continue
            rest = self.signs - depth - 1
            border = ((int(self.code[start]) >> (rest + 1)) * 2 + 1) << rest
            cut = start + int(np.searchsorted(self.code[start:stop], border))
            open_ += [(a, b, depth + 1) for a, b in ((cut, stop), (start, cut)) if a < b]
        return found

    def borders(self, cells: list[tuple[int, int, int]]) -> np.ndarray:
        """What to add up of ``ways`` for the way to each cell."""
        code = self.code[[c[0] for c in cells]]
        place = np.arange(self.signs)
        above = (code[:, None] >> (self.signs - 1 - place)) & 1 == 1
        counts = place < np.array([c[2] for c in cells])[:, None]
        return np.hstack([counts & ~above, counts & above]).astype(np.float32)

    def borders_of_all(self) -> np.ndarray:
        """What to add up of ``ways`` for the way to each vector's cell."""
        return self.borders([(k, k + 1, self.signs) for k in range(len(self.code))])


def _tiles(paths: list[str], spaces: dict[int, Space]) -> dict[int, Tile]:
    """The vectors of some files, by length."""

    def read(*columns: str) -> pa.Table:
        tables = []
        for path in paths:
            files, name = pa.fs.FileSystem.from_uri(path)
            with files.open_input_file(name) as file:
                tables.append(pa.parquet.ParquetFile(file).read(list(columns)))
        return pa.concat_tables(tables)

    def matrix(column: pa.ChunkedArray, at: np.ndarray, kind: str | None, width: int) -> np.ndarray:
        rows = column.take(pa.array(at)).combine_chunks()
        rows = pa.concat_arrays(rows.chunks) if isinstance(rows, pa.ChunkedArray) else rows
        data, offsets = rows.buffers()[2], np.frombuffer(rows.buffers()[1], np.int32)
        begin, end = offsets[rows.offset], offsets[rows.offset + len(rows)]
        kind = kind or {4: "f4", 8: "f8"}[(int(end) - int(begin)) // (len(rows) * width)]
        return np.frombuffer(data, np.uint8)[begin:end].view(kind).reshape(len(rows), width)

    table = read("size", "code", "node", "n", "part")
    sizes, found = table["size"].to_numpy(), {}
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        bytes_ = len(table["part"][int(at[0])].as_py())
        part = matrix(table["part"], at, "f4", bytes_ // 4)
        code, node, n = (table[c].to_numpy()[at] for c in ("code", "node", "n"))
        raw = lambda at=at, size=size: matrix(read("vector")["vector"], at, None, size)
        found[size] = Tile(code, node, n, part, signs_of(spaces[size].count, part.shape[1]), raw)
    return found


class Links:
    """What is found between a tile's vectors and others, of one length and in one block.

    Of each vector how many it is linked to, and one link to the least vector that links
    found here reach, so that no more rows leave than came.
    """

    def __init__(self, home: Tile, guest: Tile, size: int, number: int, cosine: float):
        self.home, self.guest, self.number, self.cosine = home, guest, number, cosine
        self.parts = blocks_of(size)
        self.budget = budget_of(cosine, len(self.parts))
        self.links = np.zeros(len(home) + len(guest), np.int64)
        self.root = np.arange(len(self.links))
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, h: np.ndarray, g: np.ndarray) -> None:
        self.waiting.append((h, g))
        self.held += len(h)
        if self.held >= EXACT:
            self.settle()

    def _way(self, h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The squared ways of pairs to each other's cells: the guest's, and that of the one at home."""
        home, guest = self.home, self.guest
        place = home.signs - 1 - np.arange(home.signs)
        differ = ((home.code[h] ^ guest.code[g])[:, None] >> place) & 1 == 1
        there, here = (np.where(differ, x[:, : home.signs].astype(np.float64), 0) for x in (guest.part[g], home.part[h]))
        return (there * there).sum(axis=1), (here * here).sum(axis=1)

    def _comes(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Whether it is the guest that comes, not the other one as a guest to the guest's cell."""
        there, here = self._way(h, g)
        return (there < here) | ((there == here) & (self.guest.node[g] < self.home.node[h]))

    def settle(self) -> None:
        """Verify the pairs that wait, and count those that this block is the first to find."""
        if not self.held:
            return
        all_h, all_g = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        self.waiting, self.held = [], 0
        for k in range(0, len(all_h), EXACT):
            h, g = all_h[k : k + EXACT], all_g[k : k + EXACT]
            comes = self._comes(h, g)
            h, g = h[comes], g[comes]
            if len(h):
                (of_h, x), (of_g, y) = (np.unique(z, return_inverse=True) for z in (h, g))
                found = self._exact(self.home.units(of_h), self.guest.units(of_g), x, y)
                self._count(h[found], g[found])

    def _exact(self, left: np.ndarray, right: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        near = (left[x] * right[y]).sum(axis=1) >= self.cosine
        left, right = turned(left), turned(right)
        for k, part in enumerate(self.parts[: self.number + 1]):
            way = left[x, part] - right[y, part]
            within = (way * way).sum(axis=1) <= self.budget
            near &= within if k == self.number else ~within
        return near

    def _count(self, h: np.ndarray, g: np.ndarray) -> None:
        g_at = g + len(self.home)
        np.add.at(self.links, h, self.guest.n[g])
        np.add.at(self.links, g_at, self.home.n[h])
        self._join(h, g_at)

    def _join(self, x: np.ndarray, y: np.ndarray) -> None:
        root = self.root
        while True:
            a, b = root[x], root[y]
            if not (differ := a != b).any():
                return
            x, y, a, b = x[differ], y[differ], a[differ], b[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while ((new := root[root]) != root).any():
                root[:] = new

    def dense(self, h: np.ndarray, g: np.ndarray) -> None:
        """All of the pairs between some vectors, where many of them are near: by products of
        matrices, and one by one where rounding could decide."""
        home, guest = self.home, self.guest
        left, right = home.units(h), guest.units(g)
        left_turned, right_turned = turned(left), turned(right)
        of_h, of_g = _some(home, h), _some(guest, g)
        here, to_here = of_h.ways().astype(np.float64), of_h.borders_of_all().astype(np.float64)
        there, to_there = of_g.ways().astype(np.float64), of_g.borders_of_all().astype(np.float64)
        weights = guest.n[g].astype(np.float64)
        step = max(1, DENSE // len(g))
        for k in (slice(at, at + step) for at in range(0, len(h), step)):
            near, unsure = self._near(left[k], right, left_turned[k], right_turned)
            if not near.any():
                continue
            way, back = to_here[k] @ there.T, here[k] @ to_there.T
            same = of_h.code[k][:, None] == of_g.code
            unsure |= near & ~same & (np.abs(way - back) < CLOSE)
            near &= np.where(same, guest.node[g] < home.node[h[k]][:, None], way < back) & ~unsure
            counted = near.astype(np.float64)
            self.links[h[k]] += (counted @ weights).astype(np.int64)
            self.links[g + len(home)] += (home.n[h[k]].astype(np.float64) @ counted).astype(np.int64)
            near &= self.root[h[k]][:, None] != self.root[g + len(home)]
            if near.any():
                x, y = np.nonzero(near)
                self._join(h[k][x], g[y] + len(home))
            if unsure.any():
                x, y = np.nonzero(unsure)
                self.add(h[k][x], g[y])

    def _near(self, left: np.ndarray, right: np.ndarray, left_turned: np.ndarray, right_turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs this block is the first to find, and of which of them that is not sure."""
        near, unsure = np.ones((len(left), len(right)), bool), np.zeros((len(left), len(right)), bool)
        for k, part in enumerate(self.parts[: self.number + 1]):
            a, b = left_turned[:, part], right_turned[:, part]
            apart = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
            close = np.abs(apart - self.budget) < CLOSE
            near &= ((apart <= self.budget) == (k == self.number)) | close
            unsure |= close
            if not near.any():
                return near, unsure
        product = left @ right.T
        close = np.abs(product - self.cosine) < CLOSE
        near &= (product >= self.cosine) | close
        return near, (unsure | close) & near

    def rows(self) -> pa.RecordBatch:
        self.settle()
        at = np.flatnonzero(self.links)
        node = np.concatenate([self.home.node, self.guest.node])
        least = np.full(len(node), np.iinfo(np.int64).max)
        np.minimum.at(least, self.root[at], node[at])
        columns = node[at], self.links[at], least[self.root[at]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in FOUND.split(", ")])


def _some(tile: Tile, at: np.ndarray) -> Tile:
    some = Tile.__new__(Tile)
    some.code, some.part, some.signs = tile.code[at], tile.part[at], tile.signs
    return some


def compared(home: Tile, guest: Tile, links: Links) -> int:
    """Compare guests with the cells that they reach; the number of pairs."""
    width, pairs = home.part.shape[1], 0
    reach = np.float32(links.budget / 2 + slack_of(width))
    least = np.float32(-(links.budget + slack_of(width)) / 2)
    left, right, ways = home.apart(True), guest.apart(False), guest.ways()
    groups = home.cells(0, len(home), LEAF * LEAVES)
    products, nears = np.empty(PAIRS, np.float32), np.empty(PAIRS, bool)
    for group, comes in zip(groups, home.borders(groups) @ ways.T <= reach, strict=True):
        some = np.flatnonzero(comes)
        if not len(some):
            continue
        cells = home.cells(group[0], group[1], LEAF, group[2])
        for (start, stop, _), comes in zip(cells, home.borders(cells) @ ways[some].T <= reach, strict=True):
            others = some[comes]
            step = max(1, PAIRS // min(stop - start, LEAF * 4))
            for k in range(0, len(others), step):
                g = others[k : k + step]
                strip = right[g].T
                for begin in range(start, stop, LEAF * 4):
                    end = min(begin + LEAF * 4, stop)
                    product = products[: (end - begin) * len(g)].reshape(end - begin, len(g))
                    near = nears[: product.size].reshape(product.shape)
                    np.matmul(left[begin:end], strip, out=product)
                    np.greater_equal(product, least, out=near)
                    pairs += near.size
                    rows = np.flatnonzero(near.any(axis=1))
                    if not len(rows):
                        continue
                    x, y = np.nonzero(near[rows])
                    if len(x) > max(2000, near.size // 20):
                        links.dense(np.arange(begin, end), g)
                    else:
                        links.add(rows[x] + begin, g[y])
    return pairs


def _found(tables: list[DataFrame], number: int, spaces: dict[int, Space], cosine: float, tile: int) -> DataFrame:
    """The links between the vectors of the stored files: tasks hold some files' vectors
    and read through a share of all files."""
    spark = tables[0].sparkSession
    spaces = {size: _without_sample(space) for size, space in spaces.items()}
    files: list[tuple[str, int]] = []
    for table in tables:
        counts = table.groupBy(F.input_file_name().alias("path")).count().collect()
        files += [(r["path"], r["count"]) for r in counts]
    files.sort(key=lambda f: f[0].rpartition("/")[2])  # by partition
    total, tasks = sum(count for _, count in files), 4 * spark.sparkContext.defaultParallelism
    homes = _grouped(files, tile)
    guests = _grouped(files, max(1, min(CHUNK, tile, total // tasks)))
    shares = min(len(guests), -(-tasks // max(1, len(homes))))
    work = [(home, guests[k::shares]) for home in homes for k in range(shares)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                at_home = _tiles(work[k][0], spaces)
                for paths in work[k][1]:
                    for size, guest in _tiles(paths, spaces).items():
                        if size in at_home:
                            links = Links(at_home[size], guest, size, number, cosine)
                            compared(at_home[size], guest, links)
                            yield links.rows()

    return spark.range(0, len(work), 1, max(1, len(work))).mapInArrow(run, FOUND)


def _grouped(files: list[tuple[str, int]], limit: int) -> list[list[str]]:
    """Files in their order, together as long as they have no more rows than the limit."""
    found: list[list[str]] = []
    held = limit
    for path, count in files:
        if held + count > limit or not found:
            found.append([])
            held = 0
        found[-1].append(path)
        held += count
    return found


def _links(spark: SparkSession, vectors: DataFrame, cosine: float) -> DataFrame | None:
    """What all blocks find; each in its turn, so that only one block's tiles are on disk."""
    spaces = _spaces(vectors)
    if not spaces:
        return None
    total, largest = sum(space.count for space in spaces.values()), max(spaces)
    tile = max(1, min(TILE, TILE_BYTES // (8 * largest)))
    # Shuffled in passes, each over a share of the vectors, so that a share's shuffle is on disk.
    passes = min(PASSES, -(-total // tile))
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // min(CHUNK, tile)))
    files = -(-files // passes)
    found = None
    for number in range(min(BLOCKS, largest)):
        tables = []
        for k in range(passes):
            share = vectors if passes == 1 else vectors.filter(F.pmod(F.xxhash64("node"), F.lit(passes)) == k)
            placed = _placed(share, number, spaces, files)
            tables.append(stored(placed.repartitionById(files, "place").drop("place"), "tiles"))
            placed = None
            released(spark)
        links = stored(_found(tables, number, spaces, cosine, tile), "links")
        discard(*tables)
        found = links if found is None else found.union(links)
    return found


def near_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", cosine: float = 0.95) -> DataFrame:
    """The key, ``n_links`` (other rows of at least that cosine), ``component_id`` (least
    key that links reach, its own included) and ``kept`` (whether it is that one).

    Null, empty, zero and not finite vectors are linked with nothing, and vectors of
    different length are not compared. Vectors equal as unit vectors are one until
    the end, however many there are; they are told apart by 128-bit hashes. Rows with null
    or equal keys are rows of their own; of equal keys in one component all are kept, and a
    null key is where its component has no other. Other columns are ignored; an empty table
    gives no rows.
    """
    single = vectors.schema[column].dataType.simpleString() == "array<float>"
    values = F.col(column) if single else F.col(column).cast("array<double>")
    rows = with_row(vectors, key, values.alias("vector")).withColumnRenamed(key, "key")
    units = stored(_digests(rows), "units")
    valid = units.filter("digest IS NOT NULL")
    nodes = valid.groupBy("digest").agg(F.min("_row").alias("node"), F.min("key").alias("low"), F.count("*").alias("n"))
    nodes = stored(nodes, "nodes")
    firsts = rows.join(nodes.select(F.col("node").alias("_row"), "n"), "_row")
    firsts = stored(firsts.select(F.col("_row").alias("node"), "n", "vector"), "vectors")
    found = _links(vectors.sparkSession, firsts, cosine)
    discard(firsts)
    whole = nodes.select("*", F.lit(None).cast("long").alias("links"), F.lit(None).cast("long").alias("component"))
    if found is not None:
        counts = found.groupBy("node").agg(F.sum("links").alias("links"))
        parts = clusters(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
        whole = nodes.join(counts, "node", "left").join(parts, "node", "left")
    whole = whole.withColumn("component", F.coalesce("component", "node"))
    least = whole.groupBy("component").agg(F.min("low").alias("component_id"))
    whole = whole.join(least, "component").select(
        "digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.col("n").alias("rows")
    )
    placed_rows = lookup(units, whole, ["digest"], "rows")
    linked = F.col("digest").isNotNull()
    component = F.when(linked, F.col("component_id")).otherwise(F.col("key"))
    return placed_rows.select(
        F.col("key").alias(key),
        F.when(linked, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )
