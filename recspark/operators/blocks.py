"""Exact best-k search between two vector tables, block against block.

Scores of a personal model have to look at every user-item pair once, but no pair has to
become a row: both sides are cut into hash blocks, a task multiplies one user block with
one item block in numpy, and hands on at most ``k`` rows per user and block.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import cut, stored
from .ordering import top_k

# Large blocks keep the copies of both sides low: users are sent once per item block, items
# once per user block.  A block takes at most so much memory as doubles and so many rows; hash
# blocks vary a little around that.
BLOCK_BYTES, BLOCK_ROWS = 64 << 20, 1 << 17
MIN_BLOCK_ROWS = 64
# Copies that are on disk at a time, as a multiple of the rows of both sides.
ROUND_SHARE = 2
_ID_BITS = 16  # room for the row number inside a slice of items
_TILE_CELLS = 1 << 18  # scores held at a time, about 2 MB: stays in the core's cache
_SIFT_STEP, _SIFT_CELLS = 8192, 1 << 14  # items of a step, cells scored at once
_LARGEST = 1e15  # squares and sums of such numbers fit single precision


def _dot(u, v, _item):
    return u @ v.T


def _unit(m):
    length = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def _euclidean(u, v, _item):
    # negated, so that larger is closer; direct differences keep the digits
    out = np.empty((len(u), len(v)))
    for r in range(len(u)):
        diff = v - u[r]
        out[r] = -np.sqrt((diff * diff).sum(axis=1))
    return out


def _manhattan(u, v, _item):
    out = np.empty((len(u), len(v)))
    for r in range(len(u)):
        out[r] = -np.abs(v - u[r]).sum(axis=1)
    return out


def _probability(u, v):
    return 1.0 / (1.0 + np.exp(-(u @ v.T)))


def _expected_revenue(u, v, price):
    return _probability(u, v) * price[None, :]


def _utility(u, v, price):
    p = _probability(u, v)
    return ((np.sin(p) + 1) * np.exp(p - 1) * np.log1p(price)[None, :]
            * np.cos(price / 100)[None, :] * (1 + np.tan(p * np.pi / 4)))


# cosine is the dot product of vectors that are normalised once per block
SCORES = {"dot": _dot, "cosine": _dot, "euclidean": _euclidean, "manhattan": _manhattan,
          "expected_revenue": _expected_revenue, "utility": _utility}


def _vectors(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(table), -1)


def _seen_cells(user_ids: np.ndarray, ids: np.ndarray, seen_user: np.ndarray, seen_item: np.ndarray):
    """Row and column indices of the seen pairs among the block's users and sorted items."""
    at = np.searchsorted(ids, seen_item)
    hit = (at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == seen_item)
    seen_user, at = seen_user[hit], at[hit]
    order = np.argsort(user_ids, kind="stable")
    first = np.searchsorted(user_ids, seen_user, "left", order)
    found = np.searchsorted(user_ids, seen_user, "right", order) - first
    rows = np.repeat(first - np.cumsum(found) + found, found) + np.arange(found.sum())
    return order[rows], np.repeat(at, found)


def _whole(u, v, extra, hidden, k, score, digits, threshold):
    """Best cells of every row by scoring all cells: (row, column, score); ``hidden`` cells (row, column) are left out."""
    scale, out = 10.0 ** digits, []
    order = np.argsort(hidden[0], kind="stable")
    hidden_row, hidden_col = hidden[0][order], hidden[1][order]
    for at in range(0, len(v), 1 << _ID_BITS):
        some = slice(at, min(len(v), at + (1 << _ID_BITS)))
        order = np.arange(some.stop - at, dtype=np.int64)
        keep = min(k, len(order))
        tile = max(1, _TILE_CELLS // len(order))
        for lo in range(0, len(u), tile):
            hi = min(lo + tile, len(u))
            fixed = np.rint(SCORES[score](u[lo:hi], v[some], extra[some]) * scale)
            if np.abs(fixed).max() >= 2.0 ** (62 - _ID_BITS):
                raise ValueError("scores too large for the requested digits")
            # one integer per cell: rounded score first, then the smaller item id
            cell = (fixed.astype(np.int64) << _ID_BITS) - order[None, :]
            if threshold is not None:
                cell[fixed / scale < threshold] = np.iinfo(np.int64).min
            mine = slice(*np.searchsorted(hidden_row, [lo, hi]))
            inside = (hidden_col[mine] >= at) & (hidden_col[mine] < some.stop)
            cell[hidden_row[mine][inside] - lo, hidden_col[mine][inside] - at] = np.iinfo(np.int64).min
            best = np.argpartition(-(cell + 1), keep - 1, axis=1)[:, :keep]
            r, c = np.nonzero(np.take_along_axis(cell, best, axis=1) > np.iinfo(np.int64).min)
            out.append((r + lo, best[r, c] + at, fixed[r, best[r, c]] / scale))
    return out


def _centred(u, v):
    """Both about the mean of ``v``, and how far the subtraction can be off in a component."""
    middle = v.mean(axis=0)
    return u - middle, v - middle, 2.0 ** -50 * max(np.abs(u).max(), np.abs(v).max())


class _Bound:
    """Single-precision products that tell which cells cannot reach a score.

    A cell may hold ``score`` or more only where ``product(row, column) >= need(row, score)``; the slack covers all
    rounding (a sum of n products is off by less than n + 2 units of the last place times the vectors' lengths).
    """

    tile = 256, 1024  # rows and columns of a product, 1 MB

    def __init__(self, u, v, score):
        self.kind, width = score, u.shape[1]
        slack = (width + 8) * 2.0 ** -22
        if score == "euclidean":  # u.v - |v|^2 / 2 >= (|u|^2 - d^2) / 2, about the items' mean
            u, v, blur = _centred(u, v)
        self.square = (u * u).sum(axis=1)
        squares = (v * v).sum(axis=1)
        longest = math.sqrt(squares.max())
        self.slack = slack * np.sqrt(self.square) * longest
        if score == "euclidean":
            self.slack += slack * (squares.max() + self.square) + 2 * width * blur * (np.sqrt(self.square) + longest)
            u, v = np.c_[u, np.full(len(u), -1.0)], np.c_[v, squares / 2]
        self.u, self.v = u.astype(np.float32), v.astype(np.float32)

    def need(self, rows, score):
        least = score if self.kind != "euclidean" else (self.square[rows] - np.maximum(-score, 0.0) ** 2) / 2
        return (np.where(np.isfinite(score), least, -np.inf) - self.slack[rows]).astype(np.float32)

    def product(self, rows, columns, out):
        return np.matmul(self.u[rows], self.v[columns].T, out=out)


class _Distances(_Bound):
    """The same for sums of absolute differences."""

    tile = 64, 4096

    def __init__(self, u, v, _score):
        u, v, blur = _centred(u, v)
        self.slack = (u.shape[1] + 8) * 2.0 ** -22 * (np.abs(u).sum(axis=1) + np.abs(v).sum(axis=1).max()) + 2 * u.shape[1] * blur
        self.u, self.v = u.astype(np.float32), np.ascontiguousarray(v.T, dtype=np.float32)
        self.gap = np.empty(math.prod(self.tile), dtype=np.float32)

    def need(self, rows, score):
        return (score - self.slack[rows]).astype(np.float32)

    def product(self, rows, columns, out):
        u, gap = self.u[rows], self.gap[:out.size].reshape(out.shape)
        out[:] = 0
        for d in range(len(self.v)):
            np.subtract(self.v[d, columns], u[:, d, None], out=gap)
            np.subtract(out, np.abs(gap, out=gap), out=out)
        return out


def _cells(u, v, score):
    """Scores of single cells in double precision: row by row of two equally long tables."""
    if score == "euclidean":
        return -np.sqrt(((v - u) ** 2).sum(axis=1))
    if score == "manhattan":
        return -np.abs(v - u).sum(axis=1)
    return np.einsum("ij,ij->i", u, v)


def _sifted(u, v, extra, hidden, k, score, digits, threshold):
    """The same cells as :func:`_whole` gives, of finite vectors, scoring only those that can be among the best.

    Items come in the order of their ids, so a later cell has to beat the k-th score so far; a product in single
    precision rules out nearly all of them.
    """
    scale, out = 10.0 ** digits, []
    hidden = np.sort(hidden[0] * len(v) + hidden[1])
    bound = (_Distances if score == "manhattan" else _Bound)(u, v, score)
    tile, width = bound.tile
    products = np.empty(tile * width, dtype=np.float32)
    for lo in range(0, len(u), tile):
        part = slice(lo, min(lo + tile, len(u)))
        best = np.full((part.stop - lo, k), -np.inf)
        which = np.full(best.shape, -1)
        stop = 0
        while stop < len(v):
            # short steps first: they set the k-th scores for the long ones
            start, stop = stop, min(len(v), stop + min(_SIFT_STEP, max(64, stop)))
            floor = best[:, -1] if threshold is None else np.maximum(best[:, -1], math.floor(threshold * scale) - 1)
            need = bound.need(part, (floor - 1) / scale)
            hits = []
            for at in range(start, stop, width):
                some = slice(at, min(stop, at + width))
                near = bound.product(part, some, products[:len(best) * (some.stop - at)].reshape(len(best), -1))
                fit = np.flatnonzero(near.max(axis=1) >= need)
                found = np.nonzero(near[fit] >= need[fit, None])
                hits.append((fit[found[0]], found[1] + (at - start)))
            r, c = (np.concatenate(x) for x in zip(*hits))
            if len(r) * 8 > len(best) * (stop - start):
                fixed = np.rint(SCORES[score](u[part], v[start:stop], extra[start:stop]) * scale)[r, c]
            else:
                pieces = [slice(i, i + _SIFT_CELLS) for i in range(0, len(r), _SIFT_CELLS)]
                fixed = np.concatenate([np.empty(0), *[np.rint(_cells(u[r[p] + lo], v[c[p] + start], score) * scale) for p in pieces]])
            c += start
            ok = fixed > best[r, -1]
            if threshold is not None:
                ok &= fixed / scale >= threshold
            if len(hidden):
                key = (r + lo) * len(v) + c
                ok &= hidden[np.minimum(np.searchsorted(hidden, key), len(hidden) - 1)] != key
            r, c, fixed = r[ok], c[ok], fixed[ok]
            if not len(r):
                continue
            some = np.unique(r)
            r, c = np.concatenate([np.repeat(some, k), r]), np.concatenate([which[some].ravel(), c])
            fixed = np.concatenate([best[some].ravel(), fixed])
            order = np.lexsort((c, -fixed, r))
            nth = np.arange(len(r)) - np.searchsorted(r[order], r[order])
            order, nth = order[nth < k], nth[nth < k]
            best[r[order], nth], which[r[order], nth] = fixed[order], c[order]
        r, nth = np.nonzero(which >= 0)
        out.append((r + lo, which[r, nth], best[r, nth] / scale))
    return out


def _block_kernel(score, k, digits, threshold):
    """Best ``k`` cells per user of a block; rows of ``users`` with a ``seen`` item hold no vector but a pair to leave out."""
    def kernel(users: pa.Table, items: pa.Table) -> pa.Table:
        out = []
        pairs = users.filter(pc.is_valid(users.column("seen")))
        users = users.filter(pc.is_null(users.column("seen")))
        if len(users) and len(items):
            items = items.sort_by("item")
            ids = items.column("item").to_numpy()
            v, extra = _vectors(items, "vec"), items.column("extra").to_numpy()
            u, user_ids = _vectors(users, "vec"), users.column("user").to_numpy()
            if score == "cosine":
                u, v = _unit(u), _unit(v)
            seen = _seen_cells(user_ids, ids, pairs.column("user").to_numpy(), pairs.column("seen").to_numpy())
            sift = score in ("dot", "cosine", "euclidean", "manhattan")
            # what single precision cannot hold is scored whole
            good_u, good_v = ((np.abs(m).max(axis=1, initial=0.0) < _LARGEST) & sift for m in (u, v))
            every = np.arange(len(ids))
            for method, who, what in ((_whole, ~good_u, every), (_whole, good_u, np.flatnonzero(~good_v)),
                                      (_sifted, good_u, np.flatnonzero(good_v))):
                who = np.flatnonzero(who)
                if not len(who) or not len(what):
                    continue
                if len(who) == len(u) and len(what) == len(ids):  # the usual case, without copies
                    out += [(user_ids[r], ids[c], value) for r, c, value in method(u, v, extra, seen, k, score, digits, threshold)]
                    continue
                row, column = np.full(len(u), -1), np.full(len(ids), -1)
                row[who], column[what] = np.arange(len(who)), np.arange(len(what))
                hidden = row[seen[0]], column[seen[1]]
                inside = (hidden[0] >= 0) & (hidden[1] >= 0)
                found = method(u[who], v[what], extra[what], (hidden[0][inside], hidden[1][inside]), k, score, digits, threshold)
                out += [(user_ids[who[r]], ids[what[c]], value) for r, c, value in found]
        cat = lambda i, kind: np.concatenate([x[i] for x in out]) if out else np.array([], kind)
        return pa.table({"user": pa.array(cat(0, np.int64), pa.int64()),
                         "item": pa.array(cat(1, np.int64), pa.int64()),
                         "score": pa.array(cat(2, np.float64), pa.float64())})

    return kernel


def rows_of_block(items: DataFrame) -> int:
    """How many rows of ``vec`` make a block, by the first one's width."""
    first = items.select(F.size("vec").alias("n")).first()
    width = max(1, first["n"] or 1) if first else 1
    return max(MIN_BLOCK_ROWS, min(BLOCK_ROWS, BLOCK_BYTES // (8 * width)))


def block_counts(users: DataFrame, items: DataFrame, block_rows: int) -> tuple[int, int]:
    """Number of user and item blocks, see :func:`_numbers`."""
    return _numbers(users.count(), items.count(), users.sparkSession.sparkContext.defaultParallelism, block_rows)


def _numbers(n_users: int, n_items: int, cores: int, block_rows: int) -> tuple[int, int]:
    """Number of user and item blocks.

    Blocks are as large as allowed; only where that would leave cores idle, as on small
    tables, users are split further.
    """
    item_blocks = max(1, math.ceil(n_items / block_rows))
    split = min(math.ceil(3 * cores / item_blocks), math.ceil(n_users / min(MIN_BLOCK_ROWS, block_rows)))
    return max(1, math.ceil(n_users / block_rows), split), item_blocks


def _rounds(n_users: int, n_items: int, cores: int, n_user: int, n_item: int) -> list[range]:
    """User blocks by the round they are searched in: a round deals some ``ROUND_SHARE`` times the rows of both tables, or
    what keeps all cores at work."""
    dealt = n_items + n_item * n_users / n_user  # rows dealt for one user block
    size = max(1, math.ceil(3 * cores / n_item), int(ROUND_SHARE * (n_users + n_items) / max(1, dealt)))
    return [range(at, min(n_user, at + size)) for at in range(0, n_user, size)]


def _block_of(column: str, n: int):
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def with_seen(users: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Users and the pairs to leave out as rows of one table: the vectors are dealt once, without a join."""
    users = users.withColumn("seen", F.lit(None).cast("bigint"))
    if seen is None:
        return users
    pairs = seen.where("user IS NOT NULL AND item IS NOT NULL").withColumn("vec", F.lit(None).cast(users.schema["vec"].dataType))
    return users.unionByName(pairs.withColumn("seen", F.col("item").cast("bigint")).select(
        *[F.col(c).cast("bigint").alias(c) if c == "user" else F.col(c) for c in users.columns]))


def _search(users: DataFrame, items: DataFrame, seen: DataFrame | None, n_user: int, n_item: int, kernel, some: range) -> DataFrame:
    """What the kernel finds for the user blocks ``some`` in all items: (user, item, score)."""
    ub = _block_of("user", n_user)
    inside = F.lit(True) if len(some) == n_user else ub.between(some.start, some.stop - 1)
    left = users.where(inside).select("user", F.col("vec").alias("vec"), ub.alias("ub"),
                                      F.explode(F.sequence(F.lit(0), F.lit(n_item - 1))).alias("ib"))
    # a pair to leave out goes to the one block of its item
    left = with_seen(left, None if seen is None else seen.where(inside).select(
        "user", "item", ub.alias("ub"), _block_of("item", n_item).alias("ib")))
    right = items.select("item", F.col("vec").alias("vec"), F.col("extra").cast("double").alias("extra"),
                         _block_of("item", n_item).alias("ib"),
                         F.explode(F.sequence(F.lit(some.start), F.lit(some.stop - 1))).alias("ub"))
    return (left.groupBy("ub", "ib").cogroup(right.groupBy("ub", "ib"))
            .applyInArrow(_arrow_wrapper(kernel), "user bigint, item bigint, score double"))


def block_best(users: DataFrame, items: DataFrame, k: int, score="cosine", seen=None,
               digits=9, threshold=None, block_rows=None) -> DataFrame:
    """Rows (user, item, score) among which are the best ``k`` items of every user, see :func:`block_top_k`; in one round."""
    if "extra" not in items.columns:
        items = items.withColumn("extra", F.lit(0.0))
    n_user, n_item = block_counts(users, items, block_rows or rows_of_block(items))
    return _search(users, items, seen, n_user, n_item, _block_kernel(score, k, digits, threshold), range(n_user))


def block_top_k(users: DataFrame, items: DataFrame, k: int, score="cosine", seen=None,
                digits=9, threshold=None, block_rows=None) -> DataFrame:
    """Best ``k`` items per user: columns (user, item, score, rank).

    ``users`` holds (user, vec), ``items`` (item, vec[, extra]); ``seen`` optional (user,
    item) pairs to leave out.  Ids are unique bigints.  Scores are compared after rounding
    to ``digits`` decimals, ties by the smaller item id, so that the last bit of a float
    sum cannot change a ranking.  ``threshold`` drops lower scores before ranking.  Both
    tables are counted before they are read: store them first if they are costly.

    Copies grow with the product of both tables, so large ones are searched in rounds of user
    blocks: the copies of a round are gone before the next one's are made.
    """
    if "extra" not in items.columns:
        items = items.withColumn("extra", F.lit(0.0))
    n_users, n_items, cores = users.count(), items.count(), users.sparkSession.sparkContext.defaultParallelism
    n_user, n_item = _numbers(n_users, n_items, cores, block_rows or rows_of_block(items))
    rounds = _rounds(n_users, n_items, cores, n_user, n_item)
    if len(rounds) > 1:  # each round reads the tables again
        users, items = stored(users.select("user", "vec"), "users"), stored(items.select("item", "vec", "extra"), "items")
        seen = None if seen is None else stored(seen.select("user", "item"), "seen")
    kernel, order = _block_kernel(score, k, digits, threshold), [F.desc("score"), F.asc("item")]
    found = [top_k(_search(users, items, seen, n_user, n_item, kernel, some), ["user"], order, k) for some in rounds]
    return found[0] if len(found) == 1 else reduce(DataFrame.unionByName, [cut(f) for f in found])


def _arrow_wrapper(kernel):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return kernel(left, right)
    return run
