"""Problem 3: the k most similar vectors of every vector.

Method: hierarchical k-means tree with best-bin-first traversal. The upper levels are fitted on a
bounded sample (``SAMPLE`` rows, spread over all rows by a hash of the key); every row is indexed. A
query takes the branches from a priority queue, ordered by the similarity that a leaf of the branch is
likely to reach (``SLACK`` of the branch's mean spread nearer than its centre), opens the first,
scores its leaves, and goes on while an unopened branch has a higher priority than the last of the
``visits`` best leaves; only leaves of opened branches are ever scored. A leaf with more than
``SPLIT`` vectors is divided further by the task that holds it, with a level of its own and visits
calibrated there. The number of visits is widened until the recall that brute force against all rows
measures on held-out calibration queries reaches the target.

Scale: the upper tree is bounded by ``MAX_LEAVES`` centres (8 MB) and goes to the tasks as a
broadcast. Neighbouring leaves form blocks of at most ``BLOCK`` vectors; a leaf that is larger by
itself is divided by a hash. A vector asks within the block where it lives at no cost and travels once
to each other block in which it visits leaves, not once per leaf; a block that about ``ASKS`` queries
reach is copied, each copy answering a part of them. Equal vectors are one point with at most k + 1
smallest keys, so any number of copies costs one point; the exact answer of the others follows from it.

Defined cases: vectors that are null, of another length, all zero or with a non-finite or null
element take no part; repeated rows count once (of different vectors under one key one is kept);
cosines are compared after rounding to 6 digits and equal ones are ranked by the smaller key; fewer
than k neighbours give fewer rows; an empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumix.storage import written

from .common import list_array, map_arrow

SAMPLE, MAX_LEAVES, LEAF, BLOCK = 60_000, 15_000, 128, 40_000
SPLIT, ASKS = 1024, 200_000
SLACK = 0.25
DIGITS = 6
CALIBRATION = 1000
WIDEN = 1.5  # the queries that calibrate are a sample, so their need is widened


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centres and the assignment."""
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        empty = np.bincount(own, minlength=k) == 0
        sums[empty] = x[rng.integers(len(x), size=int(empty.sum()))]
        centres = _unit(sums).astype(np.float32)
    return centres, np.argmax(x @ centres.T, axis=1)


def _chain(centres: np.ndarray) -> np.ndarray:
    """Centres in an order in which each is followed by the nearest one left."""
    sims, at, order = centres @ centres.T, 0, [0]
    left = np.ones(len(centres), bool)
    left[0] = False
    while left.any():
        at = int(np.argmax(np.where(left, sims[at], -np.inf)))
        left[at] = False
        order.append(at)
    return np.array(order)


class Tree:
    """Two levels of unit centres: branches, neighbours in sequence, and the leaves of each branch."""

    def __init__(self, x: np.ndarray, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        leaves = int(np.clip(rows // LEAF, 1, min(MAX_LEAVES, max(1, len(x) // 4))))
        k = max(1, int(round(np.sqrt(leaves))))
        branches, own = _kmeans(x, k, rng)
        order = _chain(branches)
        self.branches = branches[order]
        parts, self.first = [], [0]
        for b in order:
            mine = x[own == b]
            if not len(mine):
                mine = branches[b : b + 1]
            parts.append(_kmeans(mine, int(np.clip(round(leaves * len(mine) / len(x)), 1, len(mine))), rng)[0])
            self.first.append(self.first[-1] + len(parts[-1]))
        self.leaves = np.concatenate(parts)
        self.first = np.array(self.first)
        self.branch_of = np.repeat(np.arange(k), np.diff(self.first))
        to_own = np.arccos(np.clip(np.einsum("ij,ij->i", self.leaves, self.branches[self.branch_of]), -1, 1))
        self.spread = (np.bincount(self.branch_of, to_own, k) / np.diff(self.first)).astype(np.float32)
        self.scored = 0  # leaves that were compared with a query so far

    def priorities(self, q: np.ndarray) -> np.ndarray:
        """Of each branch for each query."""
        angle = np.arccos(np.clip(q @ self.branches.T, -1, 1)) - SLACK * self.spread
        return np.cos(np.maximum(angle, 0)).astype(np.float32)

    @staticmethod
    def reached(sims: np.ndarray, priority: np.ndarray) -> np.ndarray:
        """When a leaf is taken from the queue: as soon as its branch and itself are the best of it, equal ones by themselves."""
        return np.minimum(sims, priority) + 1e-7 * sims.astype(np.float64)

    def leaf(self, q: np.ndarray) -> np.ndarray:
        """The leaf of each row: the first that the traversal reaches."""
        return self.visit(q, 1)[:, 0]

    def visit(self, q: np.ndarray, visits: int) -> np.ndarray:
        """Best-bin-first: ids of the ``visits`` leaves that each query reaches, best first.

        Queries advance together: in each round every query that is not done opens the next branch of
        its queue; those that open the same branch are compared with its leaves in one product.
        """
        visits, k = min(visits, len(self.leaves)), len(self.branches)
        out = np.empty((len(q), visits), np.int32)
        for a in range(0, len(q), 2048):
            part = q[a : a + 2048]
            priority = self.priorities(part)
            queue = np.argsort(-priority, axis=1)
            best = np.full((len(part), visits), -np.inf)
            ids = np.zeros((len(part), visits), np.int32)
            live = np.arange(len(part))
            for step in range(k):
                taken = queue[live, step]
                for b in np.unique(taken):
                    rows = live[taken == b]
                    sims = part[rows] @ self.leaves[self.first[b] : self.first[b + 1]].T
                    self.scored += sims.size
                    both = np.concatenate([best[rows], self.reached(sims, priority[rows, b : b + 1])], axis=1)
                    names = np.concatenate([ids[rows], np.broadcast_to(np.arange(self.first[b], self.first[b + 1], dtype=np.int32), sims.shape)], axis=1)
                    top = np.argpartition(-both, visits - 1, axis=1)[:, :visits]
                    best[rows], ids[rows] = np.take_along_axis(both, top, axis=1), np.take_along_axis(names, top, axis=1)
                if step + 1 == k:
                    break
                live = live[priority[live, queue[live, step + 1]] > best[live].min(axis=1)]
                if not len(live):
                    break
            out[a : a + len(part)] = np.take_along_axis(ids, np.argsort(-best, axis=1, kind="stable"), axis=1)
        return out

    def places(self, q: np.ndarray) -> np.ndarray:
        """For each query and leaf how many visits it takes until the leaf is reached; for the few queries of the calibration."""
        order = np.argsort(-self.reached(q @ self.leaves.T, self.priorities(q)[:, self.branch_of]), axis=1, kind="stable")
        place = np.empty(order.shape, np.int32)
        np.put_along_axis(place, order, np.arange(1, order.shape[1] + 1, dtype=np.int32)[None, :], axis=1)
        return place


def _needed(places: np.ndarray, target: float) -> int:
    """Visits that reach the target share of the places, widened."""
    at = np.sort(places)
    return int(np.ceil(WIDEN * at[min(len(at) - 1, int(np.ceil(target * len(at))))])) + 1


def _inner(x: np.ndarray, asked: np.ndarray, mine: np.ndarray, k: int, target: float):
    """(queries, rows to compare them with) within one leaf: all of it, or the inner leaves that each query visits."""
    if len(mine) <= SPLIT:
        yield asked, mine
        return
    rng = np.random.default_rng(13)
    some = mine[rng.permutation(len(mine))[: 64 * LEAF]]
    centres = _kmeans(x[some], max(2, min(len(mine) // LEAF, len(some) // 4)), rng, 4)[0]
    home = np.concatenate([np.argmax(x[mine[a : a + 4096]] @ centres.T, axis=1) for a in range(0, len(mine), 4096)])
    tried = some[:64]
    sims = x[tried] @ x[mine].T
    sims[sims > 1 - 1e-6] = -2
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    to_centre = x[tried] @ centres.T
    rank = np.take_along_axis(np.argsort(np.argsort(-to_centre, axis=1, kind="stable"), axis=1), home[near], axis=1) + 1
    visits = min(len(centres), _needed(rank.ravel(), target))
    for a in range(0, len(asked), 4096):
        part = asked[a : a + 4096]
        seen = np.argpartition(-(x[part] @ centres.T), visits - 1, axis=1)[:, :visits]
        who = np.repeat(part, visits)[np.argsort(seen.ravel(), kind="stable")]
        leaf = np.sort(seen.ravel(), kind="stable")
        for c in np.unique(leaf):
            yield who[np.searchsorted(leaf, c) : np.searchsorted(leaf, c, side="right")], mine[home == c]


def usable(df: DataFrame, keys: list[str], vector: str, dim: int) -> DataFrame:
    """(key, pid, vec) of the rows that take part: pid is a hash of the unit vector, vec its float32 bytes.

    Of equal vectors in one task only the first carries vec, so that no hot vector is sent around.
    """
    kinds = dict(df.dtypes)
    schema = "key struct<" + ",".join(f"{k}:{kinds[k]}" for k in keys) + ">, pid bigint, vec binary"

    def work(cols: dict) -> dict:
        col = cols[vector]
        sizes = np.asarray(pc.fill_null(pc.list_value_length(col), 0))
        fit = np.flatnonzero(sizes == dim)
        x = np.asarray(pc.fill_null(col.take(pa.array(fit)).flatten().cast(pa.float64()), float("nan"))).reshape(-1, dim)
        good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
        raw = np.ascontiguousarray(_unit(x[good] / np.abs(x[good]).max(axis=1, keepdims=True)).astype(np.float32)).tobytes()
        vecs = [raw[i : i + 4 * dim] for i in range(0, len(raw), 4 * dim)]
        pids = [xxhash.xxh64_intdigest(v) - 2**63 for v in vecs]
        seen: set[int] = set()
        once = [None if p in seen or seen.add(p) else v for p, v in zip(pids, vecs)]
        rows = pa.array(fit[good])
        key = pa.StructArray.from_arrays([cols[k].take(rows) for k in keys], names=keys)
        return {"key": key, "pid": pids, "vec": once}

    return map_arrow(df.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys)), [*keys, vector], schema, work, 20_000)


def _matrix(col, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(col), np.float32).reshape(-1, dim)


def _first_keys(members: DataFrame, k: int) -> DataFrame:
    """(pid, first: the k + 1 smallest keys with that vector); a hot vector is cut down by salt first."""
    salted = members.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(64)))
    few = salted.withColumn("r", F.row_number().over(Window.partitionBy("pid", "salt").orderBy("key"))).filter(F.col("r") <= k + 1)
    return few.groupBy("pid").agg(F.slice(F.array_sort(F.collect_list("key")), 1, k + 1).alias("first"))


def _blocks(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each leaf: leaves in sequence share a block up to ``most`` rows."""
    first, parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    at, held = -1, most
    for leaf, size in enumerate(sizes.tolist()):
        if size > most:
            first[leaf], parts[leaf] = at + 1, -(-size // most)
            at, held = at + int(parts[leaf]), most
            continue
        if held + size > most:
            at, held = at + 1, 0
        first[leaf] = at
        held += size
    return first, parts


def _asked_blocks(seen: np.ndarray, first: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, leaf, block) for each leaf that a query visits; all parts of a divided leaf."""
    who, leaf = np.repeat(np.arange(len(seen)), seen.shape[1]), seen.ravel()
    m = parts[leaf]
    at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
    return np.repeat(who, m), np.repeat(leaf, m), np.repeat(first[leaf], m) + at


def _calibrated(vectors: DataFrame, tree, q: np.ndarray, floor: np.ndarray, k: int, dim: int, least: float | None, target: float) -> int:
    """Smallest number of visits that reaches the target recall of brute force against all rows.

    ``floor`` is the k-th best similarity of each query within the tree's sample; only rows that reach
    it are returned, at most k of a task, so that their number does not grow with the tasks.
    """

    def brute(batches):
        best = np.full((len(q), k), -2.0, np.float32)
        leaf = np.zeros((len(q), k), np.int32)
        for batch in batches:
            y = _matrix(batch.column(0).to_pylist(), dim)
            for a in range(0, len(y), 4096):
                part = y[a : a + 4096]
                sims = q @ part.T
                sims[(sims > 1 - 1e-6) | (sims < floor[:, None])] = -2  # itself and equal vectors; those that can't be among the k best
                row, col = np.nonzero(sims > -2)
                if not len(row):
                    continue
                some = np.unique(col)
                homes = np.zeros(len(part), np.int32)
                homes[some] = tree.value.leaf(part[some])
                both = np.concatenate([best, sims], axis=1)
                names = np.concatenate([leaf, np.broadcast_to(homes, sims.shape)], axis=1)
                top = np.argpartition(-both, k - 1, axis=1)[:, :k]
                best, leaf = np.take_along_axis(both, top, axis=1), np.take_along_axis(names, top, axis=1)
        i, j = np.nonzero(best > -2)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(best[i, j].astype(np.float64)), pa.array(leaf[i, j])], names=["q", "sim", "leaf"])

    found = vectors.select("vec").mapInArrow(brute, "q int, sim double, leaf int")
    top = found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("sim"), "leaf"))).filter(F.col("r") <= k)
    rows = top.collect()  # at most CALIBRATION * k
    # where no query has a neighbour that counts, its nearest one stands for it
    counted = [r for r in rows if least is None or r.sim >= least] or [r for r in rows if r.r == 1]
    if not counted:
        return len(tree.value.leaves)
    place = tree.value.places(q)
    return _needed(np.array([place[r.q, r.leaf] for r in counted]), target)


def neighbours(df: DataFrame, keys: list[str], vector: str = "embedding", dim: int = 128, k: int = 5, least: float | None = None, target: float = 0.95, queries: str | None = None) -> DataFrame:
    """(key columns, nb_ key columns, rank, cosine): the k most similar rows of each query row.

    ``least`` bounds the cosine from below, so that only leaves that hold such neighbours are
    calibrated for; ``queries`` is a condition on ``key``, all rows being asked by default.
    """
    spark = df.sparkSession
    kept = written(usable(df, keys, vector, dim), "vectors")
    members = written(kept.groupBy("key").agg(F.min("pid").alias("pid")), "members")
    vectors = kept.filter("vec IS NOT NULL").select("pid", "vec")
    n = vectors.count()
    if not n:
        return members.select("key.*", *[F.col(f"key.{c}").alias(f"nb_{c}") for c in keys], F.lit(1).alias("rank"), F.lit(0.0).alias("cosine")).limit(0)
    take = min(SAMPLE, max(12_000, n // 20))
    rate = min(1.0, 1.1 * (take + CALIBRATION) / n)
    slot = F.pmod(F.xxhash64("pid"), F.lit(1_000_000))
    sample = vectors.filter(slot <= int(rate * 1_000_000)).select("vec").distinct().limit(take + CALIBRATION).collect()  # at most SAMPLE and the calibration queries
    x = _matrix([r.vec for r in sample] or [vectors.first().vec], dim)
    held = min(CALIBRATION, len(x) // 8)  # rows that ask in the calibration take no part in the fit
    q, x = (x[:held], x[held:]) if held else (x, x)
    tree = Tree(x, n)
    shared = spark.sparkContext.broadcast(tree)
    within = q @ x.T
    within[within > 1 - 1e-6] = -2
    floor = -np.partition(-within, min(k, within.shape[1]) - 1, axis=1)[:, min(k, within.shape[1]) - 1] - 1e-5 if len(x) > k else np.full(len(q), -1.5)
    visits = min(len(tree.leaves), _calibrated(vectors, shared, q, floor.astype(np.float32), k, dim, least, target))

    def count(cols: dict) -> dict:
        leaf, size = np.unique(shared.value.leaf(_matrix(cols["vec"].to_pylist(), dim)), return_counts=True)
        return {"leaf": leaf.astype(np.int32), "size": size.astype(np.int64)}

    sizes = np.zeros(len(tree.leaves), np.int64)
    for r in map_arrow(vectors, ["vec"], "leaf int, size bigint", count, 20_000).groupBy("leaf").agg(F.sum("size").alias("size")).collect():  # at most MAX_LEAVES
        sizes[r.leaf] = r["size"]
    block_of, parts = _blocks(sizes, int(np.clip(n // 8, 2000, BLOCK)))
    # about how many queries reach each block, from the sample: blocks of many are copied
    who, _, block = _asked_blocks(tree.visit(x, visits), block_of, parts)
    n_blocks = int((block_of + parts).max())
    asks_of = np.bincount(np.unique(who * n_blocks + block) % n_blocks, minlength=n_blocks) * (n / len(x))
    copies = np.maximum(1, np.ceil(asks_of / ASKS)).astype(np.int64)
    cell_of = np.cumsum(copies) - copies
    n_cells = int(copies.sum())

    def spread(cols: dict) -> dict:
        """A row where each vector lives, with the leaves it asks there, and one for every other block that it asks."""
        t = shared.value
        pid = np.asarray(cols["pid"])
        hashed = pid.view(np.uint64)
        x = _matrix(cols["vec"].to_pylist(), dim)
        home = t.leaf(x)
        asks = np.flatnonzero(np.asarray(cols["asks"]))
        who, leaf, block = _asked_blocks(t.visit(x[asks], visits), block_of, parts)
        who = asks[who]
        ask_key = who * n_cells + cell_of[block] + (hashed[who] // np.uint64(7) % copies[block].astype(np.uint64)).astype(np.int64)
        here = block_of[home] + (hashed % parts[home].astype(np.uint64)).astype(np.int64)
        m = copies[here]
        owner = np.repeat(np.arange(len(pid)), m)
        own_key = owner * n_cells + np.repeat(cell_of[here], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        order = np.argsort(ask_key, kind="stable")
        ask_key, leaf = ask_key[order], leaf[order]
        rows = np.union1d(ask_key, own_key)
        lives = np.full(len(rows), -1, np.int32)
        lives[np.searchsorted(rows, own_key)] = home[owner]
        ends = np.searchsorted(ask_key, rows, side="right")
        row = pa.array(rows // n_cells)
        return {"cell": (rows % n_cells).astype(np.int32), "pid": cols["pid"].take(row), "vec": cols["vec"].take(row), "leaf": lives, "leaves": list_array(np.r_[0, ends], leaf, pa.int32())}

    if queries:
        asking = vectors.join(members.filter(queries).select("pid").distinct().withColumn("asks", F.lit(True)), "pid", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    else:
        asking = vectors.withColumn("asks", F.lit(True))
    placed = map_arrow(asking, ["pid", "vec", "asks"], "cell int, pid bigint, vec binary, leaf int, leaves array<int>", spread)

    def answer(table: pa.Table) -> pa.Table:
        pid, leaf = np.asarray(table["pid"]), np.asarray(table["leaf"])
        x = _matrix(table["vec"].to_pylist(), dim)
        lists = table["leaves"].combine_chunks()
        row = np.repeat(np.arange(len(pid)), np.asarray(pc.list_value_length(lists)))
        asked = np.asarray(lists.flatten())
        base = np.flatnonzero(leaf >= 0)
        base = base[np.unique(pid[base], return_index=True)[1]]  # equal vectors of several tasks
        base = base[np.argsort(leaf[base], kind="stable")]
        at_leaf = leaf[base]
        order = np.lexsort((pid[row], asked))
        asked, row = asked[order], row[order]
        # rows of one vector that came from several tasks ask once
        once = np.r_[True, (asked[1:] != asked[:-1]) | (pid[row][1:] != pid[row][:-1])][: len(asked)]
        asked, row = asked[once], row[once]
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for at in np.flatnonzero(np.r_[True, asked[1:] != asked[:-1]]) if len(asked) else ():
            lf = asked[at]
            whole = base[np.searchsorted(at_leaf, lf) : np.searchsorted(at_leaf, lf, side="right")]
            for rows, mine in _inner(x, row[at : np.searchsorted(asked, lf, side="right")], whole, k, target):
                for c in range(0, len(rows) if len(mine) else 0, 2048):
                    r = rows[c : c + 2048]
                    sims = x[r] @ x[mine].T
                    sims[pid[r][:, None] == pid[mine][None, :]] = -3
                    near = sims > -2
                    if len(mine) > k:  # all that may tie with the k-th stay, so that rounding can't lose the smaller key
                        near &= sims >= -np.partition(-sims, k - 1, axis=1)[:, k - 1 : k] - 2 * 10.0**-DIGITS
                    if least is not None:
                        near &= sims >= least - 1e-4
                    i, j = np.nonzero(near)
                    exact = np.einsum("ij,ij->i", x[r[i]].astype(np.float64), x[mine[j]].astype(np.float64))
                    out.append((pid[r[i]], pid[mine[j]], np.round(exact, DIGITS)))
        a, b, cosine = (np.concatenate(c) for c in zip(*out))
        order = np.lexsort((-cosine, a))
        a, b, cosine = a[order], b[order], cosine[order]
        start = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])[np.cumsum(np.r_[True, a[1:] != a[:-1]]) - 1] if len(a) else np.zeros(0, np.int64)
        kth = cosine[np.minimum(start + k - 1, len(a) - 1)]
        keep = (np.arange(len(a)) - start < k) | ((cosine == kth) & (a[np.minimum(start + k - 1, len(a) - 1)] == a)) if len(a) else np.zeros(0, bool)
        return pa.table({"pid": a[keep], "nb": b[keep], "cosine": cosine[keep]})

    found = placed.groupBy("cell").applyInArrow(answer, "pid bigint, nb bigint, cosine double")
    if least is not None:
        found = found.filter(F.col("cosine") >= least)
    # every vector stands for its k + 1 smallest keys; equal keys of the query's own vector are neighbours too
    first = written(_first_keys(members, k), "first")
    same = first.filter(F.size("first") > 1).select("pid", F.col("pid").alias("nb"), F.lit(1.0).alias("cosine"))
    lists = found.unionByName(same).distinct().join(first.withColumnRenamed("pid", "nb"), "nb").select("pid", "cosine", F.explode("first").alias("nb"))
    best = lists.withColumn("r", F.row_number().over(Window.partitionBy("pid").orderBy(F.desc("cosine"), "nb"))).filter(F.col("r") <= k + 1)
    asked = members.filter(queries) if queries else members
    joined = asked.join(best, "pid").filter(F.col("key") != F.col("nb"))
    ranked = joined.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("r"))).filter(F.col("rank") <= k)
    return ranked.select("key.*", *[F.col(f"nb.{c}").alias(f"nb_{c}") for c in keys], "rank", "cosine")


def close_pairs(df: DataFrame, keys: list[str], vector: str = "embedding", dim: int = 128, k: int = 5, least: float = 0.8, target: float = 0.999) -> DataFrame:
    """Unordered pairs, smaller key first, of which one is among the other's k nearest with cosine >= ``least``."""
    near = neighbours(df, keys, vector, dim, k, least, target)
    a, b = F.struct(*[F.col(c) for c in keys]), F.struct(*[F.col(f"nb_{c}").alias(c) for c in keys])
    return near.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
