"""Problem 2: near-duplicate texts with small edits, found without comparing all pairs.

Method: meet-in-the-middle ball hashing. A text's fingerprint is a row of ``SLOTS`` minima of hashed
word sequences. The distance of two fingerprints is the number of slot values to take out of one and
put into the other, and those within the radius 2 * (SLOTS - MEET) are sought. Every fingerprint
emits all its variants within half the radius - the SLOTS - MEET removals that leave MEET slots - so
two fingerprints share a variant exactly if they lie within the radius of each other. Variants are
shuffled; colliding pairs are sifted by 128 one-bit minima that travel with them, made distinct, and
verified by exact similarity.

Slots are taken over five-word sequences, which unrelated texts share far less than the three-word
sequences of the similarity; texts of few distinct sequences use three-word ones. Both families
overlap so far that of two texts with similarity >= 0.6 at least one family holds both. Where the texts
differ by replaced words, a pair at 0.6 exactly is found with a probability above 0.98 and one at 0.65
with 0.995; by scattered inserted or deleted words, which leave fewer five-word sequences at the same
similarity (0.38 at 0.6), with 0.973 and 0.991. At 0.8 it is 0.9999 in both cases. No exact way follows
for pairs that share no variant.

Scale: texts with equal sets of sequences become one class first, so copies meet once however many
there are; hashes, never texts, go through the wide shuffle, and each variant bucket is joined by
sort-merge (no list of a bucket is built, AQE splits skewed ones). Candidate pairs are verified in
cells: the classes are dealt into groups of about ``CELL``, a cell holds the pairs of two groups, and
a text is sent once to each cell in which it has a pair, not once for each pair. ``groups`` needs no
list of all pairs: each variant bucket is first tied to one representative, and only members that are
still in different groups are compared with each other afterwards.

Defined cases: null texts and texts of fewer than three words form no pair; null ids are dropped;
repeated rows count once; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumix.storage import written

from .common import U64, list_array, map_arrow, mix64

SLOTS, MEET = 12, 2
SIFT_BITS = 42  # of 128; at similarity 0.6 the mean is 25.6, the deviation 4.5
SMALL, LARGE = 62, 37  # distinct three-word sequences: fewer than SMALL -> family 3, at least LARGE -> family 5
WORD = re.compile(r"[^\W_]+")
SIMILARITY = (3, 5)  # 0.6 as a fraction
CELL = 2000  # classes of a group; a cell has texts of at most about twice as many
_ODD = mix64(np.arange(1, 400, dtype=U64)) | U64(1)


class _Words(dict):
    """Hash of each word, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _sequences(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the distinct sequences of k words, sorted."""
    if len(words) < k:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        h = sum(words[i : len(words) - k + 1 + i] * _ODD[i] for i in range(k))
    return np.unique(mix64(h))


def _minima(sets: list[np.ndarray], seeds: range) -> np.ndarray:
    """A row for each set (none empty), a column for each seed."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), len(seeds)), U64)
    with np.errstate(over="ignore"):
        for k, seed in enumerate(seeds):
            out[:, k] = np.minimum.reduceat((flat ^ (flat >> U64(31))) * _ODD[seed] + _ODD[seed + 1], starts)
    return out


def _print_batch(texts: list[str | None], memo: dict) -> dict:
    threes, fives = [], []
    for t in texts:
        words = np.array([memo[w] for w in WORD.findall((t or "").lower())], dtype=U64)
        threes.append(_sequences(words, 3))
        fives.append(_sequences(words, 5))
    size = np.array([len(s) for s in threes])
    n = len(texts)
    out = {"n": size.astype(np.int32), "c1": np.zeros(n, np.int64), "c2": np.zeros(n, np.int64), "s1": np.zeros(n, np.int64), "s2": np.zeros(n, np.int64)}
    some = np.flatnonzero(size > 0)
    if len(some):
        sets = [threes[i] for i in some]
        bits = (mix64(_minima(sets, range(128))) & U64(1)).astype(bool)
        packed = np.packbits(bits, axis=1).view(np.int64)
        out["s1"][some], out["s2"][some] = packed[:, 0], packed[:, 1]
        with np.errstate(over="ignore"):
            out["c1"][some] = [int(np.add.reduce(mix64(s)).view(np.int64)) for s in sets]
            out["c2"][some] = [int(np.bitwise_xor.reduce(mix64(s + U64(77))).view(np.int64)) for s in sets]
    for name, family, pick in (("f3", threes, (size > 0) & (size < SMALL)), ("f5", fives, size >= LARGE)):
        own = np.flatnonzero(pick & (np.array([len(s) for s in family]) > 0)) if n else []
        counts = np.zeros(n + 1, np.int64)
        values = np.zeros(0, np.int64)
        if len(own):
            counts[np.asarray(own) + 1] = SLOTS
            values = _minima([family[i] for i in own], range(200, 200 + SLOTS)).view(np.int64).ravel()
        out[name] = list_array(np.cumsum(counts), values, pa.int64())
    return out


def prints(df: DataFrame, id_col: str = "id", text: str = "preview") -> DataFrame:
    """(id, n, c1, c2, s1, s2, f3, f5): size and identity of the set of sequences, sift bits, slots by family."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text")).filter(F.col("id").isNotNull())
    memo = _Words()

    def work(cols: dict) -> dict:
        return {"id": cols["id"]} | _print_batch(cols["text"].to_pylist(), memo)

    return map_arrow(rows, ["id", "text"], "id bigint, n int, c1 bigint, c2 bigint, s1 bigint, s2 bigint, f3 array<bigint>, f5 array<bigint>", work, 1000).filter("n > 0")


def _variants(classes: DataFrame) -> DataFrame:
    pairs = ", ".join(f"named_struct('i', {i}, 'j', {j})" for i in range(SLOTS) for j in range(i + 1, SLOTS))
    keys = [F.expr(f"CASE WHEN size({f}) > 0 THEN transform(array({pairs}), v -> xxhash64({k}, v.i, v.j, {f}[v.i], {f}[v.j])) ELSE array() END") for k, f in ((3, "f3"), (5, "f5"))]
    return classes.select("rep", "s1", "s2", F.explode_outer(F.concat(*keys)).alias("key")).filter("key IS NOT NULL")


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * SIMILARITY[1] >= (len(a) + len(b) - both) * SIMILARITY[0] and both > 0


def _classes(df: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(classes of texts with equal sets: rep and its prints), (members: id, rep)."""
    own = written(prints(df, id_col, text), "prints")
    classes = own.groupBy("c1", "c2", "n").agg(F.min("id").alias("rep"), F.min_by(F.struct("s1", "s2", "f3", "f5"), "id").alias("p"))
    classes = written(classes.select("c1", "c2", "n", "rep", "p.*"), "classes")
    members = own.select("id", "c1", "c2", "n").join(classes.select("c1", "c2", "n", "rep"), ["c1", "c2", "n"]).select("id", "rep").distinct()
    return classes, written(members, "members")


SIFT = f"bit_count(a1 ^ b1) + bit_count(a2 ^ b2) <= {SIFT_BITS}"


def _side(v: DataFrame, x: str, *more: str) -> DataFrame:
    return v.select("key", F.col("rep").alias(f"rep_{x}"), F.col("s1").alias(f"{x}1"), F.col("s2").alias(f"{x}2"), *[F.col(c).alias(f"{c}_{x}") for c in more])


def _verified(df: DataFrame, id_col: str, text: str, pairs: DataFrame, n_classes: int) -> DataFrame:
    """Those of the written ``pairs`` (rep_a, rep_b) whose texts are similar.

    Rows of a cell, its texts before its pairs, stand in sequence in one partition and are worked off as
    they come.
    """
    spark = df.sparkSession
    deal = lambda c: F.pmod(F.xxhash64(F.lit(5), c), F.lit(max(1, n_classes // CELL))).cast("int")
    placed = pairs.select("rep_a", "rep_b", deal("rep_a").alias("u"), deal("rep_b").alias("v"))
    needed = placed.select(F.explode(F.array("rep_a", "rep_b")).alias("id"), "u", "v").distinct()
    texts = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text")).join(needed.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])
    sent = needed.join(texts, "id").select("u", "v", F.col("id").alias("rep_a"), F.lit(None).cast("bigint").alias("rep_b"), "text")
    both = sent.unionByName(placed.withColumn("text", F.lit(None).cast("string")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(parts, "u", "v").sortWithinPartitions("u", "v", F.col("rep_b").asc_nulls_first()).select("u", "v", "rep_a", "rep_b", "text")

    def verify(batches):
        memo, cell, held = _Words(), None, {}
        for whole in batches:
            found: list[tuple[int, int]] = []
            for u, v, a, b, t in zip(*(c.to_pylist() for c in whole.columns)):
                if (u, v) != cell:
                    cell, held = (u, v), {}
                if b is None:
                    held[a] = _sequences(np.array([memo[w] for w in WORD.findall(t.lower())], dtype=U64), 3)
                elif _similar(held[a], held[b]):
                    found.append((a, b))
            x, y = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["rep_a", "rep_b"])

    return dealt.mapInArrow(verify, "rep_a bigint, rep_b bigint")


def class_links(df: DataFrame, id_col: str = "id", text: str = "preview") -> tuple[DataFrame, DataFrame]:
    """(members: id, rep) of all texts with a sequence, and (links: rep_a, rep_b), rep_a < rep_b, between similar classes."""
    classes, members = _classes(df, id_col, text)
    v = _variants(classes)
    near = _side(v, "a").join(_side(v, "b"), "key").filter(f"rep_a < rep_b AND {SIFT}")
    pairs = written(near.select("rep_a", "rep_b").distinct(), "pairs")
    return members, written(_verified(df, id_col, text, pairs, classes.count()), "links")


def similar_pairs(df: DataFrame, id_col: str = "id", text: str = "preview") -> DataFrame:
    """(id_a, id_b), id_a < id_b: all pairs of rows with similarity >= 0.6, copies expanded."""
    members, links = class_links(df, id_col, text)
    several = members.groupBy("rep").count().filter("count > 1")
    all_links = links.unionByName(several.select(F.col("rep").alias("rep_a"), F.col("rep").alias("rep_b")))
    a, b = members.select(F.col("id").alias("x"), F.col("rep").alias("rep_a")), members.select(F.col("id").alias("y"), F.col("rep").alias("rep_b"))
    pairs = all_links.join(a, "rep_a").join(b, "rep_b").filter("rep_a <> rep_b OR x < y").filter("x <> y")
    return pairs.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root): smallest node of each connected component; edges (a, b), nodes (node).

    Neighbours' smallest labels spread, and labels are followed to their own label (pointer jumping),
    until nothing changes; each round is a written table, and only the number of changes is sent back.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = written(nodes.select("node", F.col("node").alias("root")), "label")
    while True:
        spread = both.join(label, both.b == label.node).groupBy("a").agg(F.min("root").alias("low"))
        lower = label.join(spread, label.node == spread.a, "left").select("node", F.col("root").alias("old"), F.least("root", "low").alias("root"))
        lower = written(lower, "lower")
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("far"))
        label = written(lower.join(jump, "root", "left").select("node", "old", F.coalesce("far", "root").alias("root")), "label")
        if label.filter("old <> root").isEmpty():
            return label.select("node", "root")


def groups(df: DataFrame, id_col: str = "id", text: str = "preview") -> DataFrame:
    """(id, rep, group_id, class_size, group_size) per text: class of equal texts, smallest id of the group of similar classes, and their rows.

    The groups are the connected components of all links, though not all links are listed: a bucket's
    members are compared with its smallest one first; then, in buckets that still hold several groups,
    the members outside the bucket's largest group are compared with those of other groups.
    """
    classes, members = _classes(df, id_col, text)
    n = classes.count()
    v = written(_variants(classes), "variants")
    heads = v.groupBy("key").agg(F.min("rep").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    heads = v.join(heads.select("key", "rep"), ["key", "rep"], "left_semi")
    near = _side(heads, "a").join(_side(v, "b"), "key").filter(f"rep_a < rep_b AND {SIFT}")
    tied = written(_verified(df, id_col, text, written(near.select("rep_a", "rep_b").distinct(), "pairs"), n), "tied")
    nodes = classes.select(F.col("rep").alias("node"))
    roots = components(nodes, tied.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
    w = v.join(roots.withColumnRenamed("node", "rep"), "rep")
    by_root = w.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = by_root.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("key", "main")
    w = written(w.join(mixed, "key"), "mixed")
    # of two members in different groups at least one is outside the main group: it asks, of two such ones the smaller
    asks, all_ = _side(w.filter("root <> main"), "a", "root"), _side(w, "b", "root").join(mixed.withColumnRenamed("main", "main_b"), "key")
    rest = asks.join(all_, "key").filter(f"root_a <> root_b AND (root_b = main_b OR rep_a < rep_b) AND {SIFT}")
    rest = written(rest.select(F.least("rep_a", "rep_b").alias("rep_a"), F.greatest("rep_a", "rep_b").alias("rep_b")).distinct(), "rest")
    more = written(_verified(df, id_col, text, rest, n), "more")
    both = tied.unionByName(more)
    roots = components(nodes, both.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
    sizes = members.groupBy("rep").agg(F.count(F.lit(1)).alias("class_size"))
    per_class = written(sizes.join(roots.withColumnRenamed("node", "rep"), "rep"), "roots")
    per_group = per_class.groupBy("root").agg(F.sum("class_size").alias("group_size"))
    return members.join(per_class.join(per_group, "root"), "rep").select("id", "rep", F.col("root").alias("group_id"), "class_size", "group_size")
