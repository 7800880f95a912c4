"""Exact and near duplicates: normalised hashes, shingles, MinHash, banded candidates, greedy choice.

The greedy choice keeps a row unless an earlier kept row is its duplicate. On the graph of duplicate
pairs that is the lexicographically first maximal independent set, found here in rounds of joins.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from vellumix.functions.text import BARE_WORD, let, normalized_hash, text_or_empty
from vellumix.storage import written

#: Fixed values of the 64-slot sketch.
SLOTS, PRIME = 64, 4294967311
COEFFICIENTS = [((i * 10007 + 3) % PRIME, (i * 20011 + 7) % PRIME) for i in range(1, SLOTS + 1)]
_WORDS = re.compile(r"\w+")
#: Sets of a group when pairs are verified; a cell of two groups holds at most about twice as many.
CELL = 2000
#: Sets by which frequent shingles are known, and how many of these are told apart.
ORDER_SETS, COMMON = 20_000, 200_000
#: Fixed values of the 128-slot sketch: slots, rows of a band, words of a shingle, prime.
WIDE_SLOTS, BAND_ROWS, WIDE_K, MERSENNE = 128, 4, 5, 2**31 - 1


def shingles(c: Column, k: int = 4) -> Column:
    """Distinct runs of k words; the joined words if there are fewer than k; empty without words."""
    def runs(w: Column) -> Column:
        n = F.size(w)
        each = F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, F.lit(k)), " "))
        return F.when(n == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(each))

    return let(F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(BARE_WORD), F.lit(0)), runs)


def sketch64(text: str, k: int = 4) -> list[int]:
    """64 minima of (a * h + b) mod p over 32-bit hashes of the shingles; zeros without words."""
    w = _WORDS.findall(text.lower())
    sh = {" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else ()
    if not sh:
        return [0] * SLOTS
    h = np.array([int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in sh], np.int64)
    a, b = (np.array(x, np.int64)[:, None] for x in zip(*COEFFICIENTS))
    best = np.full(SLOTS, PRIME, np.int64)
    for at in range(0, len(h), 4096):  # products stay below 2 ** 53
        best = np.minimum(best, ((a * h[None, at : at + 4096] + b) % PRIME).min(axis=1))
    return best.tolist()


@F.pandas_udf(ArrayType(LongType()))
def minhash64(s: pd.Series) -> pd.Series:
    """The 64-slot sketch of a text. In lambdas it would take 64 interpreted passes over the shingles."""
    return s.map(lambda t: sketch64(t or ""))


def agreement(a: Column, b: Column) -> Column:
    """Share of equal slots of two sketches; 0 if their lengths differ or are 0."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, v: n + v)
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), same / F.size(a)).otherwise(0.0)


def _wide_coefficients() -> tuple[np.ndarray, np.ndarray]:
    x = np.arange(3, 2 * WIDE_SLOTS + 3, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = x * np.uint64(6364136223846793005) + np.uint64(1442695040888963407)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    x = x % np.uint64(MERSENNE - 1) + np.uint64(1)
    return x[0::2], x[1::2]


def wide_signature(text: str, memo: dict[str, int], first_chars: int | None = None) -> np.ndarray:
    """128 minima over hashed runs of five blank-separated words; zeros for blank text. The reference reads the first 30,000 characters."""
    tokens = text[:first_chars].split()
    if not tokens:
        return np.zeros(WIDE_SLOTS, np.int64)
    digest = lambda w: int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
    if len(tokens) < WIDE_K:
        mixed = np.array([digest(" ".join(tokens))], np.uint64)
    else:
        if len(memo) > 500_000:
            memo.clear()
        ids = np.array([memo.get(w) or memo.setdefault(w, digest(w)) for w in tokens], np.uint64)
        with np.errstate(over="ignore"):
            h = np.zeros(len(ids) - WIDE_K + 1, np.uint64)
            for k in range(WIDE_K):
                h = h * np.uint64(1_000_003) + ids[k : k + len(h)]
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            mixed = h ^ (h >> np.uint64(31))
    a, b = _wide_coefficients()
    low = mixed % np.uint64(MERSENNE)
    best = np.full(WIDE_SLOTS, MERSENNE, np.uint64)
    for at in range(0, len(low), 4096):  # bounded memory for long texts
        best = np.minimum(best, ((np.multiply.outer(a, low[at : at + 4096]) + b[:, None]) % np.uint64(MERSENNE)).min(axis=1))
    return best.astype(np.int64)


_MEMO: dict[str, int] = {}


@F.pandas_udf(ArrayType(LongType()))
def minhash128(s: pd.Series) -> pd.Series:
    """The 128-slot sketch; unsigned 64-bit wrap-around arithmetic has no built-in counterpart."""
    return s.map(lambda t: wide_signature(t or "", _MEMO).tolist())


@F.pandas_udf(ArrayType(LongType()))
def stored_signature(s: pd.Series) -> pd.Series:
    """The 128 little-endian 32-bit numbers of a binary column as an array; null for null or another length."""
    return s.map(lambda b: np.frombuffer(b, "<u4").astype(np.int64).tolist() if b is not None and len(b) == 4 * WIDE_SLOTS else None)


def bands(df: DataFrame, id_col: str, sig: str, rows: int = BAND_ROWS) -> DataFrame:
    """(id, band, key): each run of ``rows`` slots."""
    s = F.col(sig)
    parts = F.transform(F.sequence(F.lit(0), (F.floor(F.size(s) / rows) - 1).cast("int")), lambda i: F.slice(s, i * rows + 1, F.lit(rows)))
    return df.select(F.col(id_col).alias("id"), F.posexplode(parts).alias("band", "key"))


def band_candidates(df: DataFrame, id_col: str, sig: str, rows: int = BAND_ROWS) -> DataFrame:
    """(id_a, id_b, band, estimate): pairs with a common band, each at its first one.

    Rows with equal sketches are one candidate class, joined through their smallest id.
    """
    base = df.select(F.col(id_col).alias("id"), F.col(sig).alias("sig")).filter("sig IS NOT NULL AND size(sig) > 0")
    classes = base.groupBy("sig").agg(F.min("id").alias("id"))
    keyed = bands(classes, "id", "sig", rows).withColumn("key", F.xxhash64("key"))
    a, b = keyed.select("band", "key", F.col("id").alias("id_a")), keyed.select("band", "key", F.col("id").alias("id_b"))
    pairs = a.join(b, ["band", "key"]).filter("id_a < id_b").groupBy("id_a", "id_b").agg(F.min("band").alias("band"))
    s = classes.select("id", "sig")
    joined = pairs.join(s.withColumnsRenamed({"id": "id_a", "sig": "sig_a"}), "id_a").join(s.withColumnsRenamed({"id": "id_b", "sig": "sig_b"}), "id_b")
    return joined.select("id_a", "id_b", "band", agreement(F.col("sig_a"), F.col("sig_b")).alias("estimate"))


def similar_pairs(df: DataFrame, id_col: str, text: str, least: float = 0.8, k: int = 4) -> DataFrame:
    """(id_a, id_b, similarity): all pairs with Jaccard >= ``least`` over shingles, exact.

    Texts with equal shingle sets are one class, represented by its smallest id (members of a class
    are not paired). Prefix filter: in one common order of all shingles two sets with that similarity
    share one of their first n - ceil(least * n) + 1 shingles, so only those are joined.
    """
    rows, sets_of = _prefixed_texts(df, id_col, text, least, k)
    reps = rows.filter("n > 0").groupBy("c1", "c2", "n").agg(F.min("id").alias("id")).select("id")
    return _pairs(rows, reps, sets_of, least)


def _fingerprint(words: list[str], k: int, memo: dict[str, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of k words; of the joined words if there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.array([memo[w] if w in memo else memo.setdefault(w, int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")) for w in words], np.uint64)
    n = max(1, len(ids) - k + 1)
    with np.errstate(over="ignore"):
        h = np.full(n, min(k, len(ids)), np.uint64)
        for j in range(min(k, len(ids))):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[j : j + n]
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
        return np.unique(h ^ (h >> np.uint64(31)))


def shingle_sets(df: DataFrame, id_col: str, text: str, k: int, order: tuple | None = None) -> DataFrame:
    """(id, n, c1, c2, set, hash): size, identity and hashes of the set of runs of k words, as bytes, and the normalised hash; with an ``order`` the set's prefix in it instead of the set.

    One Arrow pass over the texts: in expressions the runs of words of every text would be built as
    strings by interpreted lambdas.
    """
    kind, name = dict(df.dtypes)[id_col], "set" if order is None else "prefix"
    rows = df.select(F.col(id_col).alias("id"), text_or_empty(F.col(text)).alias("text"))

    def work(batches):
        import pyarrow as pa

        memo: dict[str, int] = {}
        for batch in batches:
            sets, hashes = [], []
            for t in batch.column(1).to_pylist():
                low = t.lower()
                sets.append(_fingerprint(_WORDS.findall(low), k, memo))
                flat = " ".join(low.split())
                hashes.append(hashlib.sha256(flat.encode("utf-8", "surrogatepass")).hexdigest() if flat else "")
                if len(memo) > 500_000:
                    memo.clear()
            with np.errstate(over="ignore"):
                c1 = [int(np.add.reduce(s).view(np.int64)) if len(s) else 0 for s in sets]
                c2 = [int(np.bitwise_xor.reduce(s * np.uint64(0x9E3779B97F4A7C15) ^ (s >> np.uint64(7))).view(np.int64)) if len(s) else 0 for s in sets]
            values = pa.array([s.tobytes() for s in sets], pa.binary()) if order is None else pa.array([_prefix(s, order[0].value, order[1]) for s in sets], pa.list_(pa.int64()))
            cols = [batch.column(0), pa.array([len(s) for s in sets], pa.int32()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), values, pa.array(hashes, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "n", "c1", "c2", name, "hash"])

    return rows.mapInArrow(work, f"id {kind}, n int, c1 bigint, c2 bigint, {name} {'binary' if order is None else 'array<bigint>'}, hash string")


def _common(sets: DataFrame):
    """What tells frequent shingles apart: sorted hashes and their counts in the sets, at most ``COMMON`` of them, as a broadcast."""
    import pyarrow as pa

    def flat(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64))], names=["s"])

    frequent = sets.select("set").mapInArrow(flat, "s bigint").groupBy("s").count().filter("count > 1").orderBy(F.desc("count"), "s").limit(COMMON).collect()  # bounded by COMMON
    known = np.array(sorted((r.s, r["count"]) for r in frequent), np.int64).reshape(-1, 2)
    return sets.sparkSession.sparkContext.broadcast((known[:, 0].copy(), known[:, 1].copy()))


def _some(df: DataFrame, n: int) -> DataFrame:
    """About ``ORDER_SETS`` rows of ``df``, by a hash of the id."""
    return df.filter(F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, ORDER_SETS / max(1, n))))


def _prefix(h: np.ndarray, common: tuple[np.ndarray, np.ndarray], least: float) -> list[int]:
    """The first shingles of a set in the common order: rare ones first, equally frequent ones by a second hash."""
    names, counts = common
    with np.errstate(over="ignore"):
        second = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    count = np.zeros(len(h), np.int64)
    if len(names):
        at = np.minimum(np.searchsorted(names, h.view(np.int64)), len(names) - 1)
        count = np.where(names[at] == h.view(np.int64), counts[at], 0)
    return h[np.lexsort((second, count))][: len(h) - int(np.ceil(least * len(h) - 1e-9)) + 1].view(np.int64).tolist()


def _prefixed_texts(df: DataFrame, id_col: str, text: str, least: float, k: int):
    """(id, n, c1, c2, hash, prefix), written, and a function of ids that gives their sets.

    The sets of all texts would be larger than the texts; they are never written or sent, only those of
    the texts in candidate pairs are made again.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    common = _common(shingle_sets(_some(rows, rows.count()), "id", "text", k))
    made = written(shingle_sets(rows, "id", "text", k, (common, least)), "hashed")
    return made, lambda ids: shingle_sets(rows.join(ids, "id", "left_semi"), "id", "text", k)


def _prefixed_sets(sets: DataFrame, least: float):
    """The same for rows that hold their sets."""
    import pyarrow as pa

    common = _common(_some(sets, sets.count()))

    def work(batches):
        for batch in batches:
            prefixes = [_prefix(np.frombuffer(raw, np.uint64), common.value, least) for raw in batch.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(prefixes, pa.list_(pa.int64()))], names=["id", "n", "c1", "c2", "hash", "prefix"])

    kind = dict(sets.dtypes)["id"]
    made = sets.select("id", "n", "c1", "c2", "hash", "set").mapInArrow(work, f"id {kind}, n int, c1 bigint, c2 bigint, hash string, prefix array<bigint>")
    return written(made, "hashed"), lambda ids: sets.join(ids, "id", "left_semi")


def _pairs(rows: DataFrame, reps: DataFrame, sets_of, least: float) -> DataFrame:
    """The pairs (id_a, id_b, similarity) among the ids ``reps``, no two sets being equal.

    Sets are sent once to each cell of pairs, not once for each pair.
    """
    import pyarrow as pa

    kind = dict(rows.dtypes)["id"]
    prefix = rows.filter("n > 0").select("id", "n", F.explode_outer("prefix").alias("s"))
    shared = prefix.groupBy("s").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").select("s")  # most shingles belong to one text and need no partner
    prefix = written(prefix.join(shared, "s", "left_semi").join(reps, "id", "left_semi"), "prefixes")
    a, b = prefix.select("s", F.col("id").alias("id_a"), F.col("n").alias("n_a")), prefix.select("s", F.col("id").alias("id_b"), F.col("n").alias("n_b"))
    # of the shingles that two sets share, those missing in one of the prefixes are behind it: so many must be in both
    beyond = f"(cast(ceil({least} * greatest(n_a, n_b) - 1e-9) as int) - 1)"
    enough = f"n >= cast(ceil({least / (1 + least)} * (n_a + n_b) - 1e-9) as int) - {beyond}"
    met = a.join(b, "s").filter(f"id_a < id_b AND least(n_a, n_b) >= {least} * greatest(n_a, n_b) - 1e-9")
    pairs = written(met.groupBy("id_a", "id_b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("n")).filter(enough).select("id_a", "id_b"), "candidates")
    cells = max(1, rows.count() // CELL)
    deal = lambda c: F.pmod(F.xxhash64(F.lit(5), c), F.lit(cells)).cast("int")
    placed = pairs.select("id_a", "id_b", deal("id_a").alias("u"), deal("id_b").alias("v"))
    needed = placed.select(F.explode(F.array("id_a", "id_b")).alias("id"), "u", "v").distinct()
    sent = needed.join(sets_of(needed.select("id").distinct()).select("id", "set"), "id").select("u", "v", F.col("id").alias("id_a"), F.lit(None).cast(kind).alias("id_b"), "set")
    both = sent.unionByName(placed.withColumn("set", F.lit(None).cast("binary")))
    dealt = both.repartition(F.col("u"), F.col("v")).sortWithinPartitions("u", "v", F.col("id_b").asc_nulls_first()).select("u", "v", "id_a", "id_b", "set")

    def verify(batches):
        cell, held = None, {}
        for batch in batches:
            found: list[tuple] = []
            for u, v, x, y, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (u, v) != cell:
                    cell, held = (u, v), {}
                if y is None:
                    held[x] = np.frombuffer(raw, np.uint64)
                    continue
                both_ = len(np.intersect1d(held[x], held[y], assume_unique=True))
                ratio = both_ / (len(held[x]) + len(held[y]) - both_)
                if ratio >= least:
                    found.append((x, y, ratio))
            x, y, r = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(x, batch.column(2).type), pa.array(y, batch.column(2).type), pa.array(r, pa.float64())], names=["id_a", "id_b", "ratio"])

    return dealt.mapInArrow(verify, f"id_a {kind}, id_b {kind}, ratio double").select("id_a", "id_b", F.round("ratio", 4).alias("similarity"))


def first_kept(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, kept) where a node is kept iff no earlier kept node is its neighbour; earlier means smaller id.

    nodes (id), edges (a, b) with a < b. Undecided nodes whose earlier neighbours are all dropped are
    kept; those with an earlier kept neighbour are dropped; the rest waits for the next round. Only
    nodes with edges take part, and the undecided part shrinks in every round.
    """
    spark = nodes.sparkSession
    edges = written(edges.select("a", "b").distinct(), "edges")
    open_edges, decided = edges, []
    later = written(edges.select(F.col("b").alias("id")).distinct(), "later")
    involved = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    kept = written(involved.join(later, "id", "left_anti"), "kept")
    kept_all = [kept]
    waiting = later
    while not waiting.isEmpty():
        dropped = written(open_edges.join(kept.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).distinct(), "dropped")
        decided.append(dropped)
        waiting = written(waiting.join(dropped, "id", "left_anti"), "waiting")
        # edges to decided nodes no longer matter
        still = open_edges.join(dropped.withColumnRenamed("id", "b"), "b", "left_anti").join(dropped.withColumnRenamed("id", "a"), "a", "left_anti").join(kept.withColumnRenamed("id", "a"), "a", "left_anti")
        open_edges = written(still.select("a", "b"), "open")
        kept = written(waiting.join(open_edges.select(F.col("b").alias("id")).distinct(), "id", "left_anti"), "kept")
        kept_all.append(kept)
        waiting = written(waiting.join(kept, "id", "left_anti"), "waiting")
    gone = spark.createDataFrame([], edges.select(F.col("b").alias("id")).schema)
    for d in decided:
        gone = gone.unionByName(d)
    return nodes.select("id").distinct().join(gone.distinct().withColumn("_gone", F.lit(True)), "id", "left").select("id", F.col("_gone").isNull().alias("kept"))


def deduplicated(df: DataFrame, id_col: str, text: str, least: float = 0.8, k: int = 4) -> DataFrame:
    """(id, is_canonical, dup_of, similarity, cluster_id): exact copies by hash, then near copies, first id wins.

    Blank texts are not canonical and have no ``dup_of``. A row that copies a dropped row exactly is
    judged by the similarity to the kept one, as that row was.
    """
    return decided(*_prefixed_texts(df, id_col, text, least, k), least)


def decided(rows: DataFrame, sets_of, least: float = 0.8) -> DataFrame:
    """The choice of ``deduplicated`` for written rows with prefixes, and a function of ids that gives their sets."""
    solid = rows.filter("hash <> ''").select("id", "hash", "n", "c1", "c2")
    # of equal hashes the first, of the firsts with equal sets the first: hashes differ there, but shingles do not
    firsts = written(solid.groupBy("hash").agg(F.min(F.struct("id", "n", "c1", "c2")).alias("f")).select("hash", "f.*").withColumnRenamed("id", "first"), "firsts")
    twins = firsts.groupBy("c1", "c2", "n").agg(F.min("first").alias("rep"))
    rep = written(firsts.join(twins, ["c1", "c2", "n"]).select("hash", F.col("first").alias("id"), "rep"), "reps")
    reps = rep.select(F.col("rep").alias("id")).distinct()
    pairs = written(_pairs(rows, reps, sets_of, least), "near")
    kept = first_kept(reps, pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))
    near = pairs.join(kept.filter("kept").withColumnRenamed("id", "id_a"), "id_a", "left_semi").groupBy("id_b").agg(F.min_by(F.struct(F.col("id_a").alias("of"), "similarity"), "id_a").alias("m"))
    state = kept.join(near, kept.id == near.id_b, "left").select(F.col("id").alias("rep"), "kept", "m.of", "m.similarity")
    of_head = rep.join(state, "rep").select("hash", F.when(F.col("kept"), F.col("rep")).otherwise(F.col("of")).alias("canon"), F.when(F.col("kept"), 1.0).otherwise(F.col("similarity")).alias("sim"))
    canon = rows.select("id", "hash").join(of_head, "hash", "left")
    own = F.col("canon") == F.col("id")
    return canon.select("id", F.coalesce(own, F.lit(False)).alias("is_canonical"), F.when(~own, F.col("canon")).alias("dup_of"), F.when(own, 0.0).otherwise(F.col("sim")).alias("similarity"), F.col("canon").alias("cluster_id"))


def decided_after(new: DataFrame, old: DataFrame | None, least: float = 0.8) -> DataFrame:
    """The choice of ``decided`` for rows of ``new`` that come after the kept rows ``old``, whatever their ids.

    Both are written rows of ``shingle_sets`` with whole numbers as ids; ``old`` holds canonical rows only.
    The old sets are read in each call, but only their prefixes are written, and only the sets of
    candidates are sent around.
    """
    columns = ["id", "n", "c1", "c2", "set", "hash"]
    first = lambda df, age: df.withColumn("id", F.concat(F.lit(age), F.lpad(F.hex(F.col("id").bitwiseXOR(F.lit("-9223372036854775808").cast("bigint"))), 16, "0"))).select(columns)
    rows = first(new, "1")
    choice = decided(*_prefixed_sets(rows if old is None else first(old, "0").unionByName(rows), least), least).filter(F.col("id").startswith("1"))
    number = lambda c: (F.conv(F.substring(c, 2, 16), 16, 10).cast("decimal(20,0)") - F.lit("9223372036854775808").cast("decimal(20,0)")).cast("bigint")
    return choice.select(number("id").alias("id"), "is_canonical", number("dup_of").alias("dup_of"), "similarity", number("cluster_id").alias("cluster_id"))


def exact_copies(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, dup_of, cluster_size): first id of the rows with the same normalised text."""
    rows = df.select(F.col(id_col).alias("id"), normalized_hash(F.col(text)).alias("hash")).filter("hash <> ''")
    sizes = rows.groupBy("hash").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("cluster_size"))
    return rows.join(sizes, "hash").select("id", F.when(F.col("first") != F.col("id"), F.col("first")).alias("dup_of"), "cluster_size")


def best_of_cluster(df: DataFrame, cluster: str, score: str, id_col: str) -> DataFrame:
    """The member of highest score of each cluster, ties by smaller id."""
    best = F.max_by(F.struct(*df.columns), F.struct(F.coalesce(F.col(score), F.lit(float("-inf"))), -F.col(id_col)))
    return df.groupBy(F.col(cluster).alias("_c")).agg(best.alias("row")).select("row.*")


def unseen(new: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not yet known; keys are compared once each."""
    return new.join(known.select(key).distinct(), key, "left_anti")


def deduplicated_banded(df: DataFrame, id_col: str, text: str, least: float = 0.8) -> DataFrame:
    """(id, is_canonical, dup_of, similarity): the greedy choice over banded 128-slot sketches.

    Candidates share a band; a row is a copy of the kept candidate with the smallest (band, id) whose
    estimate reaches ``least``. Exact copies and rows with equal sketches follow the first of them.
    Blank texts are not canonical and have no ``dup_of``.
    """
    rows = written(df.select(F.col(id_col).alias("id"), normalized_hash(F.col(text)).alias("hash"), minhash128(F.col(text)).alias("sig")), "sketched")
    solid = rows.filter("hash <> ''")
    reps = solid.groupBy("sig").agg(F.min("id").alias("rep"))
    own = written(solid.join(reps, "sig").select("id", "rep"), "reps")
    pairs = written(band_candidates(solid.select("id", "sig"), "id", "sig").filter(F.col("estimate") >= least), "pairs")
    kept = written(first_kept(reps.select(F.col("rep").alias("id")), pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))), "kept")
    of = pairs.join(kept.filter("kept").select(F.col("id").alias("id_a")), "id_a", "left_semi").groupBy("id_b").agg(F.min_by(F.struct(F.col("id_a").alias("of"), "estimate"), F.struct("band", "id_a")).alias("m"))
    state = kept.join(of, kept.id == of.id_b, "left").select(F.col("id").alias("rep"), F.when(F.col("kept"), F.col("id")).otherwise(F.col("m.of")).alias("canon"), F.when(F.col("kept"), 1.0).otherwise(F.col("m.estimate")).alias("sim"))
    decided = own.join(state, "rep")
    self_ = F.col("canon") == F.col("id")
    out = decided.select("id", self_.alias("is_canonical"), F.when(~self_, F.col("canon")).alias("dup_of"), F.when(self_, 0.0).otherwise(F.col("sim")).alias("similarity"))
    blank = rows.filter("hash = ''").select("id", F.lit(False).alias("is_canonical"), F.lit(None).cast(dict(out.dtypes)["dup_of"]).alias("dup_of"), F.lit(None).cast("double").alias("similarity"))
    return out.unionByName(blank)
