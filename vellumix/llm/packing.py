"""Problem 8: place items of varying length in containers of fixed capacity with little space left over.

Method: large-item matching. Items above one third of the capacity go at most two to a container, by
greedy matching of the largest with the largest that still fits; smaller ones then fill the
remaining gaps by best fit, and open containers of their own only when no gap is left. An item above
the capacity is split into full containers and a rest, which is packed like any other item.

Scale: sizes are whole numbers up to the capacity, so the packing is done on the histogram of sizes
and not on the items: its steps ("one item of size s into each of the containers a .. a + m") depend
on the number of distinct sizes only, at most the capacity, however many items there are. Items are
numbered within their size by a distributed count (within a hash part, then offsets) and take their container
from the step that covers their number. No size is brought into one task.

Defined cases: items of no tokens (null or empty texts) are placed in container 0 and take no space;
rows without an id are dropped and repeated rows count once; equal sizes are numbered by hash part and id;
a null capacity or one below 1 is dropped; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumix.storage import written

from .tokens import sized


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Steps (size, first item, items, first container, items per container) that place every item.

    Items of a size are numbered from 0. Sizes lie between 1 and the capacity.
    """
    left = {s: n for s, n in histogram.items() if n > 0}
    used: dict[int, int] = defaultdict(int)
    steps: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def put(size: int, items: int, first: int, each: int = 1) -> None:
        steps.append((size, used[size], items, first, each))
        used[size] += items
        left[size] -= items

    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free space -> ranges of containers
    large = sorted(s for s in left if 3 * s > capacity)
    # greedy matching of the large ones
    while large:
        s = large.pop()
        if not left[s]:
            continue
        if 2 * s <= capacity and left[s] > 1:
            partner = s
        else:
            k = bisect_left(large, capacity - s + 1) - 1
            while k >= 0 and not left[large[k]]:
                large.pop(k)
                k -= 1
            partner = large[k] if k >= 0 else 0
        if partner == s:
            n = left[s] // 2
            put(s, 2 * n, bins, 2)
            gaps[capacity - 2 * s].append((bins, n))
            bins += n
        elif partner:
            n = min(left[s], left[partner])
            put(s, n, bins)
            put(partner, n, bins)
            gaps[capacity - s - partner].append((bins, n))
            bins += n
        else:
            n = left[s]
            put(s, n, bins)
            gaps[capacity - s].append((bins, n))
            bins += n
        if left[s]:
            large.append(s)
    # smaller ones by best fit
    order = sorted(g for g in gaps if g)
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s]:
            k = bisect_left(order, s)
            if k == len(order):  # no gap: new containers, full of this size
                each = capacity // s
                whole, rest = divmod(left[s], each)
                for n, per in ((whole, each), (1 if rest else 0, rest)):
                    if n:
                        put(s, n * per, bins, per)
                        free = capacity - per * s
                        if free:
                            if not gaps[free]:
                                insort(order, free)
                            gaps[free].append((bins, n))
                        bins += n
                continue
            g = order[k]
            first, n = gaps[g].pop()
            take = min(n, left[s])
            if take < n:
                gaps[g].append((first + take, n - take))
            if not gaps[g]:
                order.pop(k)
            put(s, take, first)
            if g > s:
                if not gaps[g - s]:
                    insort(order, g - s)
                gaps[g - s].append((first, take))
    return steps


def _pieces(items: DataFrame) -> DataFrame:
    """Items cut to the capacity: full pieces, then the rest."""
    full = F.expr("cast(floor(tokens / capacity) as int)")
    cut = items.withColumn("full", full).withColumn("piece_no", F.explode(F.expr("sequence(0, greatest(0, full - if(tokens % capacity = 0, 1, 0)))")))
    size = F.when(F.col("piece_no") < F.col("full"), F.col("capacity")).otherwise(F.col("tokens") - F.col("full") * F.col("capacity"))
    return cut.select("limit_name", "capacity", "id", "piece_no", size.cast("int").alias("size"))


def packed(items: DataFrame, limits: DataFrame) -> DataFrame:
    """(limit_name, capacity, container, id, piece_no, size) for items (id, tokens) and limits (limit_name, capacity_tokens)."""
    spark = items.sparkSession
    named = limits.selectExpr("limit_name", "cast(capacity_tokens as int) as capacity").filter("capacity > 0").dropDuplicates(["limit_name"]).collect()  # a parameter list
    if not named:
        return items.select(F.lit("").alias("limit_name"), F.lit(0).alias("capacity"), F.lit(0).cast("bigint").alias("container"), "id", F.lit(0).alias("piece_no"), F.lit(0).alias("size")).limit(0)
    each_limit = F.explode(F.array(*[F.struct(F.lit(r.limit_name).alias("limit_name"), F.lit(r.capacity).alias("capacity")) for r in named])).alias("l")
    parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    numbered = _pieces(items.filter("id IS NOT NULL").select("id", "tokens", each_limit).select("id", "tokens", "l.*"))
    numbered = written(numbered.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")), "pieces")
    counts = written(numbered.groupBy("limit_name", "capacity", "size", "part").count(), "counts")
    before = F.coalesce(F.sum("count").over(Window.partitionBy("limit_name", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumn("before", before).select("limit_name", "size", "part", "before")
    histograms: dict[tuple[str, int], dict[int, int]] = defaultdict(dict)
    for r in counts.groupBy("limit_name", "capacity", "size").agg(F.sum("count").alias("n")).collect():  # at most the capacity, for each limit
        histograms[r.limit_name, r.capacity][r["size"]] = r.n
    steps = [(name, *step) for (name, cap), h in histograms.items() for step in plan({s: n for s, n in h.items() if s}, cap)]
    steps += [(name, 0, 0, h[0], 0, h[0]) for (name, _), h in histograms.items() if h.get(0)]
    table = spark.createDataFrame(steps, "limit_name string, size int, first_item bigint, items bigint, first_container bigint, each bigint")
    # steps of one size cover its items without overlap: the step of an item is the last that begins at or before it
    spans = table.groupBy("limit_name", "size").agg(F.array_sort(F.collect_list(F.struct("first_item", "first_container", "each"))).alias("spans"))
    place = F.row_number().over(Window.partitionBy("limit_name", "size", "part").orderBy("id", "piece_no")) - 1 + F.col("before")
    ranked = numbered.join(F.broadcast(offsets) if counts.count() < 200_000 else offsets, ["limit_name", "size", "part"]).withColumn("item", place)
    found = ranked.join(F.broadcast(spans), ["limit_name", "size"])
    step = F.expr("element_at(filter(spans, s -> s.first_item <= item), -1)")
    return found.withColumn("step", step).select("limit_name", "capacity", (F.col("step.first_container") + F.expr("cast(floor((item - step.first_item) / step.each) as bigint)")).alias("container"), "id", "piece_no", "size")


def pack_documents(df: DataFrame, limits: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Containers of all documents by token count, for each limit."""
    kind = dict(df.dtypes)[id_col]
    items = sized(df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).filter("id IS NOT NULL"), ["id"], "text", **options)
    items = written(items.groupBy(F.col("id").cast(kind).alias("id")).agg(F.max("tokens").alias("tokens")), "sizes")
    return packed(items, limits).withColumnRenamed("id", id_col)


def report(placed: DataFrame) -> DataFrame:
    """Containers, their fill and the least possible number of them, for each limit."""
    one = placed.groupBy("limit_name", "capacity", "container").agg(F.sum("size").alias("tokens"), F.count(F.lit(1)).alias("n_items"))
    total = F.sum("tokens")
    return one.groupBy("limit_name", "capacity").agg(F.count(F.lit(1)).alias("n_containers"), F.ceil(total / F.first("capacity")).cast("bigint").alias("least_containers"), total.alias("tokens"), F.max("tokens").alias("fullest"), (total / (F.count(F.lit(1)) * F.first("capacity"))).alias("fill"))
