import random
import re

import pytest
from pyspark.sql import functions as F

from vellumix.operators import dedup


def shingle_set(t, k=4):
    w = re.findall(r"\w+", t.lower())
    return set() if not w else {" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def test_shingles(spark):
    rows = spark.createDataFrame([("a b c d e",), ("a b",), ("",), (None,), ("x x x x x x",)], "t string")
    got = [sorted(r[0]) for r in rows.select(dedup.shingles(F.col("t"))).collect()]
    assert got == [["a b c d", "b c d e"], ["a b"], [], [], ["x x x x"]]


def test_sketches_are_stable_and_estimate(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(500)}" for _ in range(420)]
    other = words[:400] + [f"z{k}" for k in range(25)]
    a, b = dedup.wide_signature(" ".join(words), {}), dedup.wide_signature(" ".join(other), {})
    five = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    truth = len(five(words) & five(other)) / len(five(words) | five(other))
    assert abs((a == b).mean() - truth) < 0.12
    assert dedup.sketch64("") == [0] * 64 and len(set(dedup.sketch64("one"))) > 32
    assert (dedup.wide_signature("  ", {}) == 0).all()


def test_first_kept_is_the_greedy_choice(spark):
    rng = random.Random(4)
    for n in (8, 25):
        edges = sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(2 * n)})
        kept = []
        for v in range(n):
            if not any((u, v) in edges for u in kept):
                kept.append(v)
        nodes = spark.createDataFrame([(v,) for v in range(n)], "id bigint")
        got = dedup.first_kept(nodes, spark.createDataFrame(edges, "a bigint, b bigint"))
        assert sorted(r.id for r in got.filter("kept").collect()) == kept


def greedy(docs, least=0.8):
    """The order-dependent choice, one document after the other."""
    exact, canon, out = {}, {}, {}
    for i, t in sorted(docs):
        norm = " ".join((t or "").lower().split())
        if not norm:
            out[i] = (False, None)
            continue
        if norm in exact:
            out[i] = (False, exact[norm])
            continue
        mine = shingle_set(t)
        hit = next((c for c, s in canon.items() if mine and s and len(mine & s) / len(mine | s) >= least), None)
        if hit is not None:
            out[i] = (False, hit)
            continue
        exact[norm], canon[i] = i, mine
        out[i] = (True, None)
    return out


def test_deduplicated_matches_the_loop(spark):
    rng = random.Random(9)
    base = [[f"w{rng.randrange(2000)}" for _ in range(60)] for _ in range(6)]
    docs = []
    for i in range(60):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(99)}"
        docs.append((i, " ".join(w)))
    docs += [(60, docs[3][1].upper() + " "), (61, ""), (62, None), (63, docs[9][1])]
    got = {r.id: (r.is_canonical, r.dup_of) for r in dedup.deduplicated(spark.createDataFrame(docs, "id bigint, t string"), "id", "t").collect()}
    want = greedy(docs)
    assert got.keys() == want.keys()
    assert {i: v[0] for i, v in got.items()} == {i: v[0] for i, v in want.items()}
    assert {i: v[1] for i, v in got.items()} == {i: v[1] for i, v in want.items()}


def test_similar_pairs_match_brute_force(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(300)}" for _ in range(40)]
    docs = [(i, " ".join(base[rng.randrange(5) : 40 - rng.randrange(5)])) for i in range(30)] + [(99, "a b"), (100, None)]
    got = {(r.id_a, r.id_b) for r in dedup.similar_pairs(spark.createDataFrame(docs, "id bigint, t string"), "id", "t").collect()}
    sets, seen = {}, set()
    for i, t in docs:
        s = frozenset(shingle_set(t or ""))
        if s and s not in seen:
            seen.add(s)
            sets[i] = s
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    assert got == want and want


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "id bigint, t string")
    assert dedup.deduplicated(none, "id", "t").count() == 0
    assert dedup.similar_pairs(none, "id", "t").count() == 0


def test_best_of_cluster(spark):
    rows = spark.createDataFrame([(1, "a", 2.0), (2, "a", 5.0), (3, "a", 5.0), (4, "b", None)], "id bigint, c string, s double")
    assert sorted(r.id for r in dedup.best_of_cluster(rows, "c", "s", "id").collect()) == [2, 4]


def test_stored_signature(spark):
    import struct

    blob = struct.pack("<128I", *range(2**32 - 128, 2**32))
    rows = spark.createDataFrame([(bytearray(blob),), (None,), (bytearray(b"x"),)], "s binary")
    got = [r[0] for r in rows.select(dedup.stored_signature("s")).collect()]
    assert got[0] == list(range(2**32 - 128, 2**32)) and got[1:] == [None, None]


@pytest.mark.parametrize("a,b,want", [([1, 2], [1, 3], 0.5), ([], [], 0.0), ([1], [1, 2], 0.0)])
def test_agreement(spark, a, b, want):
    row = spark.createDataFrame([(a, b)], "a array<bigint>, b array<bigint>")
    assert row.select(dedup.agreement(F.col("a"), F.col("b"))).first()[0] == want


def test_banded_choice_matches_a_loop(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(900)}" for _ in range(120)] for _ in range(5)]
    docs = []
    for i in range(40):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(99)}"
        docs.append((i, " ".join(w)))
    docs.append((40, ""))
    got = {r.id: (r.is_canonical, r.dup_of) for r in dedup.deduplicated_banded(spark.createDataFrame(docs, "id bigint, t string"), "id", "t").collect()}
    sigs, want = {i: dedup.wide_signature(t, {}) for i, t in docs if t}, {40: (False, None)}
    canon, first = [], {}
    for i in sigs:
        key = tuple(sigs[i])
        if key in first:
            want[i] = (False, want[first[key]][1] if want[first[key]][1] is not None else first[key])
            continue
        first[key] = i
        best = None
        for c in canon:
            shared = [b for b in range(32) if (sigs[i][4 * b : 4 * b + 4] == sigs[c][4 * b : 4 * b + 4]).all()]
            if shared and (sigs[i] == sigs[c]).mean() >= 0.8 and (best is None or (shared[0], c) < best):
                best = (shared[0], c)
        want[i] = (best is None, None if best is None else best[1])
        if best is None:
            canon.append(i)
    assert got == want


def test_catalog_decides_copies_on_whole_texts(spark):
    from vellumix.plans import catalog

    rng = random.Random(7)
    words = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    opening = words(2000)  # longer than the preview
    ends = [words(3000), words(3000)]
    texts = [f"{opening} {ends[0]}", f"{opening} {ends[1]}", f"{opening} {ends[0]}".upper()]
    short = [f"s{k}" for k in range(45)]
    texts += [" ".join(short), " ".join([*short[:20], "x", *short[21:]])]  # similarity 0.83 in runs of four words, 0.78 in runs of five
    docs = [(i, "t", "a", t, [], "s", "d") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "id bigint, title string, author string, text string, tags array<string>, source_archive string, created_date string")
    got = {r.id: r for r in catalog.build(frame).collect()}
    assert len(got[0].preview) == 8000 and got[0].preview == got[1].preview
    assert [(got[i].is_canonical, got[i].dup_of) for i in range(5)] == [(1, None), (1, None), (0, 0), (1, None), (1, None)]
    assert got[0].exact_hash == got[2].exact_hash != got[1].exact_hash and "clean" not in got[0]


def test_sketches_and_hashes_read_whole_texts(spark, tmp_path):
    from vellumix.plans import text_queries

    rng = random.Random(8)
    words = lambda n: " ".join(f"w{rng.randrange(9000)}" for _ in range(n))
    opening = words(36_000)  # over 200,000 characters
    texts = [f"{opening} {words(36_000)}" for _ in range(2)] + [opening[:40_000] + words(12_000), opening[:40_000] + words(12_000)]
    assert len(opening) > 200_000
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert len({r.hash for r in text_queries.normalized_hash(spark, str(tmp_path)).collect()}) == 4
    assert len({r.sig for r in text_queries.minhash128_signature(spark, str(tmp_path)).collect()}) == 4
    assert all(r.is_canonical for r in text_queries.near_dup_banded(spark, str(tmp_path)).collect())
