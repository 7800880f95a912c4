"""Each operator against brute force on small tables, and on its defined edge cases."""

import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumix.llm import capping, confusables, knn, line_dedup, mixing, near_dup, packing, safety, splitting, text_stats, tokens

PROSE = "The old captain walked along the harbour and looked at the sea. He did not know what the morning would bring, but he was not afraid of it. "


# ---------------------------------------------------------------- 1
def test_prose_rules():
    junk = {
        "no_common_words": "ember, letter, lantern, staircase, sail, portrait, causeway, hotel, curtain, ledger, garden, tower, jetty, clock, candle",
        "digits": "\n".join(f"2010-08-{k} 05:48 1.2 MB pasture_48{k}.txt" for k in range(10, 30)),
        "symbols": "~u]#1~ lol#ed t~e he}vy ~a1;_{ la#] i% M]^}:~ {^e ge|ero/s ~il},_ <[nr\\_ {1s%e{ed +\\~dly",
        "repetition": "candle candle suitcase the candle suitcase and " * 20,
    }
    for reason, text in junk.items():
        got = text_stats.judge(text)
        assert not got["is_prose"] and reason in got["reasons"], (reason, got)
    fine = [PROSE * 3, PROSE.upper() * 2, PROSE.replace(".", "").replace(",", "") * 2, "Sea and sand,\nwind in my hand,\nthe gulls are loud,\nthe waves are proud.", "Yes.", "", "   \n ", '"Go," he said. "No," she said.\n' * 4, PROSE * 3 + "\n- rope\n- lamp\n- bread\n" + PROSE, "Le soir, elle regardait la mer et pensait à la maison où il était né, dans une rue sans nom.", "夜の港で、彼は古い灯台を見ていた。波の音だけが聞こえていた。"]
    for text in fine:
        assert text_stats.judge(text)["is_prose"], text
    half = text_stats.judge(PROSE * 2 + "\n" + junk["digits"] * 3)
    assert not half["is_prose"] and 0.5 < half["junk_share"] < 1


def test_prose_query_edges(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "a;b;1;2;3;4;5;6;7;8;9 " * 20, 5), (3, "a;b;1;2;3;4;5;6;7;8;9 " * 20, 5)], "id bigint, preview string, n_words int")
    assert [r.id for r in text_stats.not_prose(rows).collect()] == [3]
    assert text_stats.not_prose(rows.limit(0)).count() == 0
    assert text_stats.text_statistics(rows).filter("id = 1").first().n_words is None


def test_statistics_are_plain_counts():
    got = text_stats.judge('"Go now," she said. He left!')
    assert got["n_words"] == 6 and got["avg_sentence_len"] == 3.0 and round(got["dialogue_ratio"], 3) == 0.333 and got["ttr"] == 1.0


# ---------------------------------------------------------------- 2
def trigrams(t):
    w = re.findall(r"[^\W_]+", (t or "").lower())
    return set(zip(w, w[1:], w[2:]))


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(3)
    docs = []
    for base in range(25):
        n = rng.choice([5, 9, 20, 45, 70, 150, 300])
        words = [f"w{rng.randrange(4000)}" for _ in range(n)]
        for _ in range(4):
            w = list(words)
            for _ in range(rng.randrange(0, max(2, n // 14))):
                k = rng.randrange(len(w))
                rng.choice([lambda: w.__setitem__(k, "edit"), lambda: w.insert(k, "more"), lambda: w.pop(k)])()
            docs.append((len(docs), " ".join(w)))
    docs += [(900, docs[0][1]), (901, docs[0][1].upper() + "!"), (902, None), (903, "one two"), (904, ""), (905, "a b a b a b a b")]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs + docs[:3]], "id bigint, preview string, rep int")
    sets = {i: trigrams(t) for i, t in docs if trigrams(t)}
    want = {(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])}
    got = {(r.id_a, r.id_b) for r in near_dup.similar_pairs(df).collect()}
    assert not got - want and len(want - got) <= 0.02 * len(want)
    members = {r.id: r for r in near_dup.groups(df).collect()}
    assert all(members[a].group_id == members[b].group_id for a, b in got) and members.keys() == sets.keys()
    assert members[900].rep == members[0].rep == 0


def test_groups_are_the_components_of_all_links(spark):
    """A template with one word changed each, chains of edits, and texts that share a long preface only."""
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(9000)}"
    base = [word() for _ in range(120)]
    docs = [" ".join([*base[: (k := rng.randrange(120))], f"edit{i}", *base[k + 1 :]]) for i in range(150)]
    chain = [word() for _ in range(60)]
    for i in range(12):
        chain[5 * i : 5 * i + 5] = [word() for _ in range(5)]
        docs.append(" ".join(chain))
    preface = [word() for _ in range(60)]
    docs += [" ".join(preface + [word() for _ in range(90)]) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(docs)), "id bigint, preview string")
    links = [(r.id_a, r.id_b) for r in near_dup.similar_pairs(df).collect()]
    root = list(range(len(docs)))
    find = lambda i: i if root[i] == i else find(root[i])
    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.id: r for r in near_dup.groups(df).collect()}
    assert {i: r.group_id for i, r in got.items()} == {i: find(i) for i in range(len(docs))}
    assert got[0].group_size == 150 and len(links) >= 150 * 149 // 2


def test_near_duplicates_of_nothing(spark):
    none = spark.createDataFrame([], "id bigint, preview string")
    assert near_dup.similar_pairs(none).count() == 0 and near_dup.groups(none).count() == 0


def test_components_of_a_chain(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1) if i != 19], "a bigint, b bigint")
    got = {r.node: r.root for r in near_dup.components(spark.range(n).select(F.col("id").alias("node")), edges).collect()}
    assert got == {i: 0 if i < 20 else 20 for i in range(n)}


# ---------------------------------------------------------------- 3
def brute_pairs(keys, x, k, least):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    out = set()
    for i in range(len(keys)):
        order = sorted((j for j in range(len(keys)) if j != i), key=lambda j: (-s[i, j], keys[j]))[:k]
        out |= {tuple(sorted((keys[i], keys[j]))) for j in order if s[i, j] >= least}
    return out


def test_close_vectors_match_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(150, 16))
    x = np.concatenate([centres + rng.normal(scale=0.15, size=centres.shape) for _ in range(4)]).astype(np.float32)
    x[7] = x[300] = x[450] = x[8]  # equal vectors
    x[20:40] = x[20]  # more equal ones than neighbours sought
    keys = [(int(i), int(i) % 3) for i in rng.permutation(len(x))]
    rows = [(a, b, v.tolist(), 1.0) for (a, b), v in zip(keys, x)]
    rows += rows[:5] + [(9000, 0, None, 1.0), (9001, 0, [0.0] * 16, 1.0), (9002, 0, [1.0] * 5, 1.0), (9003, 0, [float("nan")] * 16, 1.0), (9004, 0, [None] * 16, 1.0), (None, 0, x[0].tolist(), 1.0)]
    df = spark.createDataFrame(rows, "id bigint, chunk_index smallint, embedding array<float>, cosine double")
    got = {tuple(sorted((tuple(r.a), tuple(r.b)))) for r in knn.close_pairs(df.repartition(5), ["id", "chunk_index"], dim=16, least=0.8).collect()}
    want = brute_pairs(keys, x.astype(np.float64), 5, 0.8)
    assert not got - want or len(got - want) <= 0.01 * len(want)
    assert len(want - got) <= 0.01 * len(want)


def test_neighbour_recall(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, 0, v.tolist()) for i, v in enumerate(x)], "id bigint, chunk_index smallint, embedding array<float>")
    got = {}
    for r in knn.neighbours(df, ["id", "chunk_index"], dim=16, queries="key.id % 50 = 0").collect():
        got.setdefault(r.id, set()).add(r.nb_id)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    assert set(got) == set(range(0, 1500, 50))
    assert np.mean([len(got[i] & set(np.argsort(-s[i])[:5].tolist())) / 5 for i in got]) >= 0.9


def test_repeated_rows_of_other_tasks_take_no_place(spark):
    x = np.random.default_rng(3).normal(size=(40, 8)).astype(np.float32)
    rows = [(i, 0, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows * 3, "id bigint, chunk_index smallint, embedding array<float>").repartition(7)
    near = knn.neighbours(df, ["id", "chunk_index"], dim=8)
    assert near.count() == 40 * 5 and near.select("id", "nb_id").distinct().count() == 40 * 5


def test_traversal_is_best_first():
    rng = np.random.default_rng(1)
    x = knn._unit(rng.normal(size=(800, 12)) + 4 * np.repeat(rng.normal(size=(20, 12)), 40, axis=0)).astype(np.float32)
    tree = knn.Tree(x, 20_000)
    order = tree.visit(x[:50], 10)
    assert tree.scored < 0.6 * 50 * len(tree.leaves)
    # by the queue itself, one entry at a time
    priority, to_leaf = tree.priorities(x[:50]), x[:50] @ tree.leaves.T
    for i in range(50):
        queue = [(-p, "branch", b) for b, p in enumerate(priority[i])]
        reached = []
        while len(reached) < 10:
            queue.sort()
            value, kind, at = queue.pop(0)
            if kind == "leaf":
                reached.append(at)
            else:
                queue += [(-to_leaf[i, k], "leaf", k) for k in range(tree.first[at], tree.first[at + 1])]
        assert reached == order[i].tolist()
        place = tree.places(x[i : i + 1])[0]
        assert [int(place[k]) for k in reached] == list(range(1, 11))


def test_a_large_tree_scores_few_leaves():
    rng = np.random.default_rng(2)
    x = knn._unit(rng.normal(size=(8000, 16)) + 3 * np.repeat(rng.normal(size=(80, 16)), 100, axis=0)).astype(np.float32)
    tree = knn.Tree(x, 10**9)
    tree.visit(x[:500], 15)
    assert tree.scored / 500 < 0.2 * len(tree.leaves)


def test_blocks_hold_at_most_their_bound():
    sizes = np.array([5, 3, 9, 40, 2, 2, 7])
    first, parts = knn._blocks(sizes, 10)
    held = {}
    for leaf, (f, p) in enumerate(zip(first, parts)):
        for k in range(p):
            held[f + k] = held.get(f + k, 0) + sizes[leaf] / p
    assert max(held.values()) <= 10 and parts.tolist() == [1, 1, 1, 4, 1, 1, 1]
    who, leaf, block = knn._asked_blocks(np.array([[3, 0], [6, 3]]), first, parts)
    assert list(zip(who.tolist(), leaf.tolist())) == [(0, 3)] * 4 + [(0, 0), (1, 6)] + [(1, 3)] * 4
    assert block[:4].tolist() == list(range(first[3], first[3] + 4))


def test_inner_leaves_and_copied_blocks_keep_the_recall(spark, monkeypatch):
    """Small bounds, so that leaves are divided by a hash and by an inner level, and blocks are copied."""
    for name, value in {"MAX_LEAVES": 3, "SPLIT": 100, "LEAF": 16, "ASKS": 150}.items():
        monkeypatch.setattr(knn, name, value)
    rng = np.random.default_rng(9)
    x = (rng.normal(size=(2400, 16)) + 2 * np.repeat(rng.normal(size=(120, 16)), 20, axis=0)).astype(np.float32)
    keys = [(i, 0) for i in range(len(x))]
    df = spark.createDataFrame([(i, 0, v.tolist()) for i, v in enumerate(x)], "id bigint, chunk_index smallint, embedding array<float>")
    want = brute_pairs(keys, x.astype(np.float64), 5, 0.8)
    got = {tuple(sorted((tuple(r.a), tuple(r.b)))) for r in knn.close_pairs(df, ["id", "chunk_index"], dim=16, least=0.8).collect()}
    assert len(want - got) <= 0.02 * len(want) and len(got - want) <= 0.02 * len(want)


def test_no_vectors(spark):
    none = spark.createDataFrame([], "id bigint, chunk_index smallint, embedding array<float>")
    assert knn.close_pairs(none, ["id", "chunk_index"]).count() == 0


# ---------------------------------------------------------------- 4
def test_capping_matches_a_sort(spark):
    rng = random.Random(8)
    names = ["Ann Lee", "ann-lee", "ANN  LEE.", "Bo", "Cy", None, "", " Unknown / anonymous", "unknown / ANONYMOUS"]
    weights = [30, 20, 20, 30, 2, 20, 5, 20, 20]
    rows = [(i, rng.choices(names, weights)[0], rng.choice([None, 1.5, 2.0, 2.0, -3.0, 0.0, -0.0, float("nan")])) for i in range(-150, 150)]
    df = spark.createDataFrame([(i, a, q, "x") for i, a, q in rows + rows[:4] + [(None, "Bo", 9.0)]], "id bigint, author string, quality_total double, who string")
    cap = max(3, int(0.02 * (len(rows) + 5)))
    groups = {}
    for i, a, q in rows:
        key = re.sub(r"[\W_]", "", (a or "").lower())
        if key not in ("", "unknownanonymous"):
            groups.setdefault(key, []).append((-(q if q is not None and q == q else float("-inf")), i))
    want = {i for g in groups.values() for _, i in sorted(g)[cap:]}
    got = [r.id for r in capping.removed_rows(df).collect()]
    assert set(got) == want and len(got) == len(want)
    report = {r.contributor: (r.n_rows, r.n_kept) for r in capping.contributor_report(df).collect()}
    assert all(v == (len(groups[k]), cap) for k, v in report.items()) and "bo" in report


def test_capping_of_little(spark):
    few = spark.createDataFrame([(1, "A", 1.0), (2, "A", 2.0), (3, "A", None)], "id bigint, author string, quality_total double")
    assert capping.removed_rows(few).count() == 0 and capping.removed_rows(few.limit(0)).count() == 0


# ---------------------------------------------------------------- 5
TERMS = [("scumbag", 3), ("drop dead", 3), ("nude", 2), ("imbecile", 2), ("fool", 1)]
SPELLED = ["scumbag", "Scumbags!", "s c u m b a g", "s.c.u.m.b.a.g", "scumb@g", "5cumb4g", "scummmbag", "scum​bag", "ѕcumbаg", "ｓｃｕｍｂａｇ", "scúmbag", "sc*mbag", "drop\ndead", "drop-dead", "drop  dead", "DR0P D3AD", "<i>nu</i>de", 'sc<a href="https://tales.example/archive/2011/story/an-older-part-of-the-tale.html">um</a>bag', "s·c·u·m·b·a·g", "s/c/u/m/b/a/g", "d-r-o-p d-e-a-d", "&quot;nude&quot;", "!mb3c!l3"]
CLEAN = ["denuded hills", "a scumbagger", "drop. Dead leaves fell", "fool", "the nudel soup", "imbecilesque", "", PROSE]


def test_terms_letter_by_letter():
    p = safety.term_pattern([t for t, s in TERMS if s > 1])
    for t in SPELLED:
        assert safety.holds_term(safety.plain(f"He said {t} and left."), p), t
    for t in CLEAN:
        assert not safety.holds_term(safety.plain(t), p), t


def test_screen_finds_spellings(spark):
    rng = random.Random(1)
    filler = [" ".join(rng.sample(PROSE.split(), 20)) for _ in range(60)]
    texts = [f"{rng.choice(filler)} He said {t} and left. {rng.choice(filler) * rng.randrange(1, 6)}" for t in SPELLED] + [f"{rng.choice(filler)} {t} {rng.choice(filler)}" for t in CLEAN] + filler
    rows = [(str(i), t, " A " if i % 2 else None, 0.5) for i, t in enumerate(texts)] + [("0", texts[0], "a", 0.5), ("n", None, "a", 0.5), (None, texts[0], "a", 0.5)]
    df = spark.createDataFrame(rows, "id string, text string, source_archive string, score double")
    terms = spark.createDataFrame(TERMS, "term string, severity int")
    assert {r.id for r in safety.unsafe_ids(df, terms).collect()} == {str(i) for i in range(len(SPELLED))}
    scored = {r.id: r for r in safety.scored(df, terms).collect()}
    assert np.mean([scored[str(i)].score for i in range(len(SPELLED))]) > np.mean([scored[str(i)].score for i in range(len(SPELLED), len(texts))]) + 2
    rates = {r.source: r for r in safety.rates(df, terms).collect()}
    assert set(rates) == {"a", None} and sum(r.n_unsafe for r in rates.values()) >= len(SPELLED)
    assert safety.unsafe_ids(df.limit(0), terms).count() == 0
    assert safety.unsafe_ids(df, terms.filter("severity < 2")).count() == 0


def test_features_of_whole_tokens():
    assert safety.buckets("x" * 45 + "abc") != safety.buckets("x" * 45 + "def")


def test_scorer_equals_the_plain_forward_pass():
    model = safety.Classifier(2)
    score = safety.Scorer(model)
    rng = random.Random(0)
    texts = [[f"w{rng.randrange(40)}" for _ in range(n)] for n in (1, 2, 3, 31, 32, 33, 80, 0)]
    got = score.scores(texts)
    for t, s in zip(texts, got):
        if not t:
            assert s == -30
            continue
        best = -99.0
        for a in range(0, max(1, len(t) - safety.OVERLAP), safety.SEGMENT - safety.OVERLAP):
            x = np.concatenate([model.embed([safety.fold_token(w) for w in t]), np.zeros((4, safety.DIM), np.float32)])
            seg = min(len(t), a + safety.SEGMENT)
            feats = []
            for w in safety.WIDTHS:
                acts = np.stack([x[k : k + w].ravel() @ model.p[f"W{w}"] + model.p[f"b{w}"] for k in range(a, seg)])
                feats.append(np.maximum(acts, 0).max(axis=0))
            best = max(best, float(np.concatenate(feats) @ model.p["out"] + model.p["b"][0]))
        assert abs(best - s) < 1e-3


# ---------------------------------------------------------------- 6
@pytest.mark.parametrize("seed", range(4))
def test_pieces_join_to_the_text(seed):
    rng = random.Random(seed)
    parts = ["# Head\n", PROSE, "\n\n", "- item one\n", "word " * 60, "x" * 900, "、。" * 50, "A, b; c: d. ", "\r\n", "文" * 400]
    text = "".join(rng.choice(parts) for _ in range(60))
    got = splitting.pieces(text, 100, 700, 15, 90)
    assert "".join(p[o:] for p, o in got) == text and len(got) > 1 and got[0][1] == 0
    for (before, _), (piece, o) in zip(got, got[1:]):
        assert before.endswith(piece[:o]) and 0 < o <= 90
    for p, _ in got:
        assert len(p) <= 700 and len(splitting.WORD.findall(p)) <= 100


def test_cuts_are_natural():
    text = "\n\n".join(PROSE * 2 for _ in range(12)).strip()
    got = splitting.pieces(text, 120, 2400, 10, 80)
    assert all(p[o:].endswith(("\n\n", ". ")) or p is got[-1][0] for p, o in got)
    assert splitting.pieces("short") == [("short", 0)] and splitting.pieces("") == [("", 0)]


def test_split_items(spark):
    rows = spark.createDataFrame([(1, 0, "w " * 350, "p"), (1, 1, "w " * 351, "p"), (1, 1, "w " * 351, "p"), (2, 0, None, "p"), (3, 0, "y" * 2401, "p"), (4, 0, "y" * 2400, "p"), (5, 0, "", "p")], "id bigint, chunk_index smallint, text string, piece string")
    assert {tuple(r) for r in splitting.oversized(rows, ["id", "chunk_index"]).collect()} == {(1, 1), (3, 0)}
    assert splitting.split_items(rows, ["id", "chunk_index"]).filter("id = 5").count() == 1
    assert splitting.oversized(rows.limit(0), ["id", "chunk_index"]).count() == 0


# ---------------------------------------------------------------- 7
def brute_lines(rows, least=3, share=0.05):
    docs, seen = {}, {}
    for i, s, t in rows:
        s = (s or "").strip().lower()
        if i is None or t is None or not s:
            continue
        docs.setdefault(s, set()).add(i)
        for k, line in enumerate(re.split(r"\r?\n", t), 1):
            key = "".join(c for c in line.lower() if c.isalpha())
            if key:
                seen.setdefault((s, key), set()).add((i, k))
    out = set()
    for (s, _), at in seen.items():
        n = len({i for i, _ in at})
        if n >= least and n >= share * len(docs[s]) - 1e-9:
            out |= at
    return out


def test_repeated_lines_match_brute_force(spark):
    rng = random.Random(2)
    furniture = ["Thank you for reading!", "Share | Print | Save", "All rights remain with the writers of this archive, who ask you kindly to keep them", "ok", "===", "12 34"]
    rows = []
    for i in range(220):
        lines = [" ".join(rng.choice(["sea", "wind", "lamp", "door", "night", "stone"]) + str(rng.randrange(9)) for _ in range(rng.randrange(1, 14))) for _ in range(rng.randrange(1, 6))]
        for f in furniture:
            if rng.random() < 0.08:
                lines.insert(rng.randrange(len(lines) + 1), rng.choice([f, f.upper(), f"  {f} *", f.replace(" ", " ")]))
        rows.append((str(i), rng.choice(["One", " one", "ONE ", "two", None, " "]), rng.choice(["\n", "\r\n"]).join(lines)))
    rows += rows[:9] + [("x", "two", None), ("y", "two", ""), (None, "two", "Thank you for reading!")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id string, source_archive string, text string, line_no int")
    got = {(r.id, r.line_no) for r in line_dedup.repeated_lines(df).collect()}
    assert got == brute_lines(rows) and got
    clean = {(r.id, r.source): r.text_clean for r in line_dedup.without_repeated_lines(df).collect()}
    i, s, t = rows[0]
    kept = [x for k, x in enumerate(re.split(r"(?<=\n)", t), 1) if (i, k) not in got]
    assert clean[i, s.strip().lower() if s and s.strip() else None] == "".join(kept)
    assert line_dedup.repeated_lines(df.limit(0)).count() == 0


def test_chunks_do_not_depend_on_what_stands_around():
    line = "pleasesharethisstorywitheveryfriendyouhave"
    alone = line_dedup.Chunks(line)
    first, count = alone.within(np.array([0]), np.array([len(line)]))
    own = alone.hashes(alone.ends[first[0] : first[0] + count[0]], alone.ends[first[0] + 1 : first[0] + count[0] + 1]).tolist()
    assert own
    for before, after in (("", "x"), ("abc", ""), ("theseawascalm", "andgrey"), ("s" * 50, line)):
        run = line_dedup.Chunks(before + line + after)
        whole = run.hashes(run.ends[:-1], run.ends[1:]).tolist()
        assert any(whole[k : k + len(own)] == own for k in range(len(whole)))
        a, b = np.array([len(before)]), np.array([len(before) + len(line)])
        assert run.hashes(a, b)[0] == alone.hashes(np.array([0]), np.array([len(line)]))[0]


def test_repeated_text_inside_a_longer_line_is_cut(spark):
    rng = random.Random(7)
    notice = "Please share this story with every friend you have, and come back soon!"
    prose = [" ".join(rng.choice(["sea", "wind", "lamp", "door", "night", "stone", "grey", "walk"]) + str(rng.randrange(9)) for _ in range(30)) for _ in range(60)]
    rows = [(str(i), "one", f"{p}\n{notice}") for i, p in enumerate(prose)]
    rows += [("x", "one", f"{prose[0][:40]}; {notice.upper()} {prose[1][:40]}\nThe end"), ("y", "two", f"He said: {notice} And went."), ("z", None, notice), ("w", "one", None), ("v", "one", "")]
    got = {r.id: r for r in line_dedup.without_repeated_lines(spark.createDataFrame(rows, "id string, source_archive string, text string")).collect()}
    assert got["x"].text_clean == f"{prose[0][:40]}; ! {prose[1][:40]}\nThe end" and (got["x"].n_removed, got["x"].n_inside) == (0, 1)
    assert got["0"].text_clean == prose[0] + "\n" and got["0"].n_removed == 1
    assert got["y"].text_clean == rows[-4][2] and got["z"].text_clean == notice and got["w"].text_clean is None and got["v"].text_clean == ""
    assert line_dedup.without_repeated_lines(spark.createDataFrame([], "id string, source_archive string, text string")).count() == 0


# ---------------------------------------------------------------- 8
@pytest.mark.parametrize("seed", range(5))
def test_plan_places_every_item(seed):
    rng = random.Random(seed)
    cap = rng.choice([10, 64, 512])
    hist = {s: rng.randrange(1, 30) for s in rng.sample(range(1, cap + 1), min(cap, 40))}
    load, count = {}, {}
    for size, first_item, items, first, each in packing.plan(hist, cap):
        for k in range(items):
            b = first + k // each
            load[b] = load.get(b, 0) + size
            count[size, first_item + k] = count.get((size, first_item + k), 0) + 1
    assert all(v <= cap for v in load.values()) and set(count.values()) == {1}
    assert len(count) == sum(hist.values()) and sorted(load) == list(range(len(load)))
    total = sum(s * n for s, n in hist.items())
    assert len(load) <= 1.35 * -(-total // cap) + 2 or sum(n for s, n in hist.items() if 2 * s > cap) > 0.7 * len(load)


def test_packed_items(spark):
    rng = random.Random(0)
    rows = [(i, rng.choice([0, 1, 7, 30, 64, 65, 200, 128])) for i in range(300)]
    items = spark.createDataFrame(rows + [(None, 5)], "id bigint, tokens bigint")
    limits = spark.createDataFrame([("a", 64), ("b", 50), ("c", 0), ("d", None)], "limit_name string, capacity_tokens int")
    got = packing.packed(items, limits).collect()
    for name, cap in (("a", 64), ("b", 50)):
        mine = [r for r in got if r.limit_name == name]
        by_doc, by_bin = {}, {}
        for r in mine:
            by_doc.setdefault(r.id, []).append((r.piece_no, r["size"]))
            by_bin[r.container] = by_bin.get(r.container, 0) + r["size"]
        assert {i: sum(s for _, s in v) for i, v in by_doc.items()} == dict(rows)
        assert all([k for k, _ in sorted(v)] == list(range(len(v))) for v in by_doc.values())
        assert max(by_bin.values()) <= cap and all(len(v) == 1 for i, v in by_doc.items() if dict(rows)[i] <= cap)
    assert {r.limit_name for r in got} == {"a", "b"}
    assert packing.packed(items.limit(0), limits).count() == 0


def test_documents_are_packed_by_tokens(spark):
    docs = spark.createDataFrame([(1, PROSE * 9, 5), (2, "", 5), (3, None, 5), (4, PROSE, 5), (4, PROSE, 5)], "doc_id bigint, text string, size int")
    limits = spark.createDataFrame([("s", 100)], "limit_name string, capacity_tokens int")
    placed = packing.pack_documents(docs, limits).collect()
    sizes = {r.id: r.tokens for r in tokens.sized(docs.select(F.col("doc_id").alias("id"), "text"), ["id"]).collect()}
    assert {r.doc_id for r in placed} == {1, 2, 3, 4} and sizes[2] == sizes[3] == 0
    assert sum(r["size"] for r in placed if r.doc_id == 1) == sizes[1] > 100
    report = packing.report(packing.pack_documents(docs, limits)).first()
    assert report.fullest <= 100 and report.n_containers >= report.least_containers


def test_long_runs_are_counted_quickly():
    enc = tokens.encoder(tokens.DEFAULT)
    assert tokens.count_tokens(enc, "x" * 60_000) > 1000 and tokens.count_tokens(enc, None) == 0


# ---------------------------------------------------------------- 9
def test_mixture_meets_shares(spark):
    rng = random.Random(5)
    rows = [(i, rng.choices(["a", "b", "c", "d", None], [60, 25, 10, 5, 3])[0], rng.randrange(0, 400)) for i in range(4000)]
    docs = spark.createDataFrame(rows, "id bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("a", 0.2, 1), ("b", 0.3, 2), ("c", 0.3, 3), ("d", 0.2, 4), ("e", 0.0, 2)], "source string, target_share double, max_repeats int")
    got = mixing.balanced(docs, targets).collect()
    assert len(got) == len(rows)
    total = sum(r.copies * r.tokens for r in got)
    cap = {"a": 1, "b": 2, "c": 3, "d": 4}
    for s, share in (("a", 0.2), ("b", 0.3), ("c", 0.3), ("d", 0.2)):
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.copies * r.tokens for r in mine) / total - share) < 0.003
        assert max(r.copies for r in mine) <= cap[s] and all(r.rate <= cap[s] + 1e-9 for r in mine)
    assert all(r.copies == 0 for r in got if r.source is None or not r.tokens)
    # the tilt: within a source log(rate) is linear in the tokens wherever the cap is not met
    free = [(r.tokens, np.log(r.rate)) for r in got if r.source == "a" and 0 < r.rate < 0.999]
    x, y = np.array(free).T
    assert np.abs(np.polyval(np.polyfit(x, y, 1), x) - y).max() < 1e-6


def test_mixture_without_targets(spark):
    docs = spark.createDataFrame([(1, "a", 5)], "id bigint, source string, tokens bigint")
    none = spark.createDataFrame([], "source string, target_share double, max_repeats int")
    assert [r.copies for r in mixing.balanced(docs, none).collect()] == [0]
    one = spark.createDataFrame([("a", 0.5, None), ("z", 0.5, 2)], "source string, target_share double, max_repeats int")
    assert [r.copies for r in mixing.balanced(docs, one).collect()] == [1]
    assert mixing.balanced(docs.limit(0), one).count() == 0


# ---------------------------------------------------------------- 10
SAME = [
    "The café by the sea, fine.",
    "Ｔｈｅ café by the sea, fine.",
    "The café by the sea, ﬁne.",
    "Thе sаfé".replace("sаf", "саf") + " by the sea, fine.",
    "The café by the　sea, fine.",
    "The ca­fé by​ the sea, fine⁠.",
    "Тhe café by the sea, fine.﻿",
]
OTHER = ["The cafe by the sea, fine.", "the café by the sea, fine.", "The café  by the sea, fine.", "The café by the sea; fine.", "The café by the sea, fine"]


def test_lookalikes(spark):
    texts = SAME + OTHER + ["", None, "...", "…"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(50, SAME[0], "x"), (3, SAME[3], "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, look string")
    same = [i for i in range(len(SAME))] + [50]
    want = {(a, b) for a in same for b in same if a < b and (a, b) != (0, 50)}
    assert {(r.id_a, r.id_b) for r in confusables.lookalike_pairs(df).collect()} == want
    forms = {r.id: r for r in confusables.look_classes(df).collect()}
    assert len({forms[i].text_unified for i in same}) == 1 and forms[len(SAME)].class_size == 1
    assert confusables.lookalike_pairs(df.limit(0)).count() == 0


def test_repair_needs_a_dominant_script():
    assert confusables.repaired("саfé", "Latin") == confusables.repaired("саfé", "Cyrillic") == "café"
    assert confusables.repaired("моpе", "Latin") == "море"
    assert confusables.repaired("море", "Latin") == "море"
    assert confusables.repaired("а", "Latin") == "a" and confusables.repaired("а", "Cyrillic") == "а"
    assert confusables.repaired("жv", "Greek") == confusables.repaired("жν", "Greek")
    assert confusables.doubtful_tokens("junto al рі́o grande") == [("рі́o", "río")]
    assert confusables.dominant("аАoO 12") is None and confusables.dominant("сafe") == "Latin"


def test_the_vocabulary_decides(spark):
    rows = [(1, "the harbour of Lundz"), (2, "the harbour of Lundz сlоud"), (3, "the harbour of Lundz сloud"), (4, "a fоg"), (5, "the fire"), (6, "аn fire"), (7, "a mіst")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    forms = {r.id: r.text_unified for r in confusables.look_classes(df).collect()}
    assert forms[2] == forms[3] == "the harbour of Lundz cloud"  # two spellings of a word
    assert forms[4] == "a fоg" and forms[7] == "a mіst"  # no other text holds the word
    assert {(r.id_a, r.id_b) for r in confusables.lookalike_pairs(df).collect()} == {(2, 3)}
    more = df.union(spark.createDataFrame([(8, "fog and mist"), (9, "a fog")], df.schema))
    forms = {r.id: r.text_unified for r in confusables.look_classes(more).collect()}
    assert forms[4] == "a fog" and forms[7] == "a mist"
    assert {(r.id_a, r.id_b) for r in confusables.lookalike_pairs(more).collect()} == {(2, 3), (4, 9)}


def test_pairs_of_any_spelling_match_the_shapes(spark):
    """Texts whose letters are swapped at random pair exactly if their letters' shapes are equal."""
    rng = random.Random(4)
    foreign = {}
    for a, b in confusables.SHAPES.items():
        foreign.setdefault(b, []).append(a)
    words = ["Echo", "Pico", "harbour", "cave", "spice", "oyster", "море", "сосна", "κύμα", "νερό", "AB", "x"]
    docs = []
    for k in range(40):
        base = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 7)))
        docs += ["".join(rng.choice(foreign[c]) if c in foreign and rng.random() < 0.3 else c for c in base) for _ in range(3)]
    shape = lambda t: "".join(confusables.SHAPES.get(c, c) for c in unicodedata.normalize("NFD", t))
    want = {(i, j) for i in range(len(docs)) for j in range(i + 1, len(docs)) if docs[i] != docs[j] and shape(docs[i]) == shape(docs[j])}
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    assert {(r.id_a, r.id_b) for r in confusables.lookalike_pairs(df).collect()} == want and len(want) > 60


def test_emoji_keep_their_joiners():
    flag = "\U0001f3f3️‍\U0001f308"
    assert confusables.fold(f"a {flag} b‍") == f"a {flag} b"
