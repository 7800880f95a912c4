import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumix.operators import captions, facets, screening, search, semantic, tfidf, vectors


def test_verdict_order_and_gate(spark):
    rules = screening.RuleSet(prohibited=(r"\bban\b",), review=(r"\bmaybe\b",))
    rows = spark.createDataFrame([(1, "she was 12 years old", None), (2, "a ban", None), (3, "maybe", None), (4, "fine", ["under-age"]), (5, "it cost 12 coins at 12 o'clock", None), (6, None, None)], "id int, t string, tags array<string>")
    got = {r.id: r.safety.verdict for r in screening.with_verdict(rows, "t", "tags", rules).collect()}
    assert got == {1: "AGE", 2: "PROHIBITED", 3: "REVIEW", 4: "AGE", 5: "PASS", 6: "PASS"}


@pytest.mark.parametrize("age", ["a 7 year old", "seventeen years old", "turned sixteen", "aged 9", "an underage guest"])
def test_no_age_below_18_passes(spark, age):
    rows = spark.createDataFrame([(f"They met {age} there",)], "t string")
    assert screening.with_verdict(rows, "t").first().safety.verdict == "AGE"


@pytest.mark.parametrize("text", ["she was 18 years old", "turned thirty", "aged 45", "fifteen minutes"])
def test_adult_ages_pass(spark, text):
    assert screening.with_verdict(spark.createDataFrame([(text,)], "t string"), "t").first().safety.verdict == "PASS"


def test_negation_scope(spark):
    rows = spark.createDataFrame([(1, "He did not threaten her."), (2, "He would threaten her."), (3, "Not that it matters to anyone in town, he threatened them.")], "id int, t string")
    got = {r.id: r.safety.verdict for r in screening.with_verdict(rows, "t", negation=True).collect()}
    assert got == {1: "PASS", 2: "REVIEW", 3: "REVIEW"}


def test_rules_are_checked():
    with pytest.raises(ValueError):
        screening.RuleSet(review=()).checked()


def test_relational_division(spark):
    found = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (1, "b", "y"), (2, "a", "x"), (3, None, None)], "story_id bigint, etype string, label string")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    ask = lambda w: sorted(r.id for r in facets.having_all(ids, "id", found, w).collect())
    assert ask([("a", "x")]) == [1, 2] and ask([("a", "x"), ("b", "y"), ("a", "x")]) == [1] and ask([]) == [1, 2, 3]


def test_chunks_match_a_loop(spark):
    import re

    paras = ["one two three", "four five", "six " * 7, "seven eight", "nine"]
    got = captions.narration_chunks(spark.createDataFrame([(1, "\n\n".join(paras)), (2, ""), (3, None)], "id int, t string"), "id", "t", 6).orderBy("chunk_id").collect()
    want, cur, n = [], [], 0
    for p in (x.strip() for x in paras):
        k = len(re.findall(r"\w+", p))
        if n + k > 6 and cur:
            want.append(("\n\n".join(cur), n))
            cur, n = [], 0
        cur.append(p)
        n += k
    want.append(("\n\n".join(cur), n))
    assert [(r.text, r.word_count) for r in got] == want and all(r.id == 1 for r in got)
    assert got[0].markup.startswith("<speak><p>one two three</p>")


def test_cues_and_captions(spark):
    lines = spark.createDataFrame([(1, 0, "NARRATOR", "Hello there", 2.0), (1, 1, "Ann", "Yes", 1.0)], "g int, k int, speaker string, text string, d double")
    cues = captions.cue_times(lines, "g", "k", F.col("d"), F.lit(0.25))
    assert [(r.start_sec, r.end_sec) for r in cues.orderBy("k").collect()] == [(0.5, 2.5), (2.75, 3.75)]
    assert captions.srt(cues, "g", "speaker", "text").first().srt == "1\n00:00:00,500 --> 00:00:02,500\nHello there\n\n2\n00:00:02,750 --> 00:00:03,750\n[Ann] Yes\n"
    events = captions.ass_events(cues, "g", "speaker", "text").first().events.split("\n")
    assert len(events) == 3 and "<i>Hello there</i>" in events[0] and ",DialogueWhite," in events[2]


def test_vector_problems_and_validation(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, [float("nan"), 1.0]), (4, [0.0, 0.0]), (5, None), (6, [None, 1.0])], "id int, v array<float>")
    got = {r.id: r.p for r in rows.select("id", vectors.problem_of(F.col("v"), 2).alias("p")).collect()}
    assert got == {1: None, 2: "length", 3: "non_finite", 4: "zero", 5: "null", 6: "null_element"}
    with pytest.raises(Exception, match="unusable vector"):
        vectors.validated(rows, "v", 2).collect()
    with pytest.raises(ValueError):
        vectors.validated(rows, "w", 2)


def test_top_k_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 8)).astype(np.float32)
    x[7] = x[3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(99, None)], "id bigint, v array<float>")
    got = {(r.query_id, r["rank"]): r.id for r in vectors.top_k(df.repartition(5), df.filter("id < 5"), "id", "v", 4, 8).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    sims = np.round(u @ u.T, 12)
    np.fill_diagonal(sims, -9)
    for q in range(5):
        assert [got[q, k] for k in (1, 2, 3, 4)] == np.argsort(-sims[q], kind="stable")[:4].tolist()


def test_zipped_lengths_must_match(spark):
    rows = spark.createDataFrame([(1, ["a", "b"], [[1.0], []])], "id int, t array<string>, v array<array<float>>")
    assert vectors.zipped(rows, "t", "v", ["id"]).count() == 2
    assert vectors.zipped(rows, "t", "v", ["id"], skip_empty=True).count() == 1
    bad = spark.createDataFrame([(1, ["a"], [[1.0], [2.0]])], "id int, t array<string>, v array<array<float>>")
    with pytest.raises(Exception, match="differ in number"):
        vectors.zipped(bad, "t", "v", ["id"]).collect()


def test_tfidf_index(spark, tmp_path):
    items = spark.createDataFrame([(1, "Sea", "the harbour and the ferry"), (2, "Hill", "the orchard above the village"), (3, "Sea two", "harbour harbour ferry"), (4, None, None)], "id bigint, title string, body string")
    index = tfidf.Index(items, "id", "body", "title")
    assert {r.id for r in index.search("harbour ferry", 2).collect()} == {1, 3}
    assert index.search("zzz", 4).count() == 4
    assert index.similar(1, 1).first().id == 3
    index.save(str(tmp_path / "i"))
    assert tfidf.Index.load(items, "id", str(tmp_path / "i"), "title").similar(1, 1).first().id == 3


def test_lsa_finds_a_text_by_itself(spark, tmp_path):
    words = ["harbour ferry sail tide anchor", "orchard meadow plough harvest barn", "clock lantern candle shadow night"]
    rows = [(i, " ".join(np.random.default_rng(i).permutation((words[i % 3] + " the day").split()))) for i in range(30)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    model = semantic.Lsa.fit(df, dims=4, vocabulary=60, least_docs=2.0, most_share=0.99)
    got = model.transform(df).cache()
    norms = [np.linalg.norm(r.topic_vector) for r in got.collect()]
    assert np.allclose(norms, 1)
    hits = model.search(got, "id", words[1], 5).collect()
    assert all(r.id % 3 == 1 for r in hits)
    model.save(str(tmp_path / "m"))
    again = semantic.Lsa.load(str(tmp_path / "m")).search(got, "id", words[1], 5).collect()
    assert [r.id for r in again] == [r.id for r in hits]
    report = semantic.cluster_report(semantic.clusters(got, "id", "topic_vector", 3)).collect()
    assert sum(r.size for r in report) == 30


def test_hit_details_keep_rank(spark):
    hits = spark.createDataFrame([(1, 7), (2, 3), (3, 99)], "rank int, id bigint")
    cat = spark.createDataFrame([(3, "c"), (7, "g")], "id bigint, title string")
    assert [r.title for r in facets.hit_details(hits, cat).collect()] == ["g", "c"]


def test_search_engine(spark):
    encode = lambda df, text: semantic.hashed_encoding(df, text, 64)
    rows = spark.createDataFrame([(1, 0, "the ferry and the harbour"), (1, 1, "an orchard above the village"), (2, 0, "the clock struck at night")], "id bigint, chunk_index smallint, text string")
    engine = search.SearchEngine(encode(rows, "text"), encode, 64)
    assert tuple(engine.search("an orchard above the village", 1).first()[:2]) == (1, 1)
    with pytest.raises(ValueError):
        engine.search("x", 0)
    with pytest.raises(ValueError, match="encoder gives"):
        search.SearchEngine(encode(rows, "text"), lambda df, text: semantic.hashed_encoding(df, text, 32), 64).search("x")
    with pytest.raises(ValueError, match="empty"):
        search.SearchEngine(encode(rows.limit(0), "text"), encode, 64)
