import math
import re

from pyspark.sql import functions as F

from vellumix.functions import metrics, text


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in rows.select("i", expr(F.col("t")).alias("x")).orderBy("i").collect()]


def test_strip_and_squeeze_are_unicode(spark):
    assert column(spark, ["  a b \u0085", "", None], lambda c: text.squeeze(text.text_or_empty(c))) == ["a b", "", ""]


def test_words_keep_accents_and_inner_apostrophes(spark):
    assert column(spark, ["Don't été_1 naïve"], text.words) == [["don't", "été_1", "naïve"]]


def test_cleaning(spark):
    raw = "From: a@b.example\nSubject: X\n<p>One&nbsp;two</p>\r\n\r\n\r\n===== \nâ€™tis<br/>three"
    assert column(spark, [raw, None, ""], lambda c: text.clean_text(c)) == ["One two\n\n'tis\nthree", "", ""]


def test_cleaning_scans_only_the_head_for_headers(spark):
    raw = "x" * 30 + "\nSubject: stays"
    assert column(spark, [raw], lambda c: text.clean_text(c, 20)) == [raw]
    assert column(spark, [raw], lambda c: text.clean_text(c)) == ["x" * 30]


def test_wrapped_matches_a_loop(spark):
    def loop(t, width):
        lines, line = [], ""
        for w in t.split():
            if len(line) + len(w) + bool(line) <= width:
                line = f"{line} {w}" if line else w
            else:
                lines += [line] if line else []
                line = w
        return "\\N".join(lines + ([line] if line else []))

    cases = ["the quick brown fox jumps over", "a", "", "extraordinarilylongword and more words", "aa bb cc dd ee"]
    assert column(spark, cases, lambda c: text.wrapped(c, 9)) == [loop(c, 9) for c in cases]


def test_clock(spark):
    rows = spark.createDataFrame([(0.0,), (3661.5,), (59.9996,)], "s double")
    assert [tuple(r) for r in rows.select(text.clock(F.col("s"), "srt"), text.clock(F.col("s"), "ass")).collect()] == [("00:00:00,000", "0:00:00.00"), ("01:01:01,500", "1:01:01.50"), ("00:00:59,999", "0:00:59.99")]


def test_clip_and_excerpt(spark):
    t = "One two. " + "x" * 30
    assert column(spark, [t, "short"], lambda c: text.clipped(c, 12)) == ["One two.", "short"]
    assert column(spark, ["ab " * 100, None], lambda c: text.excerpt(c, 6)) == ["ab ab...", ""]


def test_series(spark):
    got = column(spark, ["Harbour - Part 3 of 9", "Plain", None], text.series_parts)
    assert [tuple(g) for g in got] == [(True, "Harbour", 3, 9), (False, "Plain", 1, None), (False, "", 1, None)]


def test_headers_fill_unknown_titles_and_authors(spark):
    raw = "Subject: [STORY] The Ferry\nFrom: x@y.example (Ann Lee)\nbody"
    df = spark.createDataFrame([(raw, "Unknown", ""), (raw, "Own", "Me")], "r string, t string, a string")
    got = df.select(text.header_title(F.col("r"), F.col("t")), text.header_author(F.col("r"), F.col("a"))).collect()
    assert [tuple(g) for g in got] == [("The Ferry", "Ann Lee"), ("Own", "Me")]


def test_json_default(spark):
    assert column(spark, ['["a","b"]', "nonsense", None], text.json_strings) == [["a", "b"], [], []]


def test_metrics_match_python(spark):
    samples = ['"Go now," she said. He left! Then\n\nnothing.', "", "  \n", "one", None, "a.b... c?!"]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, t string")
    got = {r.i: r.metrics for r in metrics.with_metrics(rows, "t").collect()}
    for i, s in enumerate(samples):
        s = s or ""
        words = re.findall(r"\w+(?:'\w+)?", s.lower())
        if not s.strip():
            assert all(v == 0 for v in got[i])
            continue
        assert got[i].word_count == len(words)
        assert got[i].sentence_count == max(1, sum(1 for x in re.split(r"[.!?]+(?:\s+|$)", s) if x.strip()))
        quoted = sum(len(re.findall(r"\w+", q)) for q in re.findall(r'["“][^"”]+["”]', s))
        assert math.isclose(got[i].dialogue_ratio, round(quoted / len(words), 3))


def test_upper_median(spark):
    rows = spark.createDataFrame([(1,), (5,), (9,), (20,)], "x int")
    assert rows.agg(metrics.upper_median(F.col("x"))).first()[0] == 9


def test_windowed_density_uses_the_operators_window(spark, tmp_path, monkeypatch):
    from vellumix.plans import text_queries

    seen, inner = [], metrics.with_metrics
    monkeypatch.setattr(metrics, "with_metrics", lambda *a, **k: seen.append(k.get("scan_chars")) or inner(*a, **k))
    texts = ["warm cold " * 50 + "x " * 400, "   " * 300 + "warm", None, "warm y"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.ttr, r.sensory_density) for r in text_queries.windowed_density(spark, str(tmp_path)).collect()}
    assert seen == [500] and got == {0: (0.02, 1.0), 1: (0.0, 0.0), 2: (0.0, 0.0), 3: (1.0, 0.5)}


def test_metrics_over_the_references_window(spark):
    rows = spark.createDataFrame([("warm " * 3000 + "stone " * 3000,), ("warm " * 1000 + "stone " * 1000,)], "t string")
    wide = [r.metrics for r in metrics.with_metrics(rows, "t", scan_chars=15_000).collect()]
    assert [m.sensory_density for m in wide] == [1.0, 0.5] and [m.word_count for m in wide] == [6000, 2000]
