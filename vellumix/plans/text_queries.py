"""Queries over texts: cleaning, metrics, scores, tags, screening, duplicates; each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumix.functions import metrics, scoring, text
from vellumix.operators import analytics, captions, dedup, facets, screening
from vellumix.plans import catalog
from vellumix.storage import table, texts, written

QUERIES: dict = {}
SQL: dict[str, str] = {}

W = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\p{Z}]"
TOKEN = r"[\p{L}\p{N}_]+(?:''[\p{L}\p{N}_]+)?"
BARE = r"[\p{L}\p{N}_]+"


def q(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{W}+|{W}+$', '', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{W}+', ' ', 'g'), ' ')"


def quoted_list(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


WHOLE, HEAD = "coalesce(text, '') AS t", "substr(coalesce(text, ''), 1, 15000) AS t"
DOCS = f"d AS (SELECT *, {WHOLE} FROM documents)"
METRICS = rf"""{DOCS},
w AS (SELECT *, regexp_extract_all(lower(t), '{TOKEN}') AS ws,
  coalesce(list_sum(list_transform(regexp_extract_all(t, '["“][^"”]+["”]'), lambda s: len(regexp_extract_all(s, '{BARE}')))), 0) AS quoted,
  greatest(1, len(list_filter(regexp_split_to_array(t, '[.!?]+(?:{W}+|\z)'), lambda p: {strip('p')} <> ''))) AS sents,
  len(list_filter(string_split(t, chr(10) || chr(10)), lambda p: {strip('p')} <> '')) AS paras, {strip('t')} = '' AS blank FROM d),
m AS (SELECT *, CASE WHEN blank THEN 0 ELSE len(ws) END AS word_count, CASE WHEN blank THEN 0 ELSE length(t) END AS char_count,
  CASE WHEN blank THEN 0 ELSE sents END AS sentence_count, CASE WHEN blank THEN 0 ELSE paras END AS paragraph_count,
  CASE WHEN blank THEN 0 ELSE round(len(ws) / sents, 1) END AS avg_sentence_len,
  CASE WHEN blank THEN 0 ELSE round(quoted / greatest(len(ws), 1), 3) END AS dialogue_ratio,
  CASE WHEN blank THEN 0 ELSE round(len(list_distinct(ws)) / greatest(len(ws), 1), 3) END AS ttr,
  CASE WHEN blank THEN 0 ELSE round(len(list_filter(ws, lambda x: x IN {quoted_list(metrics.SENSE_WORDS)})) / greatest(len(ws), 1), 4) END AS sensory_density,
  CASE WHEN blank THEN 0 ELSE round(len(list_filter(ws, lambda x: regexp_matches(x, '^(?:{metrics.MARKED_WORDS})\b'))) / greatest(len(ws), 1), 4) END AS marked_density,
  CASE WHEN blank THEN 0 ELSE round(len(ws) / 150.0, 1) END AS audio_min FROM w)"""
METRIC_NAMES = ["word_count", "char_count", "sentence_count", "paragraph_count", "avg_sentence_len", "dialogue_ratio", "ttr", "sensory_density", "marked_density", "audio_min"]


def _ladder(x: str, steps: list) -> str:
    lit = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return "CASE " + " ".join(f"WHEN {x} < {b} THEN {lit(r)}" for b, r in steps[:-1]) + f" ELSE {lit(steps[-1][1])} END"


QUALITY = METRICS + rf""",
f AS (SELECT *, (paragraph_count <= 1 AND word_count > 100) AS wall, (paragraph_count < 3 AND word_count > 300) AS few,
  regexp_matches(t, '<[^>]+>|https?://|[*~=]{{3,}}') AS marks, NOT regexp_matches(t, '\p{{Lu}}') AS no_upper, NOT regexp_matches(t, '[.!?]') AS no_stop,
  len(regexp_extract_all(t, '\b[A-Z]{{4,}}\b')) > 5 AS shouting, (paragraph_count > 0 AND word_count > 250 * paragraph_count) AS dense,
  len(regexp_extract_all(t, '[$#@&%_~^`|\\]')) > 3 AS odd, regexp_matches(t, '!{{2,}}|\?{{2,}}|\.{{4,}}') AS repeated,
  (avg_sentence_len < 7 AND word_count > 300) AS choppy FROM m),
s AS (SELECT *,
  greatest(0.0, least(20.0, 20.0 + CASE WHEN wall THEN -10 WHEN few THEN -5 ELSE 0 END + CASE WHEN marks THEN -6 ELSE 0 END + CASE WHEN no_upper THEN -8 ELSE 0 END + CASE WHEN no_stop THEN -6 ELSE 0 END + CASE WHEN shouting THEN -4 ELSE 0 END))::DOUBLE AS formatting,
  greatest(0.0, least(20.0, {_ladder('word_count', scoring.LENGTH_SCORES)} + CASE WHEN dense THEN -4 ELSE 0 END))::DOUBLE AS structural,
  greatest(0.0, least(25.0, CASE WHEN word_count < 100 THEN 4 ELSE 10 END + CASE WHEN word_count < 100 THEN 0 WHEN ttr >= 0.45 THEN 6 WHEN ttr >= 0.35 THEN 4 WHEN ttr < 0.25 THEN -4 ELSE 0 END + CASE WHEN sensory_density >= 0.025 THEN 9 WHEN sensory_density >= 0.015 THEN 6 WHEN sensory_density >= 0.008 THEN 3 ELSE 0 END))::DOUBLE AS prose,
  (CASE WHEN dialogue_ratio BETWEEN 0.15 AND 0.45 THEN 15 WHEN dialogue_ratio >= 0.08 AND dialogue_ratio < 0.15 THEN 12 WHEN dialogue_ratio > 0.45 AND dialogue_ratio <= 0.65 THEN 11 WHEN dialogue_ratio < 0.08 THEN 7 ELSE 6 END)::DOUBLE AS dialogue,
  greatest(0.0, least(20.0, 20.0 + CASE WHEN avg_sentence_len > 35 THEN -8 WHEN avg_sentence_len > 25 THEN -4 WHEN choppy THEN -4 ELSE 0 END + CASE WHEN no_stop THEN -8 ELSE 0 END + CASE WHEN odd THEN -5 ELSE 0 END + CASE WHEN repeated THEN -3 ELSE 0 END))::DOUBLE AS readability FROM f),
g AS (SELECT *, round(formatting + structural + prose + dialogue + readability, 1) AS total FROM s),
qs AS (SELECT *, CASE WHEN total >= 78 THEN 'Tier 1' WHEN total >= 62 THEN 'Tier 2' WHEN total >= 45 THEN 'Tier 3' ELSE 'Tier 4' END AS tier FROM g)"""


def _docs(s, d):
    return texts(s, d, "documents")


def _metrics(s, d, text_col="text"):
    return metrics.with_metrics(_docs(s, d), text_col)


def _quality(s, d):
    return scoring.with_quality(_metrics(s, d), "text")


@q("text_metrics", f"WITH {METRICS} SELECT doc_id, {', '.join(f'{c}::INT AS {c}' if c.endswith('_count') else c for c in METRIC_NAMES)} FROM m")
def text_metrics(s, d):
    return _metrics(s, d).select("doc_id", "metrics.*")


@q("windowed_density", f"WITH {METRICS.replace(WHOLE, HEAD)} SELECT doc_id, ttr, sensory_density, marked_density FROM m")
def windowed_density(s, d):
    """Over the window of its SQL, by the operator's own parameter; ``text_metrics`` has the same values of whole texts."""
    return metrics.with_metrics(_docs(s, d), "text", scan_chars=catalog.SCAN_CHARS["density"]).select("doc_id", "metrics.ttr", "metrics.sensory_density", "metrics.marked_density")


@q("word_frequency_topk", f"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS word FROM documents) GROUP BY word ORDER BY n DESC, word LIMIT 100")
def word_frequency_topk(s, d):
    return metrics.word_frequency(_docs(s, d), "text", 100)


@q("quality_scores", f"WITH {QUALITY} SELECT doc_id, formatting, structural, prose, dialogue, readability, total, tier FROM qs")
def quality_scores(s, d):
    return _quality(s, d).select("doc_id", *[f"quality.{c}" for c in ("formatting", "structural", "prose", "dialogue", "readability", "total", "tier")])


@q("quality_tier_distribution", f"WITH {QUALITY} SELECT lower(lang) AS lang, tier, count(*) AS n, round(avg(total), 4) AS avg_total, sum(word_count)::BIGINT AS words FROM qs GROUP BY 1, 2")
def quality_tier_distribution(s, d):
    return _quality(s, d).groupBy(F.lower("lang").alias("lang"), "quality.tier").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("quality.total"), 4).alias("avg_total"), F.sum("metrics.word_count").alias("words"))


_PENALTIES = [("wall", "no_paragraphs"), ("NOT wall AND few", "few_paragraphs"), ("marks", "markup_left"), ("no_upper", "no_capitals"), ("no_stop", "no_punctuation"), ("shouting", "shouting"), ("word_count < 150", "fragment"), ("word_count >= 150 AND word_count < 400", "very_short"), ("dense", "dense_paragraphs"), ("word_count < 100", "too_short_for_prose"), ("word_count >= 100 AND ttr < 0.25", "repetitive"), ("sensory_density < 0.008", "few_sense_words"), ("dialogue_ratio < 0.08", "little_dialogue"), ("dialogue_ratio > 0.65", "mostly_dialogue"), ("avg_sentence_len > 35", "long_sentences"), ("avg_sentence_len <= 25 AND choppy", "choppy"), ("no_stop", "no_sentence_ends"), ("odd", "odd_symbols"), ("repeated", "repeated_marks")]


@q("quality_penalties", f"WITH {QUALITY}, p AS (SELECT unnest([{', '.join(f'CASE WHEN {c} THEN {chr(39)}{k}{chr(39)} END' for c, k in _PENALTIES)}]) AS penalty FROM qs) SELECT penalty, count(*) AS n FROM p WHERE penalty IS NOT NULL GROUP BY penalty")
def quality_penalties(s, d):
    return _quality(s, d).select(F.explode_outer("quality.penalties").alias("penalty")).filter("penalty IS NOT NULL").groupBy("penalty").agg(F.count(F.lit(1)).alias("n"))


def _raw(s, d):
    """Distinct deliveries of raw stories; the narrow columns that queries need."""
    return texts(s, d, "raw_stories").select("id", "title", "author", "text", "tags", "source_url", "source_archive", "created_date", "ingested_at")


_HEADERS = [h.replace("'", "''") for h in text.HEADER_LINES]


def _cleaned(x: str) -> str:
    for bad, good in text.MOJIBAKE:
        x = f"replace({x}, '{bad}', '{good.replace(chr(39), chr(39) * 2)}')"
    x = f"replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    x = rf"regexp_replace(regexp_replace(regexp_replace({x}, '(?i)<br\s*/?>', chr(10), 'g'), '(?i)</p>', chr(10) || chr(10), 'g'), '<[^>]+>', '', 'g')"
    for h in (*_HEADERS, *text.RELAY_LINES):
        x = f"regexp_replace({x}, '(?im){h}', '', 'g')"
    return rf"array_to_string(list_filter(list_transform(regexp_split_to_array({x}, '\n{W}*\n+'), lambda p: {strip('p')}), lambda p: p <> ''), chr(10) || chr(10))"


@q("clean_text", f"SELECT DISTINCT id, source_archive, {_cleaned('text')} AS clean FROM raw_stories")
def clean_text(s, d):
    return _raw(s, d).select("id", "source_archive", text.clean_text(F.col("text"), entities=False).alias("clean")).distinct()


@q("clean_text_full")
def clean_text_full(s, d):
    """With entities and compatibility forms, which SQL cannot resolve; headers in the first 3,000 characters."""
    return _raw(s, d).select("id", "source_archive", text.clean_text(F.col("text"), 3000).alias("clean")).distinct()


def _head(p: str) -> str:
    return strip(f"regexp_extract(t, '(?im){p}', 1)")


_KNOWN_T, _KNOWN_A = quoted_list(text.UNKNOWN_TITLES), quoted_list(text.UNKNOWN_AUTHORS)


@q(
    "header_metadata",
    rf"""WITH r AS (SELECT DISTINCT id, coalesce(title, '') AS ti, coalesce(author, '') AS au, replace(text, chr(13), '') AS t FROM raw_stories),
h AS (SELECT *, {_head(r'^subject:[ \t]*(?:\[story\]|\(story\))?[ \t]*(.*)$')} AS su, {_head(r'^title:[ \t]*(.*)$')} AS tt, {_head(r'^(?:by|author):[ \t]*(.*)$')} AS bya,
  {_head(r'^from:[ \t]*(?:.*?<.*?>|\S+)[ \t]*\((.*?)\)$')} AS fr, {strip(r"regexp_extract(t, '(?i)\(c\)[ \t]*(?:\d{4})?[ \t]*[" + chr(34) + "'']?([A-Za-z \\t]+)[" + chr(34) + "'']?', 1)")} AS co FROM r)
SELECT DISTINCT id, CASE WHEN lower(ti) NOT IN {_KNOWN_T} THEN ti WHEN su <> '' AND lower(su) NOT IN {_KNOWN_T} THEN su WHEN tt <> '' THEN tt WHEN su <> '' THEN su ELSE ti END AS title,
 CASE WHEN lower(au) NOT IN {_KNOWN_A} THEN au WHEN bya <> '' THEN bya WHEN fr <> '' THEN fr WHEN length(co) > 2 THEN co ELSE au END AS author FROM h""",
)
def header_metadata(s, d):
    raw = F.replace(F.col("text"), F.lit("\r"), F.lit(""))
    return _raw(s, d).select("id", text.header_title(raw, F.col("title")).alias("title"), text.header_author(raw, F.col("author")).alias("author")).distinct()


HASH = f"CASE WHEN {squeeze('lower(coalesce(text, ' + chr(39) * 2 + '))')} = '' THEN '' ELSE sha256({squeeze('lower(coalesce(text, ' + chr(39) * 2 + '))')}) END"


@q("normalized_hash", f"SELECT doc_id, {HASH} AS hash FROM documents")
def normalized_hash(s, d):
    return _docs(s, d).select("doc_id", text.normalized_hash(F.col("text")).alias("hash"))


@q("exact_duplicates", f"WITH h AS (SELECT doc_id, {HASH} AS hash FROM documents), c AS (SELECT hash, min(doc_id) AS f, count(*) AS n FROM h WHERE hash <> '' GROUP BY hash) SELECT doc_id AS id, CASE WHEN f <> doc_id THEN f END AS dup_of, n AS cluster_size FROM h JOIN c USING (hash)")
def exact_duplicates(s, d):
    return dedup.exact_copies(_docs(s, d), "doc_id", "text")


@q("cluster_members", f"WITH h AS (SELECT doc_id, {HASH} AS hash FROM documents), c AS (SELECT hash, min(doc_id) AS cluster_id, count(*) AS n_members FROM h WHERE hash <> '' GROUP BY hash) SELECT cluster_id, n_members, doc_id AS member FROM h JOIN c USING (hash) WHERE n_members > 1")
def cluster_members(s, d):
    """A row for each member: a list of them would be one unbounded row for a text that a third of the rows share."""
    copies = dedup.exact_copies(_docs(s, d), "doc_id", "text").filter("cluster_size > 1")
    return copies.select(F.coalesce("dup_of", "id").alias("cluster_id"), F.col("cluster_size").alias("n_members"), F.col("id").alias("member"))


@q(
    "best_of_cluster",
    "WITH r AS (SELECT id, exact_hash, quality_total, row_number() OVER (PARTITION BY exact_hash ORDER BY quality_total DESC NULLS LAST, id) AS k FROM stories WHERE exact_hash IS NOT NULL) SELECT id, exact_hash, quality_total FROM r WHERE k = 1",
)
def best_of_cluster(s, d):
    rows = table(s, d, "stories").select("id", "exact_hash", "quality_total").filter("exact_hash IS NOT NULL")
    return dedup.best_of_cluster(rows, "exact_hash", "quality_total", "id")


PART = r"(?i)\b(?:part|chapter|ch\.|pt\.)\s*(\d+)(?:\s*(?:of|/)\s*(\d+))?"


@q(
    "series_detection",
    rf"""WITH t AS (SELECT id, coalesce(title, '') AS ti FROM stories), p AS (SELECT *, regexp_extract(ti, '{PART}', 1) AS n, regexp_extract(ti, '{PART}', 2) AS m,
 regexp_replace(regexp_replace(ti, '(?i)[\(\[\{{]?(?:part|chapter|ch\.|pt\.)\s*\d+.*$', '', 'g'), '^[ \-:\[\]()]+|[ \-:\[\]()]+$', '', 'g') AS base FROM t)
SELECT id, n <> '' AS is_series, CASE WHEN n <> '' AND base <> '' THEN base ELSE ti END AS series_name, CASE WHEN n <> '' THEN n::INT ELSE 1 END AS part_number, CASE WHEN n <> '' AND m <> '' THEN m::INT END AS total_parts FROM p""",
)
def series_detection(s, d):
    return table(s, d, "stories").select("id", text.series_parts(F.col("title")).alias("p")).select("id", "p.*")


STRONG, WEAK = r"(?i)(?:all rights remain|thank you for reading|https?://|^from:\s+\S+@)", r"(?i)(?:^note:|archive|e-?mail|share)"


@q("chrome_lines", rf"SELECT DISTINCT id, array_to_string(list_filter(list_transform(regexp_split_to_array(text, '\r?\n|\r'), lambda x: {strip('x')}), lambda x: x <> '' AND NOT regexp_matches(x, '{STRONG}') AND NOT (length(x) < 200 AND regexp_matches(x, '{WEAK}'))), ' ') AS body FROM raw_stories")
def chrome_lines(s, d):
    return _raw(s, d).select("id", text.without_chrome(F.col("text"), STRONG, WEAK).alias("body")).distinct()


def _last(sep: str) -> str:
    return f"(CASE WHEN instr(reverse(cut), '{sep[::-1]}') > 0 THEN length(cut) - instr(reverse(cut), '{sep[::-1]}') - 1 ELSE -1 END)"


@q("clip_to_sentence", f"WITH x AS (SELECT doc_id, {squeeze('coalesce(text, ' + chr(39) * 2 + ')')} AS t FROM documents), c AS (SELECT *, substr(t, 1, 400) AS cut FROM x) SELECT doc_id, CASE WHEN length(t) <= 400 THEN t " + " ".join(f"WHEN {_last(p)} > 200 THEN substr(cut, 1, {_last(p)} + 1)" for p in (". ", "! ", "? ")) + " ELSE cut END AS clip FROM c")
def clip_to_sentence(s, d):
    return _docs(s, d).select("doc_id", text.clipped(F.col("text"), 400).alias("clip"))


@q("excerpts", f"SELECT doc_id, CASE WHEN length(coalesce(text, '')) > 250 THEN {strip('substr(text, 1, 250)')} || '...' ELSE coalesce(text, '') END AS excerpt FROM documents")
def excerpts(s, d):
    return _docs(s, d).select("doc_id", text.excerpt(F.col("text")).alias("excerpt"))


@q(
    "error_signatures",
    rf"""WITH e AS (SELECT {strip(r"regexp_replace('not a number: ' || id || ' at ' || ingested_at::VARCHAR, '[0-9]+', '#', 'g')")} AS signature FROM raw_stories WHERE try_cast(id AS BIGINT) IS NULL),
n AS (SELECT substr(signature, 1, 200) AS signature, count(*) AS n FROM e GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, signature) AS k FROM n)
SELECT signature, n FROM r WHERE k <= 3 UNION ALL SELECT 'other', sum(n)::BIGINT FROM r WHERE k > 3 HAVING sum(n) IS NOT NULL""",
)
def error_signatures(s, d):
    bad = table(s, d, "raw_stories").filter(F.col("id").isNotNull() & F.col("id").try_cast("bigint").isNull())
    message = F.concat(F.lit("not a number: "), "id", F.lit(" at "), F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss"))
    return analytics.capped_signatures(bad.withColumn("s", text.error_signature(message)), "s", 3)


def _soft(x: str) -> str:
    for p, new in captions.SOFTENED:
        x = f"regexp_replace({x}, '(?i){p}', '{new}', 'g')"
    return x


@q("phrase_substitution", f"SELECT doc_id, md5({_soft('coalesce(text, ' + chr(39) * 2 + ')')}) AS soft_md5, NOT regexp_matches({_soft('coalesce(text, ' + chr(39) * 2 + ')')}, '(?i)(?:{'|'.join(captions.BANNED)})') AS compliant FROM documents")
def phrase_substitution(s, d):
    soft = text.substituted(F.col("text"), captions.SOFTENED)
    return _docs(s, d).select("doc_id", F.md5(soft).alias("soft_md5"), text.free_of(soft, captions.BANNED).alias("compliant"))


@q("wrapped_lines")
def wrapped_lines(s, d):
    """A fold over the words, which SQL could only express by recursion; tested against a loop."""
    return _docs(s, d).select("doc_id", text.wrapped(F.col("title"), 34).alias("lines"))


_SEC = "(doc_id % 100000) / 7.0"


@q("clock_formats", f"WITH x AS (SELECT doc_id, {_SEC} AS s FROM documents), y AS (SELECT *, floor(s) AS w FROM x) SELECT doc_id, printf('%02d:%02d:%02d,%03d', floor(w / 3600)::INT, floor(w % 3600 / 60)::INT, (w % 60)::INT, least(round((s - w) * 1000), 999)::INT) AS srt, printf('%d:%02d:%02d.%02d', floor(w / 3600)::INT, floor(w % 3600 / 60)::INT, (w % 60)::INT, least(round((s - w) * 100), 99)::INT) AS ass FROM y")
def clock_formats(s, d):
    sec = F.expr("(doc_id % 100000) / 7.0D")
    return _docs(s, d).select("doc_id", text.clock(sec, "srt").alias("srt"), text.clock(sec, "ass").alias("ass"))


@q("speech_markup", "SELECT doc_id, '<speak>' || array_to_string(list_transform(string_split(translate(coalesce(text, ''), '“”’', '\"\"'''), chr(10) || chr(10)), lambda p: '<p>' || p || '</p>'), '<break time=\"650ms\"/>') || '</speak>' AS markup FROM documents")
def speech_markup(s, d):
    return _docs(s, d).select("doc_id", text.speech_markup(F.col("text")).alias("markup"))


@q("json_arrays", "SELECT id, coalesce(len(CASE WHEN json_valid(tropes) THEN from_json(tropes, '[\"VARCHAR\"]') END), 0)::INT AS n_tropes, coalesce(array_to_string(CASE WHEN json_valid(quality_penalties) THEN from_json(quality_penalties, '[\"VARCHAR\"]') END, ','), '') AS penalties FROM stories")
def json_arrays(s, d):
    return table(s, d, "stories").select("id", F.size(text.json_strings(F.col("tropes"))).alias("n_tropes"), F.array_join(text.json_strings(F.col("quality_penalties")), ",").alias("penalties"))


# ---------------------------------------------------------------- screening
_T = "coalesce(text, '')"
_AGE = [p.replace("(?!\\s*(?:o'clock|minutes|hours|pages))", "") for p in screening.AGE]


def _terms(patterns) -> str:
    return "list_distinct(list_transform(regexp_extract_all(" + _T + ", '(?i)(?:" + "|".join(f"(?:{p})" for p in patterns).replace("'", "''") + ")'), lambda x: lower(x)))"


_RULES = screening.RuleSet(age=tuple(_AGE), prohibited=(r"\bgutter trash\b", r"\bporn\b"), review=(r"\bfools?\b", r"\bnuisance\b"))
VERDICT = f"v AS (SELECT doc_id, coalesce(text, '') AS t, {_terms(_RULES.age)} AS a, {_terms(_RULES.prohibited)} AS p, {_terms(_RULES.review)} AS r FROM documents), u AS (SELECT doc_id, CASE WHEN len(a) > 0 THEN 'AGE' WHEN len(p) > 0 THEN 'PROHIBITED' WHEN len(r) > 0 THEN 'REVIEW' ELSE 'PASS' END AS verdict, array_to_string(list_sort(list_distinct(list_concat(list_concat(a, p), r))), ',') AS terms FROM v)"


@q("safety_verdicts", f"WITH {VERDICT} SELECT * FROM u")
def safety_verdicts(s, d):
    return screening.with_verdict(_docs(s, d), "text", rules=_RULES).select("doc_id", "safety.verdict", F.array_join("safety.terms", ",").alias("terms"))


@q("safety_negation")
def safety_negation(s, d):
    """With the scope of negators and look-ahead guards, for which SQL has no match offsets; tested on cases."""
    return screening.with_verdict(_docs(s, d), "text", rules=screening.DEFAULT, negation=True).select("doc_id", "safety.verdict", F.array_join("safety.terms", ",").alias("terms"))


@q("tag_screen", "SELECT DISTINCT id, array_to_string(list_sort(list_distinct(list_filter(flatten(list_transform(coalesce(tags, []), lambda t: list_concat(regexp_extract_all(lower(t), '[a-z0-9]+'), [regexp_replace(lower(t), '[^a-z0-9]', '', 'g')]))), lambda x: x IN ('romance', 'letters', 'slowburn', 'military')))), ',') AS hits FROM raw_stories")
def tag_screen(s, d):
    hits = screening.tag_hits(F.col("tags"), ("romance", "letters", "slowburn", "military"))
    return _raw(s, d).select("id", F.array_join(F.array_sort(hits), ",").alias("hits")).distinct()


@q(
    "verdict_measure",
    "WITH t AS (SELECT safety_verdict AS verdict, count(*) AS n FROM stories GROUP BY 1), r AS (SELECT safety_verdict AS verdict, word_count, row_number() OVER (PARTITION BY safety_verdict ORDER BY word_count) AS k, count(*) OVER (PARTITION BY safety_verdict) AS m FROM stories WHERE word_count IS NOT NULL) SELECT t.verdict, n, round(100.0 * n / (SELECT count(*) FROM stories), 1) AS pct, word_count AS median_words FROM t LEFT JOIN r ON t.verdict = r.verdict AND k = m // 2 + 1 WHERE t.verdict IS NOT NULL",
)
def verdict_measure(s, d):
    return analytics.verdict_measure(table(s, d, "stories"), "safety_verdict", "word_count").filter("verdict IS NOT NULL")


@q("verdict_by_label", "SELECT safety_verdict AS verdict, is_unsafe, count(*) AS n FROM review_labels l JOIN stories s ON l.story_id = s.id GROUP BY 1, 2")
def verdict_by_label(s, d):
    labels = table(s, d, "review_labels").select(F.col("story_id").alias("id"), "is_unsafe")
    return table(s, d, "stories").select("id", "safety_verdict").join(labels, "id").groupBy(F.col("safety_verdict").alias("verdict"), "is_unsafe").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- tags
def _labels(x: str, rules: dict[str, str]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN regexp_matches({x}, '\\b(?:{p})\\b') THEN '{k}' END" for k, p in rules.items()) + "], lambda x: x IS NOT NULL)"


TAGS = (
    METRICS
    + f""",
a AS (SELECT *, lower(' ' || ' ' || t) AS al, regexp_extract_all(substr(lower(t), 1, 3000), '{BARE}') AS tok FROM m),
c AS (SELECT *, len(list_filter(tok, lambda x: x IN {quoted_list(scoring.I_WORDS)})) AS ni, len(list_filter(tok, lambda x: x IN {quoted_list(scoring.YOU_WORDS)})) AS ny, len(list_filter(tok, lambda x: x IN {quoted_list(scoring.THEY_WORDS)})) AS nt FROM a),
tg AS (SELECT doc_id, CASE WHEN len({_labels('al', scoring.THEMES)}) = 0 THEN ['other'] ELSE {_labels('al', scoring.THEMES)} END AS themes, {_labels('al', scoring.ROLES)} AS roles, {_labels('al', scoring.PLACES)} AS places,
 {_ladder('marked_density', scoring.LEVELS)} AS level, CASE WHEN ny > ni AND ny > nt THEN 'Second Person' WHEN ni > nt * 0.8 THEN 'First Person' ELSE 'Third Person' END AS pov,
 CASE WHEN dialogue_ratio > 0.35 AND avg_sentence_len < 16 THEN 'Fast' WHEN dialogue_ratio < 0.15 OR avg_sentence_len > 24 THEN 'Slow' ELSE 'Medium' END AS pacing, {_ladder('word_count', scoring.DURATIONS)} AS duration FROM c)"""
)


def _tagged(s, d):
    return scoring.with_tags(_metrics(s, d), "text")


@q("taxonomy_tags", f"WITH {TAGS} SELECT doc_id, array_to_string(themes, ',') AS themes, array_to_string(roles, ',') AS roles, array_to_string(places, ',') AS places, level, pov, pacing, duration FROM tg")
def taxonomy_tags(s, d):
    return _tagged(s, d).select("doc_id", *[F.array_join(f"taxonomy.{c}", ",").alias(c) for c in ("themes", "roles", "places")], "taxonomy.level", "taxonomy.pov", "taxonomy.pacing", "taxonomy.duration")


@q("tag_distribution", f"WITH {TAGS}, x AS (SELECT 'theme' AS dim, unnest(themes) AS label FROM tg UNION ALL SELECT 'role', unnest(roles) FROM tg UNION ALL SELECT 'place', unnest(places) FROM tg) SELECT dim, label, count(*) AS n FROM x GROUP BY 1, 2")
def tag_distribution(s, d):
    one = lambda dim, c: F.transform(F.col(f"taxonomy.{c}"), lambda x: F.struct(F.lit(dim).alias("dim"), x.alias("label")))
    return _tagged(s, d).select(F.inline_outer(F.concat(one("theme", "themes"), one("role", "roles"), one("place", "places")))).filter("dim IS NOT NULL").groupBy("dim", "label").agg(F.count(F.lit(1)).alias("n"))


@q(
    "narration_data",
    f"WITH {QUALITY}{TAGS[len(METRICS):]}, n AS (SELECT q.doc_id, q.word_count, q.dialogue_ratio AS d, q.total, q.t, tg.roles FROM qs q JOIN tg ON q.doc_id = tg.doc_id) "
    "SELECT doc_id, round(word_count / 150.0, 1) AS minutes, round(greatest(0.0, least(100.0, total * 0.95::DOUBLE + CASE WHEN d BETWEEN 0.15 AND 0.40 THEN 5.0 ELSE 0.0 END))::VARCHAR::DECIMAL(30, 15), 1)::DOUBLE AS suitability, round(d * 100.0, 1) AS dialogue_pct, "
    + "CASE " + " ".join(f"WHEN list_contains(roles, '{r}') THEN '{v}'" for r, v in scoring.VOICES) + " ELSE 'neutral' END AS voice, "
    + "CASE WHEN d > 0.35 THEN 'dynamic' WHEN d < 0.12 THEN 'narration' ELSE 'balanced' END AS pacing_tag, greatest(1, ceil(word_count / 350.0))::INT AS segments, "
    + f"CASE WHEN length(t) > 250 THEN {strip('substr(t, 1, 250)')} || '...' ELSE t END AS excerpt FROM n",
)
def narration_data(s, d):
    rows = scoring.with_tags(_quality(s, d), "text")
    return rows.select("doc_id", scoring.narration(F.col("text"), F.col("metrics"), F.col("quality"), F.col("taxonomy.roles")).alias("n")).select("doc_id", "n.*")


def _mention_part(etype: str, rules: dict[str, str]) -> str:
    low = "lower(substr(coalesce(preview, ''), 1, 6000))"
    return f"SELECT id AS story_id, '{etype}' AS etype, unnest({_labels(low, rules)}) AS label FROM stories"


@q("entity_extraction", " UNION ALL ".join(_mention_part(e, r) for e, r in facets.TABLES.items()))
def entity_extraction(s, d):
    return facets.mentions(texts(s, d, "stories"), "id", "preview")


# ---------------------------------------------------------------- duplicates
SHINGLES = f"w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{BARE}') AS ws FROM documents), sh AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(ws) - 2, 2)::BIGINT), lambda i: array_to_string(ws[i:i + 3], ' ')))) END AS s FROM w)"


@q("shingle_jaccard_pairs", f"WITH {SHINGLES}, c AS (SELECT min(doc_id) AS id, s FROM sh WHERE len(s) > 0 GROUP BY s), f AS (SELECT id, len(s) AS n, unnest(s) AS x FROM c), p AS (SELECT a.id AS id_a, b.id AS id_b, a.n AS na, b.n AS nb, count(*) AS k FROM f a JOIN f b ON a.x = b.x AND a.id < b.id GROUP BY ALL) SELECT id_a, id_b, round(k / (na + nb - k), 4) AS similarity FROM p WHERE k / (na + nb - k) >= 0.8")
def shingle_jaccard_pairs(s, d):
    return dedup.similar_pairs(_docs(s, d), "doc_id", "text")


SIGNATURE = f"{SHINGLES}, h AS (SELECT doc_id, list_transform(s, lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT) AS h FROM sh), g AS (SELECT doc_id, CASE WHEN len(h) = 0 THEN list_transform(range(64), lambda i: 0::BIGINT) ELSE list_transform(range(1, 65), lambda i: list_min(list_transform(h, lambda x: ((i * 10007 + 3) % 4294967311 * x + (i * 20011 + 7) % 4294967311) % 4294967311))) END AS sig FROM h)"


def _signatures(s, d):
    return _docs(s, d).select("doc_id", dedup.minhash64("text").alias("sig"))


@q("minhash64_signature", f"WITH {SIGNATURE} SELECT doc_id, array_to_string(sig, ',') AS sig FROM g")
def minhash64_signature(s, d):
    return _signatures(s, d).select("doc_id", F.array_join(F.col("sig").cast("array<string>"), ",").alias("sig"))


@q("lsh_band_candidates", f"WITH {SIGNATURE}, c AS (SELECT min(doc_id) AS id, sig FROM g GROUP BY sig), b AS (SELECT id, k AS band, sig[4 * k + 1:4 * k + 4] AS key FROM c, range(16) r(k)), p AS (SELECT a.id AS id_a, z.id AS id_b, min(a.band)::INT AS band FROM b a JOIN b z ON a.band = z.band AND a.key = z.key AND a.id < z.id GROUP BY ALL) SELECT id_a, id_b, band, len(list_filter(list_zip(x.sig, y.sig), lambda e: e[1] = e[2])) / 64 AS estimate FROM p JOIN c x ON x.id = id_a JOIN c y ON y.id = id_b")
def lsh_band_candidates(s, d):
    return dedup.band_candidates(written(_signatures(s, d), "sig"), "doc_id", "sig")


@q("near_dup_greedy")
def near_dup_greedy(s, d):
    """The order-dependent greedy choice, which SQL could only express by recursion; tested against a loop."""
    return dedup.deduplicated(_docs(s, d), "doc_id", "text")


@q("near_dup_banded")
def near_dup_banded(s, d):
    """The greedy choice over banded sketches; no SQL for its hashes and its order; tested against a loop."""
    return dedup.deduplicated_banded(_docs(s, d), "doc_id", "text")


@q("minhash128_signature")
def minhash128_signature(s, d):
    """Hashed with blake2b and unsigned wrap-around arithmetic, neither of which SQL has; tested against a loop."""
    return _docs(s, d).select("doc_id", F.array_join(dedup.minhash128("text").cast("array<string>"), ",").alias("sig"))


@q(
    "stored_signature_agreement",
    "WITH x AS (SELECT id, dup_of, hex(sig) AS h FROM stories WHERE sig IS NOT NULL) SELECT a.id, a.dup_of, len(list_filter(range(128), lambda i: substr(a.h, 8 * i + 1, 8) = substr(b.h, 8 * i + 1, 8))) / 128 AS agreement FROM x a JOIN x b ON a.dup_of = b.id",
)
def stored_signature_agreement(s, d):
    rows = table(s, d, "stories").filter("sig IS NOT NULL").select("id", "dup_of", dedup.stored_signature("sig").alias("sig"))
    dup = rows.filter("dup_of IS NOT NULL")
    return dup.join(rows.select(F.col("id").alias("dup_of"), F.col("sig").alias("other")), "dup_of").select("id", "dup_of", dedup.agreement(F.col("sig"), F.col("other")).alias("agreement"))


@q("resume_anti_join", "SELECT DISTINCT id FROM raw_stories WHERE id IS NOT NULL AND (try_cast(id AS BIGINT) IS NULL OR try_cast(id AS BIGINT) NOT IN (SELECT id FROM stories))")
def resume_anti_join(s, d):
    known = table(s, d, "stories").select(F.col("id").cast("string").alias("id"))
    return dedup.unseen(table(s, d, "raw_stories").select("id").filter("id IS NOT NULL").distinct(), known, "id").select("id")


# ---------------------------------------------------------------- chunks, cues, scripts
@q("narration_chunks")
def narration_chunks(s, d):
    """Greedy packing with a count that starts anew, which SQL could only express by recursion; tested against a loop."""
    return captions.narration_chunks(_docs(s, d), "doc_id", "text")


LINES = f"l AS (SELECT DISTINCT id, chunk_index, text FROM chunk_texts WHERE text IS NOT NULL), n AS (SELECT *, round(len(regexp_extract_all(text, '{BARE}')) / 150.0 * 60, 1) AS d FROM l), c AS (SELECT *, row_number() OVER w AS cue_no, round(coalesce(sum(d + 0.25) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 0.5, 3) AS start_sec FROM n WINDOW w AS (PARTITION BY id ORDER BY chunk_index))"


def _cues(s, d):
    lines = table(s, d, "chunk_texts").filter("text IS NOT NULL").select("id", "chunk_index", "text").distinct()
    seconds = F.round(F.size(F.regexp_extract_all("text", F.lit(text.BARE_WORD), F.lit(0))) / 150.0 * 60, 1)
    cues = captions.cue_times(lines, "id", "chunk_index", seconds, F.lit(0.25))
    return cues.withColumn("speaker", F.when(F.col("chunk_index") == 0, "NARRATOR").otherwise(F.concat(F.lit("voice "), F.col("chunk_index").cast("string"))))


@q("cue_timeline", f"WITH {LINES} SELECT id, chunk_index, cue_no::INT AS cue_no, start_sec, round(start_sec + d, 3) AS end_sec FROM c")
def cue_timeline(s, d):
    return _cues(s, d).select("id", "chunk_index", "cue_no", "start_sec", "end_sec")


def _clock(x: str) -> str:
    return f"printf('%02d:%02d:%02d,%03d', floor({x} / 3600)::INT, floor(floor({x}) % 3600 / 60)::INT, (floor({x}) % 60)::INT, least(round(({x} - floor({x})) * 1000), 999)::INT)"


@q("srt_captions", f"WITH {LINES}, e AS (SELECT *, round(start_sec + d, 3) AS end_sec FROM c) SELECT id, md5(string_agg(cue_no || chr(10) || {_clock('start_sec')} || ' --> ' || {_clock('end_sec')} || chr(10) || CASE WHEN chunk_index = 0 THEN '' ELSE '[voice ' || chunk_index || '] ' END || text || chr(10), chr(10) ORDER BY cue_no)) AS srt_md5 FROM e GROUP BY id")
def srt_captions(s, d):
    return captions.srt(_cues(s, d), "id", "speaker", "text").select("id", F.md5("srt").alias("srt_md5"))


@q("ass_captions")
def ass_captions(s, d):
    """Wrapped lines come from a fold that SQL lacks; tested against a loop."""
    return captions.ass_events(_cues(s, d), "id", "speaker", "text")


@q(
    "script_adaptation",
    rf"""WITH x AS (SELECT doc_id AS id, substr(coalesce(title, ''), 1, 40) AS title, {_soft("coalesce(text, '')")} AS t FROM documents), y AS (SELECT *, list_filter(list_transform(regexp_split_to_array(t, '[.\n!?]+'), lambda p: {strip('p')}), lambda p: length(p) > 10) AS s, NOT regexp_matches(t, '(?i)(?:{'|'.join(captions.BANNED)})') AS compliant FROM x),
z AS (SELECT *, unnest(range(least(4, len(s)))) AS line_no FROM y) SELECT id, title, substr(s[1], 1, 70) AS hook, line_no::INT AS line_no, CASE WHEN line_no = 0 THEN 'NARRATOR' ELSE 'CHARACTER_' || line_no END AS speaker, CASE WHEN line_no = 0 THEN 'NARRATOR' WHEN line_no % 2 = 1 THEN 'LEAD' ELSE 'SECOND' END AS role, substr(s[line_no + 1], 1, 120) AS line, compliant FROM z""",
)
def script_adaptation(s, d):
    return captions.scripts(_docs(s, d), "doc_id", "text", "title")


@q(
    "batch_manifest",
    "WITH b AS (SELECT id, title, quality_total FROM stories WHERE is_canonical = 1 AND safety_verdict = 'PASS' AND quality_tier = 'Tier 1: Master Candidate' AND quality_total >= 75 ORDER BY quality_total DESC, id LIMIT 20) SELECT 'batch_001' AS batch, count(*) AS n_items, string_agg(id || ':' || coalesce(title, '') || ':' || quality_total::DECIMAL(5, 1), '|' ORDER BY id) AS items FROM b",
)
def batch_manifest(s, d):
    """The best-ranked stories as one JSON document; a report of fixed length."""
    best = analytics.ranked_candidates(table(s, d, "stories"), ["Tier 1: Master Candidate"], 75.0, 20, ("quality_total",))
    made = captions.manifest(best, "batch_001", ["id", "title", "quality_total"], "id")
    items = F.from_json("items", "array<struct<id:bigint,title:string,quality_total:double>>")
    line = lambda x: F.concat_ws(":", x.id.cast("string"), F.coalesce(x.title, F.lit("")), x.quality_total.cast("decimal(5,1)").cast("string"))
    return made.select("batch", "n_items", F.array_join(F.transform(items, line), "|").alias("items"))


@q("catalog_build")
def catalog_build(s, d):
    """The whole chain over raw stories, one delivery of each: clean, screen, measure, score, tag, de-duplicate."""
    one = _raw(s, d).filter(F.col("id").try_cast("bigint").isNotNull()).groupBy(F.col("id").cast("bigint").alias("id")).agg(F.max_by(F.struct("title", "author", "text", "tags", "source_archive", "created_date"), "ingested_at").alias("r"))
    return catalog.build(one.select("id", "r.*"))
