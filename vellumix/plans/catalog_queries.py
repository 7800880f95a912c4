"""Queries over the catalogue and its labels; each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumix.operators import analytics, facets, screening, search, semantic, tfidf, vectors
from vellumix.plans import catalog
from vellumix.sources import readers
from vellumix.storage import table, texts, written
from vellumix.streaming.ingest import Ingest

from .text_queries import QUERIES, SQL, q, quoted_list

__all__ = ["QUERIES", "SQL"]

OK = "is_canonical = 1 AND safety_verdict = 'PASS'"
JSON = "from_json({0}, '[\"VARCHAR\"]')"


def _cat(s, d):
    return table(s, d, "stories")


@q(
    "corpus_summary",
    f"""SELECT count(*) AS total_rows, count(*) FILTER (is_canonical = 1) AS canonical_rows, count(*) FILTER (is_canonical <> 1) AS duplicate_rows, round(100.0 * count(*) FILTER (is_canonical <> 1) / count(*), 1) AS duplicate_pct,
 count(*) FILTER ({OK}) AS passing_rows, (sum(word_count) FILTER ({OK}))::BIGINT AS passing_words, round(sum(tts_minutes) FILTER ({OK}) / 60.0, 1) AS passing_hours, round(avg(quality_total) FILTER ({OK}), 1) AS quality_avg, min(quality_total) FILTER ({OK}) AS quality_min, max(quality_total) FILTER ({OK}) AS quality_max,
 min(publication_date) FILTER ({OK} AND publication_date <> '') AS first_date, max(publication_date) FILTER ({OK} AND publication_date <> '') AS last_date, count(DISTINCT author) FILTER ({OK}) AS authors, count(DISTINCT category) FILTER (is_canonical = 1) AS categories FROM stories""",
)
def corpus_summary(s, d):
    return analytics.summary(_cat(s, d))


@q("verdict_tier_counts", "SELECT 'safety_verdict' AS dim, safety_verdict AS label, count(*) AS n FROM stories WHERE is_canonical = 1 GROUP BY 2 UNION ALL SELECT 'quality_tier', quality_tier, count(*) FROM stories WHERE is_canonical = 1 GROUP BY 2")
def verdict_tier_counts(s, d):
    return analytics.canonical_counts(_cat(s, d), ["safety_verdict", "quality_tier"])


ARRAYS, SCALARS = ["tropes", "archetypes", "settings"], ["heat_level", "pov", "pacing", "duration_tier", "category"]
_DIST = " UNION ALL ".join([f"SELECT '{a}' AS dim, unnest({JSON.format(a)}) AS label FROM stories WHERE {OK}" for a in ARRAYS] + [f"SELECT '{c}', {c}::VARCHAR FROM stories WHERE {OK}" for c in SCALARS])


@q("distributions", f"WITH x AS ({_DIST}), n AS (SELECT dim, label, count(*) AS n FROM x GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY dim ORDER BY n DESC, label NULLS LAST) AS k FROM n) SELECT dim, label, n FROM r WHERE k <= 40")
def distributions(s, d):
    return analytics.distributions(_cat(s, d), ARRAYS, SCALARS)


@q("top_authors", f"SELECT * FROM (SELECT author, count(*) AS n, coalesce(sum(word_count), 0)::BIGINT AS words FROM stories WHERE {OK} GROUP BY author ORDER BY n DESC, sum(word_count) DESC NULLS LAST, author NULLS LAST LIMIT 25) WHERE author <> ''")
def top_authors(s, d):
    return analytics.top_authors(_cat(s, d))


@q("author_attribution", f"SELECT round(100.0 * count(*) FILTER (author <> 'Unknown / Anonymous') / greatest(count(*), 1), 1) AS attribution_pct FROM stories WHERE {OK}")
def author_attribution(s, d):
    return analytics.attribution(_cat(s, d))


_CLASSES = "CASE " + " ".join(f"WHEN word_count < {b} THEN '{n}'" for b, n in analytics.LENGTH_CLASSES[:-1]) + " ELSE '16K+' END"
_NAMES = ", ".join(f"({i}, '{n}')" for i, (_, n) in enumerate(analytics.LENGTH_CLASSES))


@q("length_histogram", f"WITH c AS (SELECT {_CLASSES} AS label, count(*) AS n FROM stories WHERE {OK} GROUP BY 1) SELECT o.ord::INT AS ord, o.label, coalesce(n, 0) AS n FROM (VALUES {_NAMES}) o(ord, label) LEFT JOIN c ON c.label = o.label")
def length_histogram(s, d):
    return analytics.length_histogram(_cat(s, d))


@q("yearly_trend", f"WITH y AS (SELECT *, substr(publication_date, 1, 4) AS year FROM stories WHERE {OK}) SELECT year, count(*) AS n, round(avg(word_count)) AS avg_words, round(avg(heat_level), 2) AS avg_level, round(avg(quality_total), 1) AS avg_quality FROM y WHERE regexp_full_match(year, '[0-9]{{4}}') AND year::INT BETWEEN 1970 AND 2026 GROUP BY year")
def yearly_trend(s, d):
    return analytics.yearly(_cat(s, d))


@q(
    "label_share_by_decade",
    f"WITH x AS (SELECT publication_date, unnest({JSON.format('tropes')}) AS label FROM stories WHERE {OK}), b AS (SELECT label FROM x GROUP BY label ORDER BY count(*) DESC, label LIMIT 8), s AS (SELECT substr(publication_date, 1, 3) || '0s' AS decade, label, count(*) AS n FROM x WHERE length(publication_date) >= 4 AND label IN (SELECT label FROM b) GROUP BY 1, 2), g AS (SELECT decade, b.label FROM (SELECT DISTINCT decade FROM s), b), f AS (SELECT g.decade, g.label, coalesce(n, 0) AS n FROM g LEFT JOIN s ON g.decade = s.decade AND g.label = s.label) SELECT decade, label, round(100.0 * n / greatest(sum(n) OVER (PARTITION BY decade), 1), 1) AS pct FROM f",
)
def label_share_by_decade(s, d):
    return analytics.label_share_by_decade(_cat(s, d))


@q("top_categories_by_decade", f"WITH n AS (SELECT substr(publication_date, 1, 3) || '0s' AS decade, category AS label, count(*) AS n FROM stories WHERE {OK} AND length(publication_date) >= 4 GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY decade ORDER BY n DESC, label NULLS LAST)::INT AS rank FROM n) SELECT * FROM r WHERE rank <= 10")
def top_categories_by_decade(s, d):
    return analytics.top_by_decade(_cat(s, d))


_DIMS = ["pacing", "pov", "duration_tier", "category"]
_QDIM = " UNION ALL ".join(f"SELECT '{c}' AS dim, {c} AS label, quality_total, heat_level, word_count FROM stories WHERE {OK}" for c in _DIMS)


@q("quality_by_dimension", f"WITH x AS ({_QDIM}), n AS (SELECT dim, label, count(*) AS n, round(avg(quality_total), 1) AS avg_quality, round(avg(heat_level), 2) AS avg_level, round(avg(word_count)) AS avg_words FROM x GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY dim ORDER BY n DESC, label NULLS LAST) AS k FROM n) SELECT dim, label, n, avg_quality, avg_level, avg_words FROM r WHERE k <= 15")
def quality_by_dimension(s, d):
    return analytics.quality_by(_cat(s, d), _DIMS)


_TIERS = ["Tier 1: Master Candidate", "Tier 2: Good Secondary"]


@q("ranked_candidates", f"SELECT id, quality_total, tts_minutes FROM stories WHERE {OK} AND quality_tier IN {quoted_list(_TIERS)} AND quality_total >= 75 ORDER BY quality_total DESC, tts_minutes DESC, id LIMIT 50000")
def ranked_candidates(s, d):
    return analytics.ranked_candidates(_cat(s, d), _TIERS, by=("quality_total", "tts_minutes")).select("id", "quality_total", "tts_minutes")


@q(
    "audit_report",
    "SELECT count(*) AS n_rows, count(*) FILTER (is_canonical = 1) AS n_canonical, " + ", ".join(f"count(*) FILTER (is_canonical = 1 AND safety_verdict = '{v}') AS n_{v.lower()}" for v in ("PASS", "REVIEW", "PROHIBITED", "AGE")) + ", " + ", ".join(f"count(*) FILTER (is_canonical = 1 AND quality_tier LIKE 'Tier {k}%') AS n_tier_{k}" for k in (1, 2, 3, 4)) + ", (sum(word_count) FILTER (is_canonical = 1))::BIGINT AS canonical_words, round(sum(tts_minutes) FILTER (is_canonical = 1) / 60.0, 1) AS canonical_hours FROM stories",
)
def audit_report(s, d):
    return catalog.audit(_cat(s, d))


@q("passing_view", f"SELECT id, title, quality_tier FROM stories WHERE {OK} AND quality_tier IN {quoted_list(_TIERS)}")
def passing_view(s, d):
    return screening.passed(_cat(s, d), _TIERS).select("id", "title", "quality_tier")


@q("adhoc_filter", f"SELECT id, category, publication_date, word_count FROM stories WHERE {OK} AND category = 'letters' AND publication_date >= '2005' AND word_count >= 100")
def adhoc_filter(s, d):
    return screening.passed(_cat(s, d)).filter("category = 'letters' AND publication_date >= '2005' AND word_count >= 100").select("id", "category", "publication_date", "word_count")


# ---------------------------------------------------------------- facets
def _mentions(s, d):
    return table(s, d, "entity_mentions")


WANTED = [("setting", "old quay"), ("setting", "saltrow")]
_SEMI = " AND ".join(f"id IN (SELECT story_id FROM entity_mentions WHERE etype = '{e}' AND label = '{x}')" for e, x in WANTED)


@q("facet_counts", f"SELECT label, count(*) AS n FROM entity_mentions WHERE etype = 'setting' AND story_id IN (SELECT id FROM stories WHERE {OK}) GROUP BY label ORDER BY n DESC, label NULLS LAST LIMIT 40")
def facet_counts(s, d):
    return facets.facet_counts(_cat(s, d), _mentions(s, d), "setting")


@q("facet_counts_filtered", f"SELECT label, count(*) AS n FROM entity_mentions WHERE etype = 'character' AND story_id IN (SELECT id FROM stories WHERE {OK} AND id IN (SELECT story_id FROM entity_mentions WHERE etype = 'setting' AND label = 'old quay')) GROUP BY label ORDER BY n DESC, label NULLS LAST LIMIT 40")
def facet_counts_filtered(s, d):
    return facets.facet_counts(_cat(s, d), _mentions(s, d), "character", [("setting", "old quay")])


@q("combo_search", f"SELECT id, title, author, category, publication_date, word_count, quality_total, quality_tier FROM stories WHERE {OK} AND {_SEMI} AND word_count >= 50 ORDER BY quality_total DESC NULLS LAST, id LIMIT 50 OFFSET 2")
def combo_search(s, d):
    return facets.search(_cat(s, d), _mentions(s, d), WANTED, "word_count >= 50", 50, 2)


@q("combo_count", f"SELECT count(*) AS n FROM stories WHERE {OK} AND {_SEMI}")
def combo_count(s, d):
    return facets.count(_cat(s, d), _mentions(s, d), WANTED)


@q("label_totals", f"SELECT etype, label, count(*) AS n, count(DISTINCT story_id) AS stories FROM entity_mentions m JOIN stories s ON s.id = m.story_id AND {OK} GROUP BY 1, 2")
def label_totals(s, d):
    ids = screening.passed(_cat(s, d)).select(F.col("id").alias("story_id"))
    # distinct stories of a hot label are counted by partial sums: rows of a (label, story) are merged first
    per = _mentions(s, d).groupBy("etype", "label", "story_id").agg(F.count(F.lit(1)).alias("k")).join(ids, "story_id", "left_semi")
    return per.groupBy("etype", "label").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("stories"))


@q("story_texts", "SELECT s.id, md5(coalesce(r.text, s.preview, '')) AS text_md5 FROM stories s LEFT JOIN (SELECT try_cast(id AS BIGINT) AS id, max(text) AS text FROM raw_stories GROUP BY 1) r ON r.id = s.id")
def story_texts(s, d):
    whole = table(s, d, "raw_stories").select(F.col("id").try_cast("bigint").alias("id"), "text").groupBy("id").agg(F.max("text").alias("full_text"))
    return facets.with_full_text(_cat(s, d).select("id", "preview"), whole).select("id", F.md5("text").alias("text_md5"))


# ---------------------------------------------------------------- TF-IDF, vectors, semantics
RUN = r"[\p{L}\p{N}_]+"
TERMS = f"w AS (SELECT doc_id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '{RUN}'), lambda x: regexp_full_match(x, '[a-z]{{3,}}')) AS w FROM documents), t AS (SELECT doc_id, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || '_' || w[i + 1])) AS t FROM w)"
VOCAB = f"{TERMS}, df AS (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(t) AS term FROM t) GROUP BY term ORDER BY df DESC, term LIMIT 1024), v AS (SELECT term, df, row_number() OVER (ORDER BY df DESC, term) - 1 AS idx, ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)) + 1.0 AS idf FROM df)"
WEIGHTS = f"{VOCAB}, tf AS (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM t), c AS (SELECT doc_id, n, term, count(*) AS c FROM tf GROUP BY ALL), x AS (SELECT doc_id, idx, c / n * idf AS w FROM c JOIN v USING (term)), u AS (SELECT doc_id, idx, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS w FROM x)"


@q("tfidf_vocab", f"WITH {VOCAB} SELECT term, df, idx::INT AS idx, round(idf, 6) AS idf FROM v")
def tfidf_vocab(s, d):
    return tfidf.vocabulary(texts(s, d, "documents"), "text").select("term", "df", "idx", F.round("idf", 6).alias("idf"))


@q("tfidf_weights", f"WITH {WEIGHTS} SELECT doc_id AS id, idx::INT AS idx, w AS weight FROM u")
def tfidf_weights(s, d):
    docs = texts(s, d, "documents")
    w = tfidf.weights(docs, "doc_id", "text", written(tfidf.vocabulary(docs, "text"), "vocab"))
    return w.select("id", F.col("idx").cast("int").alias("idx"), F.col("w").alias("weight"))


QUERY = "the lighthouse by the harbour and the cook"
QTERMS = [t for t in QUERY.split() if len(t) >= 3]
QTERMS += [f"{a}_{b}" for a, b in zip(QTERMS, QTERMS[1:])]
_QVEC = "q AS (SELECT idx, round(w / sqrt(sum(w * w) OVER ()), 6) AS w FROM (SELECT idx, c / " + str(len(QTERMS)) + " * idf AS w FROM (VALUES " + ", ".join(f"('{t}', {QTERMS.count(t)})" for t in dict.fromkeys(QTERMS)) + ") z(term, c) JOIN v USING (term)))"


@q("tfidf_search", f"WITH {WEIGHTS}, {_QVEC} SELECT doc_id AS id, round(least(1.0, sum(u.w * q.w)), 4) AS similarity FROM u JOIN q USING (idx) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def tfidf_search(s, d):
    return tfidf.Index(texts(s, d, "documents"), "doc_id", "text").search(QUERY, 20)


@q("tfidf_similar", f"WITH {WEIGHTS}, o AS (SELECT min(doc_id) AS doc_id FROM u), q AS (SELECT idx, w FROM u JOIN o USING (doc_id)) SELECT u.doc_id AS id, round(least(1.0, sum(u.w * q.w)), 4) AS similarity FROM u JOIN q USING (idx) WHERE u.doc_id <> (SELECT doc_id FROM o) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def tfidf_similar(s, d):
    index = tfidf.Index(texts(s, d, "documents"), "doc_id", "text")
    first = index.weights.agg(F.min("id")).first()[0]
    return index.similar(first if first is not None else -1, 20)


@q("vector_problems", "WITH v AS (SELECT DISTINCT id, chunk_index, embedding AS e FROM chunk_vectors) SELECT CASE WHEN e IS NULL THEN 'null' WHEN len(e) <> 128 THEN 'length' WHEN len(list_filter(e, lambda x: x IS NULL)) > 0 THEN 'null_element' WHEN len(list_filter(e, lambda x: isnan(x) OR isinf(x))) > 0 THEN 'non_finite' WHEN len(list_filter(e, lambda x: x <> 0)) = 0 THEN 'zero' ELSE 'usable' END AS problem, count(*) AS n FROM v GROUP BY 1")
def vector_problems(s, d):
    why = F.coalesce(vectors.problem_of(F.col("embedding"), 128), F.lit("usable"))
    return table(s, d, "chunk_vectors").select("id", "chunk_index", why.alias("problem"), F.xxhash64("embedding").alias("h")).distinct().groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


@q("vector_normalize", "WITH n AS (SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm FROM embeddings) SELECT vec_id, round(norm, 5) AS norm, array_to_string(list_transform(e, lambda x: round(x / norm * 100000)::BIGINT), ',') AS unit FROM n")
def vector_normalize(s, d):
    v = F.transform("embedding", lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return table(s, d, "embeddings").select("vec_id", F.round(norm, 5).alias("norm"), F.array_join(F.transform(vectors.normalized(F.col("embedding")), lambda x: F.round(x * 100000).cast("bigint").cast("string")), ",").alias("unit"))


_KNN = "WITH p AS (SELECT q.vec_id AS query_id, b.vec_id AS id, list_cosine_similarity(q.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s FROM embeddings q JOIN embeddings b ON {0} q.vec_id <> b.vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, id)::INT AS rank FROM p) SELECT query_id, id, rank, round(s, 6) AS score FROM r WHERE rank <= 10"


@q("vector_topk", _KNN.format("q.vec_id = (SELECT min(vec_id) FROM embeddings) AND"))
def vector_topk(s, d):
    e = table(s, d, "embeddings")
    first = e.agg(F.min("vec_id")).first()[0]
    return vectors.top_k(e, e.filter(F.col("vec_id") == first), "vec_id", "embedding", 10, 64).select("query_id", "id", "rank", F.round("score", 6).alias("score"))


@q("vector_knn_join", _KNN.format("q.vec_id % 50 = 0 AND"))
def vector_knn_join(s, d):
    """Exact neighbours of a stated query set, in blocks, against all rows."""
    e = table(s, d, "embeddings")
    return vectors.top_k(e, e.filter("vec_id % 50 = 0"), "vec_id", "embedding", 10, 64).select("query_id", "id", "rank", F.round("score", 6).alias("score"))


@q("hit_details", "WITH h AS (SELECT id, row_number() OVER (ORDER BY quality_total DESC NULLS LAST, id) AS rank FROM stories ORDER BY rank LIMIT 25) SELECT h.rank::INT AS rank, s.id, s.title, s.quality_tier FROM h JOIN stories s USING (id)")
def hit_details(s, d):
    top = _cat(s, d).select("id", "quality_total").orderBy(F.desc_nulls_last("quality_total"), "id").limit(25)
    from pyspark.sql import Window

    hits = top.select("id", F.row_number().over(Window.orderBy(F.desc_nulls_last("quality_total"), "id")).alias("rank"))
    return facets.hit_details(hits, _cat(s, d).select("id", "title", "quality_tier")).select("rank", "id", "title", "quality_tier")


@q("zipped_chunks", "SELECT DISTINCT t.id, t.chunk_index::INT AS chunk_index, md5(t.text) AS text_md5, len(v.embedding)::INT AS dim, round(list_sum(list_transform(v.embedding, lambda x: CASE WHEN isfinite(x) THEN x::DOUBLE ELSE 0 END)), 4) AS total FROM chunk_texts t JOIN chunk_vectors v ON t.id = v.id AND t.chunk_index = v.chunk_index WHERE len(v.embedding) > 0 AND t.text IS NOT NULL")
def zipped_chunks(s, d):
    keys = ["id", "chunk_index"]
    t = table(s, d, "chunk_texts").filter("text IS NOT NULL").select(*keys, "text").dropDuplicates(keys)
    v = table(s, d, "chunk_vectors").select(*keys, "embedding").dropDuplicates(keys)
    rows = t.join(v, keys).select(*keys, F.array("text").alias("texts"), F.array("embedding").alias("vectors"))
    flat = vectors.zipped(rows.withColumnRenamed("chunk_index", "ci"), "texts", "vectors", ["id", "ci"], skip_empty=True)
    return flat.select("id", F.col("ci").cast("int").alias("chunk_index"), F.md5("chunk_text").alias("text_md5"), F.size("embedding").alias("dim"), F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.when(F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(F.coalesce(x.cast("double"), F.lit(0.0)))), 4).alias("total"))


@q("keyset_page", "SELECT id, title FROM stories WHERE id > (SELECT min(id) FROM stories) ORDER BY id LIMIT 100")
def keyset_page(s, d):
    first = _cat(s, d).agg(F.min("id")).first()[0]
    return readers.page_after(_cat(s, d).select("id", "title"), first if first is not None else 0, 100)


def _lsa(s, d):
    docs = texts(s, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return docs, semantic.Lsa.fit(docs, dims=32, vocabulary=1500)


@q("lsa_search")
def lsa_search(s, d):
    """Singular vectors have no SQL; tested by unit length and by finding a text by itself."""
    docs, model = _lsa(s, d)
    return model.search(written(model.transform(docs), "lsa"), "doc_id", QUERY, 20).select("id", F.round("score", 6).alias("score"), "rank")


@q("topic_clusters")
def topic_clusters(s, d):
    """k-means labels have no SQL; tested by their sizes."""
    docs, model = _lsa(s, d)
    return semantic.cluster_report(written(semantic.clusters(written(model.transform(docs), "lsa"), "doc_id", "topic_vector"), "clusters"))


@q("hashed_encoding", "SELECT doc_id, 256 AS dim FROM documents")
def hashed_encoding(s, d):
    return semantic.hashed_encoding(texts(s, d, "documents").select("doc_id", "text"), "text").select("doc_id", F.size("embedding").alias("dim"))


@q("text_to_chunk_search")
def text_to_chunk_search(s, d):
    """A text against the chunk texts by hashed encodings; the hash has no SQL; tested by finding a chunk by itself."""
    chunks = table(s, d, "chunk_texts").select("id", "chunk_index", "text").dropDuplicates(["id", "chunk_index"])
    encode = lambda df, text: semantic.hashed_encoding(df, text, 256)
    return search.SearchEngine(written(encode(chunks, "text"), "encoded"), encode, 256).search(QUERY, 20)


@q("compressed_round_trip", "SELECT id, md5(text) AS text_md5 FROM (SELECT DISTINCT id, text FROM raw_stories WHERE text IS NOT NULL)")
def compressed_round_trip(s, d):
    """Texts compressed, encoded, and read back."""
    raw = table(s, d, "raw_stories").select("id", "text").filter("text IS NOT NULL").distinct()
    packed = raw.select("id", F.base64(readers.deflate_udf()("text")).alias("blob"))
    return packed.select("id", F.md5(readers.from_base64("blob")).alias("text_md5"))


@q("stream_ingest")
def stream_ingest(s, d):
    """Files of raw stories as a stream, profiled into a catalogue; tested for replay and failures."""
    import uuid

    from vellumix.storage import shared_dir

    root = f"{shared_dir(s)}/ingest-{uuid.uuid4().hex}"
    raw = table(s, d, "raw_stories")
    raw.repartition(4, "id").write.parquet(f"{root}/in")
    return Ingest(root, files_per_batch=2).run(s, f"{root}/in", raw.schema)

