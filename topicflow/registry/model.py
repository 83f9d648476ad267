"""Queries over vectors and topics: embeddings, topic descriptions, noise, quality, search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import ClusterParams
from ..operators import clustering, embeddings, hierarchy, neighbours, outliers, quality, search, topics
from ..functions.tree import spanning_forest
from ..functions.vectors import cosine_distance, cosine_similarity
from ..plans import fit, train, tune
from . import sql as S
from .base import query, rounded


@query("cosine_similarity", """
    SELECT doc_id, round(list_cosine_similarity(embedding, centroid), 6) AS similarity,
           round(1 - list_cosine_similarity(embedding, centroid), 6) AS distance
    FROM emb JOIN cent USING (topic)""", "emb cent")
def _(v):
    both = v.emb.join(v.centroids, "topic")
    sim, dist = (f(F.col("embedding"), F.col("centroid")) for f in (cosine_similarity, cosine_distance))
    return rounded(both.select("doc_id", sim.alias("similarity"), dist.alias("distance")))


_TERM_PARTS = """
    SELECT doc_id, unnest(w) AS term FROM words1
    UNION ALL
    SELECT doc_id, tok || ' ' || nxt AS term FROM (
        SELECT doc_id, tok, lead(tok) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM (
            SELECT doc_id, unnest(w) AS tok, generate_subscripts(w, 1) AS i FROM words1)) WHERE nxt IS NOT NULL"""

_HASHED = f"""
    , words1 AS MATERIALIZED (SELECT conv_id * 1000 + turn AS doc_id, {S.tokens(S.clean('text'), (), 1)} AS w FROM conversations),
    occ AS MATERIALIZED (SELECT doc_id, ('0x' || substr(md5(term), 1, 8))::BIGINT AS n FROM ({_TERM_PARTS})),
    idf AS (SELECT n % 262144 AS bucket, ln(((SELECT count(*) FROM words1) + 1) / (count(DISTINCT doc_id) + 1)::DOUBLE) + 1 AS idf FROM occ GROUP BY 1),
    cells AS (SELECT doc_id, n % 64 AS dim, sum(idf * (((n >> 18) % 2) * 2 - 1)) AS v FROM occ JOIN idf ON bucket = n % 262144 GROUP BY 1, 2),
    norms AS (SELECT doc_id, sqrt(sum(v * v)) AS norm FROM cells GROUP BY doc_id)"""


@query("embed_texts", "WITH one AS (SELECT 1)" + _HASHED + """
    SELECT w.doc_id, d.dim, round(CASE WHEN coalesce(norm, 0) = 0 THEN CASE WHEN d.dim = 0 THEN 1.0 ELSE 0.0 END ELSE coalesce(v, 0) / norm END::FLOAT::DOUBLE, 4) AS value
    FROM words1 w CROSS JOIN (SELECT unnest(range(64)) AS dim) d
    LEFT JOIN cells c ON c.doc_id = w.doc_id AND c.dim = d.dim LEFT JOIN norms n ON n.doc_id = w.doc_id""")
def _(v):
    turns = v.table("conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
    vectors = embeddings.embed_texts(turns, dims=64)
    long = vectors.select("doc_id", F.posexplode("embedding").alias("dim", "value"))
    return long.select("doc_id", F.col("dim").cast("long").alias("dim"), F.round(F.col("value").cast("double"), 4).alias("value"))


@query("embed_texts_encoder", "SELECT post_id AS doc_id, 16 AS dims, CASE WHEN regexp_matches(lower(text), '[a-p]') THEN 1.0 ELSE 0.0 END::DOUBLE AS norm FROM posts", "posts")
def _(v):
    """A user encoder (letter frequencies): one unit vector per post."""

    def encoder():
        import numpy as np

        def encode(texts):
            out = np.zeros((len(texts), 26))
            for row, text in enumerate(texts):
                raw = np.frombuffer(text.lower().encode("ascii", "ignore"), dtype=np.uint8)
                out[row] = np.bincount(raw[(raw >= 97) & (raw < 123)] - 97, minlength=26)[:26]
            return out

        return encode

    posts = v.posts.select(F.col("post_id").alias("doc_id"), "text")
    vectors = embeddings.embed_texts(posts, encoder, dims=16)
    norm = F.sqrt(F.aggregate(F.transform("embedding", lambda x: x.cast("double")), F.lit(0.0), lambda s, x: s + x * x))
    return vectors.select("doc_id", F.size("embedding").alias("dims"), F.round(norm, 3).alias("norm"))


@query("embedding_meta", "SELECT count(*) AS num_docs, max(len(embedding)) AS embedding_dim FROM embeddings")
def _(v):
    meta = embeddings.embedding_meta(v.table("embeddings"))
    return meta.select("num_docs", F.col("embedding_dim").cast("long").alias("embedding_dim"))


@query("pair_similarity_gap", f"SELECT round(same_sim, 6) AS same_sim, round(diff_sim, 6) AS diff_sim, round(same_sim - diff_sim, 6) AS gap FROM ({S.gap('emb')})", "emb")
def _(v):
    return rounded(embeddings.pair_similarity_gap(v.emb))


@query("knn_cosine", "SELECT doc_id, neighbour_id, round(similarity, 6) AS similarity, rank FROM knn", "knn")
def _(v):
    found = neighbours.knn_cosine(v.emb, 10)
    return rounded(found.withColumn("rank", F.col("rank").cast("long")))


@query("knn_cosine_cells", "SELECT doc_id, neighbour_id, round(similarity, 6) AS similarity, rank FROM knn", "knn")
def _(v):
    """The plan for vectors beyond the broadcast bound, forced by a bound of zero bytes."""
    found = neighbours.knn_cosine(v.emb, 10, broadcast_bytes=0, cells=16, block_bytes=64 * 8 * 64)
    return rounded(found.withColumn("rank", F.col("rank").cast("long")))


@query("tsp_at_k", f"SELECT round(tsp, 6) AS tsp FROM ({S.tsp('emb', 'knn')})", "emb knn")
def _(v):
    return rounded(embeddings.tsp_at_k(v.emb, 10))


@query("embedder_comparison", "\nUNION ALL\n".join(f"""
    SELECT '{name}' AS model, round(tsp, 6) AS tsp, round(same_sim, 6) AS same_sim, round(diff_sim, 6) AS diff_sim,
           round(same_sim - diff_sim, 6) AS gap, 64::BIGINT AS embedding_dim FROM ({S.tsp(vectors, near)}), ({S.gap(vectors)})"""
    for name, vectors, near in (("planted", "emb", "knn"), ("raw", "rawemb", "rawknn"))), "emb knn rawemb rawknn")
def _(v):
    """The planted vectors against the raw ones."""
    raw = v.doc_vectors.select("doc_id", F.col("e").alias("embedding"))
    raw = raw.join(v.emb.select("doc_id", "channel", "created_at"), "doc_id")
    rows = embeddings.embedder_comparison({"planted": v.emb, "raw": raw})
    return rounded(rows.drop("inference_time_seconds").withColumn("embedding_dim", F.col("embedding_dim").cast("long")))


# --- topics -----------------------------------------------------------------


@query("topic_vocabulary", "SELECT topic, term, tf, f FROM vocab", "vocab")
def _(v):
    return v.vocabulary.select("topic", "term", "tf", "f")


@query("class_tfidf", "SELECT topic, term, round(score, 8) AS score FROM ctf", "ctf")
def _(v):
    return rounded(topics.class_tfidf(v.vocabulary).select("topic", "term", "score"), 8)


@query("topic_top_words", "SELECT topic, rank, word, round(score, 8) AS score FROM words", "words")
def _(v):
    _, words = topics.describe_topics(v.topic_docs, None)
    return rounded(words.withColumn("rank", F.col("rank").cast("long")), 8)


@query("topic_centroids", "SELECT topic, i - 1 AS dim, round(v, 6) AS value FROM (SELECT topic, unnest(centroid) AS v, generate_subscripts(centroid, 1) AS i FROM cent)", "cent")
def _(v):
    cells = topics.topic_centroids(v.emb, v.topics).select("topic", F.posexplode("centroid").alias("dim", "value"))
    return rounded(cells.withColumn("dim", F.col("dim").cast("long")))


@query("topic_info", """
    SELECT topic, count, topic || '_' || (SELECT string_agg(word, '_' ORDER BY rank) FROM words w WHERE w.topic = i.topic AND rank <= 4) AS name
    FROM (SELECT topic, count(*) AS count FROM ttopics GROUP BY topic) i""", "ttopics words")
def _(v):
    return topics.topic_info(v.text_topics, v.words)


@query("largest_topics", "SELECT topic, count(*) AS count FROM ttopics WHERE topic <> -1 GROUP BY topic ORDER BY 2 DESC, 1 LIMIT 6", "ttopics")
def _(v):
    return topics.largest_topics(v.text_topics)


@query("noise_ratio", """
    SELECT count(*) AS docs, round(avg((topic = -1)::INT), 6) AS noise_ratio, round(1 - avg((topic = -1)::INT), 6) AS classified_ratio,
           count(DISTINCT topic) FILTER (topic <> -1) AS num_topics FROM ttopics""", "ttopics")
def _(v):
    return rounded(topics.noise_ratio(v.text_topics))


@query("topic_diversity", "SELECT round(count(DISTINCT word) / count(*)::DOUBLE, 6) AS topic_diversity FROM words WHERE topic <> -1", "words")
def _(v):
    return rounded(topics.topic_diversity(v.words))


@query("reduce_outliers_ctfidf", """
    SELECT doc_id, CASE WHEN topic = -1 AND score >= 0.05 THEN best ELSE topic END AS topic, round(coalesce(score, -1), 6) AS score
    FROM ttopics LEFT JOIN tscore USING (doc_id)""", "ttopics tscore")
def _(v):
    scores = v.text_scores
    moved = outliers.reassign(v.text_topics, scores, 0.05)
    return rounded(moved.join(scores, "doc_id", "left").select("doc_id", "topic", F.coalesce("score", F.lit(-1.0)).alias("score")))


_ESCORE = """
    SELECT doc_id, arg_max(topic, (s, -topic)) AS best, max(s) AS score FROM (
        SELECT e.doc_id, c.topic, round(list_cosine_similarity(e.embedding, c.centroid), 10) AS s
        FROM emb e, cent c WHERE e.topic = -1 AND c.topic <> -1) GROUP BY doc_id"""


@query("reduce_outliers_embedding", f"SELECT doc_id, CASE WHEN topic = -1 AND score >= 0.6 THEN best ELSE topic END AS topic FROM emb LEFT JOIN ({_ESCORE}) USING (doc_id)", "emb cent")
def _(v):
    return outliers.reduce_outliers_embedding(v.emb, v.topics, v.centroids)


_MOVED = f"(SELECT doc_id, topic AS t0, CASE WHEN topic = -1 AND score >= 0.64 THEN best ELSE topic END AS t1, CASE WHEN topic = -1 AND score >= 0.6 THEN best ELSE topic END AS t2 FROM emb LEFT JOIN ({_ESCORE}) USING (doc_id))"


@query("update_topics", """
    WITH moved AS MATERIALIZED (SELECT doc_id, CASE WHEN topic = -1 THEN doc_id % 20 ELSE topic END::INT AS topic FROM ttopics),
    vt AS (SELECT v.doc_id, m.topic, tok, i FROM vtok v JOIN moved m ON v.doc_id = m.doc_id),
    tc2 AS MATERIALIZED (SELECT topic, term, count(*) AS tf FROM (
        SELECT topic, tok AS term FROM vt UNION ALL
        SELECT topic, tok || ' ' || nxt FROM (SELECT topic, tok, lead(tok) OVER (PARTITION BY topic ORDER BY doc_id, i) AS nxt FROM vt) WHERE nxt IS NOT NULL)
        GROUP BY topic, term),
    vo AS MATERIALIZED (SELECT topic, term, tf, f FROM tc2 JOIN (SELECT term, sum(tf) AS f FROM tc2 GROUP BY term
        HAVING count(*) <= 0.85 * (SELECT count(DISTINCT topic) FROM tc2) ORDER BY f DESC, term LIMIT 30000) USING (term))
    SELECT topic, rank, term AS word, round(score, 8) AS score FROM (
        SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(score, 10) DESC, term) AS rank FROM (
            SELECT topic, term, tf / words::DOUBLE * ln(1 + a / f::DOUBLE) AS score FROM vo
            JOIN (SELECT topic, sum(tf) AS words FROM vo GROUP BY topic) USING (topic),
                 (SELECT floor(avg(w)) AS a FROM (SELECT sum(tf) AS w FROM vo GROUP BY topic)))) WHERE rank <= 10""".replace(
    "WITH moved", ", moved", 1), "ttopics vtok")
def _(v):
    """Words after all noise documents moved to a topic by their id."""
    moved = v.text_topics.select("doc_id", F.when(F.col("topic") == -1, F.col("doc_id") % 20).otherwise(F.col("topic")).cast("int").alias("topic"))
    words = topics.update_topics(v.docs, moved)["words"]
    return rounded(words.withColumn("rank", F.col("rank").cast("long")), 8)


@query("reassignment_report", f"""
    SELECT round(avg((t0 = -1)::INT), 6) AS noise_before, round(avg((t1 = -1)::INT), 6) AS noise_step1, round(avg((t2 = -1)::INT), 6) AS noise_after,
           round(avg((t2 = -1)::INT) - avg((t0 = -1)::INT), 6) AS delta_noise, count(*) FILTER (t0 = -1 AND t1 <> -1) AS reassigned_step1,
           count(*) FILTER (t1 = -1 AND t2 <> -1) AS reassigned_step2, count(*) FILTER (t0 = -1 AND t2 <> -1) AS reassigned_total,
           count(DISTINCT t2) FILTER (t0 = -1 AND t2 <> -1) AS receiving_topics,
           round((SELECT max(n) / sum(n)::DOUBLE FROM (SELECT count(*) AS n FROM {_MOVED} WHERE t0 = -1 AND t2 <> -1 GROUP BY t2)), 6) AS top1_share,
           (SELECT max(n) / sum(n)::DOUBLE FROM (SELECT count(*) AS n FROM {_MOVED} WHERE t0 = -1 AND t2 <> -1 GROUP BY t2)) > 0.3 AS warning
    FROM {_MOVED}""", "emb cent")
def _(v):
    """A strict step and a wider one after it."""
    first = outliers.reduce_outliers_embedding(v.emb, v.topics, v.centroids, 0.64)
    after = outliers.reduce_outliers_embedding(v.emb, first, v.centroids)
    return rounded(outliers.reassignment_report(v.topics, first, after))


@query("receiving_topics", f"""
    SELECT t2 AS topic, count(*) AS docs, round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 6) AS share FROM {_MOVED} WHERE t0 = -1 AND t2 <> -1
    GROUP BY t2""", "emb cent")
def _(v):
    return rounded(outliers.receiving_topics(v.topics, outliers.reduce_outliers_embedding(v.emb, v.topics, v.centroids)))


_ABLATION = """
    SELECT threshold, round(sum((topic = -1 AND NOT moved)::INT) / count(*)::DOUBLE, 6) AS noise_ratio,
           round(1 - sum((topic = -1 AND NOT moved)::INT) / count(*)::DOUBLE, 6) AS classified_ratio, sum(moved::INT)::BIGINT AS reassigned FROM (
        SELECT i / 100.0::DOUBLE AS threshold, topic, topic = -1 AND coalesce(score >= i / 100.0::DOUBLE AND score > 0, false) AS moved
        FROM {0} LEFT JOIN {1} USING (doc_id), range(0, 100, 5) t(i)) GROUP BY threshold"""


@query("reduce_outliers_ctfidf_blocks", "SELECT doc_id, best, round(score, 6) AS score FROM tscore", "tscore")
def _(v):
    """The same scores with the topics cut into many blocks."""
    return rounded(outliers.ctfidf_scores(v.docs, v.text_topics, v.ctfidf, block_bytes=400_000))


@query("threshold_ablation", _ABLATION.format("ttopics", "tscore"), "ttopics tscore")
def _(v):
    return rounded(outliers.threshold_ablation(v.text_topics, v.text_scores))


@query("threshold_ablation_embedding", _ABLATION.format("emb", f"({_ESCORE})"), "emb cent")
def _(v):
    return rounded(outliers.threshold_ablation(v.topics, outliers.embedding_scores(v.emb, v.topics, v.centroids)))


@query("metrics_before_after", f"""
    WITH m AS (SELECT 'before' AS stage, count(DISTINCT t0) FILTER (t0 <> -1)::DOUBLE AS num_topics, avg((t0 = -1)::INT) AS noise_ratio FROM {_MOVED}
               UNION ALL SELECT 'after', count(DISTINCT t2) FILTER (t2 <> -1)::DOUBLE, avg((t2 = -1)::INT) FROM {_MOVED})
    SELECT stage, num_topics, round(noise_ratio, 6) AS noise_ratio, round(1 - noise_ratio, 6) AS classified_ratio FROM m
    UNION ALL
    SELECT 'delta', max(num_topics) FILTER (stage = 'after') - max(num_topics) FILTER (stage = 'before'),
           round(max(noise_ratio) FILTER (stage = 'after') - max(noise_ratio) FILTER (stage = 'before'), 6),
           round(max(noise_ratio) FILTER (stage = 'before') - max(noise_ratio) FILTER (stage = 'after'), 6) FROM m""".replace("WITH m AS", ", m AS", 1), "emb cent")
def _(v):
    after = outliers.reduce_outliers_embedding(v.emb, v.topics, v.centroids)
    return rounded(outliers.metrics_before_after(topics.noise_ratio(v.topics), topics.noise_ratio(after)))


@query("reassigned_examples", f"""
    SELECT t.doc_id, -1 AS old_topic, 'Noise' AS old_words, s.best AS new_topic,
           (SELECT string_agg(word, ', ' ORDER BY rank) FROM words w WHERE w.topic = s.best AND rank <= 5) AS new_words,
           replace(substr(text_clean, 1, 150), chr(10), ' ') AS preview
    FROM ttopics t JOIN tscore s USING (doc_id) JOIN docs USING (doc_id) WHERE t.topic = -1 AND score >= 0.05
    ORDER BY {S.md5_key('t.doc_id')}, t.doc_id LIMIT 10""", "ttopics tscore words docs")
def _(v):
    after = outliers.reassign(v.text_topics, v.text_scores, 0.05)
    return outliers.reassigned_examples(v.text_topics, after, v.words, v.docs)


# --- finding topics ---------------------------------------------------------


@query("mutual_reachability", """
    SELECT k.doc_id AS src, k.neighbour_id AS dst, round(1 - similarity, 6) AS distance, round(greatest(a.core, b.core, round(1 - similarity, 10)), 6) AS reach
    FROM knn k JOIN core a ON a.doc_id = k.doc_id JOIN core b ON b.doc_id = k.neighbour_id""", "knn core")
def _(v):
    return rounded(clustering.mutual_reachability(v.knn, 5))


@query("reduce_dims")
def _(v):
    return rounded(clustering.reduce_dims(v.emb, 5).select("doc_id", F.posexplode("embedding").alias("dim", "value")), 4)


_LINKED = """
    edges AS MATERIALIZED (
        SELECT src, dst FROM (SELECT k.doc_id AS src, k.neighbour_id AS dst, greatest(a.core, b.core, round(1 - similarity, 10)) AS reach
            FROM knn k JOIN core a ON a.doc_id = k.doc_id JOIN core b ON b.doc_id = k.neighbour_id WHERE k.rank <= {depth}) WHERE reach <= {eps}),
    both_ways AS MATERIALIZED (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
    walk(id, seen) AS (SELECT src, src FROM both_ways UNION SELECT w.id, b.dst FROM walk w JOIN both_ways b ON b.src = w.seen),
    parts AS (SELECT id, min(seen) AS component FROM walk GROUP BY id)"""


@query("connected_components", f", {_LINKED.format(depth=10, eps=0.45)} SELECT id, component FROM parts", "knn core")
def _(v):
    near = clustering.mutual_reachability(v.knn, 5).where("reach <= 0.45")
    return clustering.connected_components(near)


@query("density_cluster", f""", {_LINKED.format(depth=5, eps="(SELECT quantile_disc(core, 0.9) FROM core)")},
    numbered AS (SELECT component, row_number() OVER (ORDER BY count(*) DESC, component) - 1 AS topic FROM parts GROUP BY component HAVING count(*) >= 10)
    SELECT doc_id, coalesce(numbered.topic, -1)::INT AS topic FROM emb LEFT JOIN parts ON id = doc_id LEFT JOIN numbered USING (component)""", "emb knn core")
def _(v):
    return clustering.density_cluster(v.emb, 10, 5)


CUTS = (0.3, 0.4, 0.45, 0.5)


@query("density_sweep", """
    , near AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, greatest(p.core, q.core, round(1 - list_cosine_similarity(x.embedding, y.embedding), 10)) AS reach
        FROM emb x JOIN emb y ON x.doc_id < y.doc_id JOIN core p ON p.doc_id = x.doc_id JOIN core q ON q.doc_id = y.doc_id),
    cuts(eps) AS (VALUES """ + ", ".join(f"({c}::DOUBLE)" for c in CUTS) + """),
    both_ways AS MATERIALIZED (SELECT eps, a AS src, b AS dst FROM near, cuts WHERE reach <= eps UNION ALL SELECT eps, b, a FROM near, cuts WHERE reach <= eps),
    walk(eps, id, seen) AS (SELECT eps, src, src FROM both_ways UNION SELECT w.eps, w.id, b.dst FROM walk w JOIN both_ways b ON b.src = w.seen AND b.eps = w.eps),
    parts AS (SELECT eps, id, min(seen) AS component FROM walk GROUP BY eps, id),
    sizes AS (SELECT eps, component, count(*) AS n FROM parts GROUP BY eps, component)
    SELECT eps, count(*) FILTER (n >= 10) AS clusters, coalesce(sum(n) FILTER (n >= 10), 0)::BIGINT AS clustered, max(n) AS largest FROM sizes GROUP BY eps""", "emb core")
def _(v):
    """All cuts of the density from one spanning tree; the SQL looks at every pair of documents instead."""
    points = hierarchy.reachability_points(v.emb, 5, knn=v.knn)
    return hierarchy.cut_sweep(spanning_forest(points), CUTS, 10)


@query("density_hierarchy")
def _(v):
    return rounded(hierarchy.density_hierarchy(v.emb, 10, 5, knn=v.knn).topics, 4)


@query("fit_topics")
def _(v):
    """Text and vectors of the same ids, clustered and described; top words of the found topics."""
    docs = v.emb_docs.select("doc_id", F.col("text").alias("text_lemm"))
    return rounded(fit.fit_topics(docs, v.emb, ClusterParams(10, 5, 8)).words, 4)


@query("reduce_noise_plan")
def _(v):
    docs = v.emb_docs.select("doc_id", F.col("text").alias("text_lemm"))
    model = fit.fit_topics(docs, v.emb, ClusterParams(10, 5, 8))
    return rounded(fit.reduce_noise(model, docs, v.emb)[1], 4)


@query("dbcv_core_distances", """
    SELECT doc_id, topic, round(coalesce(pow(sum(pow(d, -64)) FILTER (d > 0) / count(*), -1 / 64.0::DOUBLE), 0), 6) AS core FROM (
        SELECT a.doc_id, a.topic, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: (x[1] - x[2]) * (x[1] - x[2])))) AS d
        FROM emb a JOIN emb b ON a.topic = b.topic AND a.doc_id <> b.doc_id WHERE a.topic <> -1) GROUP BY doc_id, topic""", "emb")
def _(v):
    """The first part of the density validity: the core distance of each point among those of its topic."""
    shapes = quality.cluster_shapes(v.emb, v.topics)
    return rounded(shapes.select("doc_id", "topic", "core"))


@query("dbcv")
def _(v):
    return rounded(quality.dbcv(v.emb, v.topics), 4)


@query("coherence_cv", """
    , real AS MATERIALIZED (SELECT DISTINCT topic, word FROM words WHERE topic <> -1),
    toks AS (SELECT doc_id, string_split(text_lemm, ' ') AS w FROM docs),
    occ AS MATERIALIZED (SELECT doc_id, word, pos, greatest(1, n - 109) AS total FROM (
        SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos, len(w) AS n FROM toks) WHERE word IN (SELECT word FROM real)),
    hits AS MATERIALIZED (SELECT DISTINCT doc_id, word, unnest(range(greatest(0, pos - 109), least(pos, total - 1) + 1)) AS start FROM occ),
    size AS (SELECT sum(total)::DOUBLE AS windows FROM (SELECT DISTINCT doc_id, total FROM occ)),
    single AS MATERIALIZED (SELECT word, count(*) / any_value(windows) AS p FROM hits, size GROUP BY word),
    pairs AS (SELECT DISTINCT a.word AS a, b.word AS b FROM real a JOIN real b ON a.topic = b.topic AND a.word < b.word),
    twos AS MATERIALIZED (SELECT a, b, count(*) / any_value(windows) AS p FROM pairs JOIN hits x ON x.word = a
        JOIN hits y ON y.word = b AND y.doc_id = x.doc_id AND y.start = x.start, size GROUP BY a, b),
    known AS MATERIALIZED (SELECT topic, word, p, count(*) OVER (PARTITION BY topic) AS k FROM real JOIN single USING (word)),
    npmi AS MATERIALIZED (SELECT topic, x, y, ln((p + 1e-12) / (px * py)) / -ln(p + 1e-12) AS v FROM (
        SELECT l.topic, l.word AS x, r.word AS y, l.p AS px, r.p AS py, CASE WHEN l.word = r.word THEN l.p ELSE coalesce(b.p, 0) END AS p
        FROM known l JOIN known r ON l.topic = r.topic AND l.k >= 2 LEFT JOIN twos b ON b.a = least(l.word, r.word) AND b.b = greatest(l.word, r.word))),
    centre AS (SELECT topic, y, sum(v) AS s FROM npmi GROUP BY topic, y)
    SELECT topic, round(avg(c), 4) AS cv FROM (
        SELECT topic, x, sum(v * s) / (sqrt(sum(v * v)) * sqrt(sum(s * s))) AS c FROM npmi JOIN centre USING (topic, y) GROUP BY topic, x) GROUP BY topic
    """, "words docs")
def _(v):
    return rounded(quality.coherence_cv(v.docs, v.words, per_topic=True), 4)


@query("model_metrics")
def _(v):
    return rounded(quality.model_metrics(v.text_topics, v.words, v.docs, v.emb.select("doc_id", "embedding")), 4)


# --- experiments ------------------------------------------------------------


@query("search_trials")
def _(v):
    space = {"n_components": (6, 8), "min_cluster_size": (8, 20), "min_samples": (4, 10)}
    return rounded(fit.search_trials(v.emb, 3, space).drop("error"), 4)


@query("tune_chain")
def _(v):
    """Trials on half of the documents, the best refitted in full, the choice against the baseline."""
    docs = v.emb_docs.select("doc_id", F.col("text").alias("text_lemm"))
    space = {"n_components": (6, 8), "min_cluster_size": (4, 10), "min_samples": (3, 5)}
    half = v.emb.count() // 2
    found = tune.tune(docs, v.emb.select("doc_id", "embedding"), ClusterParams(10, 5, 8), 2, half, 1, space, coherence_min=0.0)
    return rounded(found.configs, 4)


@query("train_chain")
def _(v):
    """Posts to gates: the older model's tables stand for the model in use."""
    posts = v.posts.select("post_id", "channel", "created_at", "text")
    vectors = v.emb.select("doc_id", "embedding")
    old = train.Production(v.old_centroids, v.old_words, v.production_table, v.spark.createDataFrame([(0.1,)], "dbcv_score double"))
    run = train.train(posts, ClusterParams(10, 5, 8), old, embed=lambda d: vectors.join(d.select("doc_id"), "doc_id", "left_semi"))
    return rounded(run.gates.select("check", "new_value", "production", "passed", "verdict"), 4)


@query("rank_trials", """
    SELECT study, trial_id, round(score, 6) AS score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY study ORDER BY score DESC, trial_id) AS rank FROM trials) WHERE rank <= 10""", "trials")
def _(v):
    ranked = search.rank_trials(v.trials, 10, by=["study"])
    return rounded(ranked.select("study", "trial_id", "score", F.col("rank").cast("long").alias("rank")))


@query("top3_trials", "SELECT trial_id, round(score, 6) AS score, row_number() OVER (ORDER BY trials.score DESC, trial_id) AS rank FROM trials ORDER BY trials.score DESC, trial_id LIMIT 3", "trials")
def _(v):
    return rounded(search.rank_trials(v.trials, 3).select("trial_id", "score", F.col("rank").cast("long").alias("rank")))


@query("best_so_far", """
    SELECT study, trial_id, round(score, 6) AS score, round(max(score) OVER (PARTITION BY study ORDER BY trial_id), 6) AS best_score
    FROM (SELECT study, trial_id, max(score) AS score FROM trials GROUP BY study, trial_id)""", "trials")
def _(v):
    once = v.trials.groupBy("study", "trial_id").agg(F.max("score").alias("score"))
    return rounded(search.best_so_far(once, ["study"]))


@query("param_importance", "\nUNION ALL\n".join(f"""
    SELECT study, '{p}' AS param, round(abs(corr({p}, score)), 8) AS importance, round(regr_slope(score, {p}), 8) AS slope,
           round(regr_intercept(score, {p}), 8) AS intercept FROM trials WHERE score > -999 GROUP BY study""" for p in search.PARAMETERS), "trials")
def _(v):
    rows = search.param_importance(v.trials.where("score > -999"), ["study"])
    return rounded(rows, 8)


@query("select_config", """
    SELECT study, coalesce(arg_max('config ' || trial_id, (score, -trial_id)) FILTER (cv_coherence >= 0.75 AND dbcv IS NOT NULL), 'Baseline') AS label,
           round(max(dbcv - 0.5::DOUBLE * noise_ratio) FILTER (cv_coherence >= 0.75 AND dbcv IS NOT NULL), 6) AS final_score
    FROM trials GROUP BY study""", "trials")
def _(v):
    named = v.trials.withColumn("label", F.concat(F.lit("config "), F.col("trial_id").cast("string")))
    return rounded(search.select_config(named, by=["study"]))
