"""The same views as ``views.py`` in plain SQL, for checking results with another engine."""

from __future__ import annotations

from ..functions.text import ARTIFACT_WORDS, EMOJI, MARKUP, SPACE, URL, WORD
from .views import ALL_STOP_WORDS, CORE_NEIGHBOURS


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def clean(column: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(coalesce({column}, ''), '{URL}', ' ', 'g'), "
        f"'[{EMOJI}{MARKUP}{SPACE}]+', ' ', 'g'))"
    )


def tokens(column: str, stop=ALL_STOP_WORDS, min_len: int = 3) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({column}), '{WORD}'), lambda t: length(t) >= {min_len} "
        f"AND regexp_full_match(t, '\\p{{L}}+') AND NOT list_contains({_list(stop)}, t))"
    )


def md5_key(column: str, seed: int = 42) -> str:
    return f"md5({column}::VARCHAR || '|{seed}')"




def _knn(vectors: str) -> str:
    return f"""
        SELECT doc_id, neighbour_id, similarity, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, neighbour_id) AS rank FROM (
                SELECT a.doc_id, b.doc_id AS neighbour_id, round(list_cosine_similarity(a.embedding, b.embedding), 10) AS similarity
                FROM {vectors} a JOIN {vectors} b ON a.doc_id <> b.doc_id)) WHERE rank <= 10"""


def gap(vectors: str) -> str:
    """Mean cosine of all pairs inside channels and of all pairs across channels of one table of vectors."""
    return f"""SELECT (sum(q) - sum(own)) / sum(n * (n - 1)) AS same_sim, (any_value(w) - sum(q)) / (sum(n) * sum(n) - sum(n * n)) AS diff_sim
        FROM (SELECT channel, sum(s * s) AS q FROM (
                SELECT channel, i, sum(v / nullif(len, 0)) AS s FROM (
                    SELECT channel, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i,
                           sqrt(list_sum(list_transform(embedding, lambda x: x * x))) AS len FROM {vectors}) GROUP BY channel, i) GROUP BY channel)
        JOIN (SELECT channel, count(*)::DOUBLE AS n, count(*) FILTER (list_sum(list_transform(embedding, lambda x: x * x)) > 0)::DOUBLE AS own
              FROM {vectors} GROUP BY channel) USING (channel),
             (SELECT sum(s * s) AS w FROM (
                SELECT i, sum(v / nullif(len, 0)) AS s FROM (
                    SELECT unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i,
                           sqrt(list_sum(list_transform(embedding, lambda x: x * x))) AS len FROM {vectors}) GROUP BY i))"""


def tsp(vectors: str, neighbours: str) -> str:
    """Share of the ten nearest neighbours dated within a day."""
    return f"""SELECT count(*) FILTER (abs(date_diff('day', a.created_at, b.created_at)) <= 1) / ((SELECT count(*) FROM {vectors}) * 10.0::DOUBLE) AS tsp
        FROM {neighbours} k JOIN {vectors} a ON a.doc_id = k.doc_id JOIN {vectors} b ON b.doc_id = k.neighbour_id"""


# name -> (views it needs, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_posts": ((), """
        SELECT doc_id AS id_post, source AS channel_name,
               TIMESTAMP '2022-01-01' + to_hours(((doc_id * 3701) % 26280)::INT) AS post_date,
               CASE WHEN doc_id % 6 = 0 THEN text || ' https://t.me/p/' || doc_id
                    WHEN doc_id % 6 = 1 THEN '🙏 ' || text || ' **bold** _it_'
                    WHEN doc_id % 6 = 2 THEN text || chr(160) || 'www.site.ru'
                    WHEN doc_id % 6 = 3 AND doc_id % 9 = 0 THEN 'https://t.me/only' ELSE text END AS text,
               n_chars AS views, 0::BIGINT AS reactions, 0::BIGINT AS comments
        FROM documents"""),
    "posts": (("raw_posts",), """
        SELECT id_post AS post_id, channel_name AS channel, post_date AS created_at, text, views FROM raw_posts
        WHERE post_date IS NOT NULL"""),
    "tok": (("posts",), f"""
        SELECT post_id, channel, created_at, text_clean, {tokens('text_clean')} AS tokens
        FROM (SELECT *, {clean('text')} AS text_clean FROM posts)"""),
    "prep": (("tok",), """
        SELECT *, array_to_string(tokens, ' ') AS text_lemm FROM tok WHERE len(tokens) > 0"""),
    "docs": (("prep",), "SELECT post_id AS doc_id, channel, created_at, text_clean, text_lemm FROM prep"),
    "lemmas": (("prep",), """
        SELECT form, substr(form, 1, 5) AS lemma FROM (
            SELECT form, count(*) AS n FROM (SELECT unnest(tokens) AS form FROM prep) GROUP BY form
            ORDER BY n DESC, form LIMIT 200)"""),
    "ttopics": (("docs",), """
        SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN -1 ELSE substr(channel, 4)::INT END AS topic FROM docs"""),
    "vtok": (("docs", "ttopics"), f"""
        SELECT doc_id, topic, unnest(w) AS tok, generate_subscripts(w, 1) AS i FROM (
            SELECT doc_id, topic, list_filter(regexp_extract_all(lower(text_lemm), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
                   lambda t: NOT list_contains({_list(ARTIFACT_WORDS)}, t)) AS w
            FROM docs JOIN ttopics USING (doc_id))"""),
    "tc": (("vtok",), """
        SELECT topic, term, count(*) AS tf FROM (
            SELECT topic, tok AS term FROM vtok
            UNION ALL
            SELECT topic, tok || ' ' || nxt FROM (
                SELECT topic, tok, lead(tok) OVER (PARTITION BY topic ORDER BY doc_id, i) AS nxt FROM vtok) WHERE nxt IS NOT NULL)
        GROUP BY topic, term"""),
    "vocab": (("tc",), """
        SELECT topic, term, tf, f FROM tc JOIN (
            SELECT term, count(*) AS df, sum(tf)::BIGINT AS f FROM tc GROUP BY term
            HAVING count(*) <= 0.85 * (SELECT count(DISTINCT topic) FROM tc)
            ORDER BY f DESC, term LIMIT 30000) USING (term)"""),
    "ctf": (("vocab",), """
        SELECT topic, term, tf, words, tf / words::DOUBLE * ln(1 + a / f::DOUBLE) AS score, ln(1 + a / f::DOUBLE) AS idf
        FROM vocab JOIN (SELECT topic, sum(tf) AS words FROM vocab GROUP BY topic) USING (topic),
             (SELECT floor(avg(w)) AS a FROM (SELECT sum(tf) AS w FROM vocab GROUP BY topic))"""),
    "words": (("ctf",), """
        SELECT topic, rank, term AS word, score FROM (
            SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(score, 10) DESC, term) AS rank FROM ctf) WHERE rank <= 10"""),
    "tscore": (("docs", "ttopics", "vtok", "ctf"), """
        SELECT doc_id, arg_max(topic, (s, -topic)) AS best, round(max(s) / any_value(dn), 10) AS score FROM (
            SELECT doc_id, topic, round(sum(w * score) / any_value(tn), 10) AS s, any_value(dn) AS dn FROM (
                SELECT doc_id, term, n * idf AS w FROM (
                    SELECT doc_id, term, count(*) AS n FROM (
                        SELECT doc_id, tok AS term FROM vtok WHERE topic = -1
                        UNION ALL
                        SELECT doc_id, tok || ' ' || nxt FROM (
                            SELECT doc_id, tok, lead(tok) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM vtok WHERE topic = -1)
                        WHERE nxt IS NOT NULL) GROUP BY doc_id, term) d
                JOIN (SELECT term, max(idf) AS idf FROM ctf GROUP BY term) USING (term)) d
            JOIN (SELECT topic, term, score FROM ctf WHERE topic <> -1) USING (term)
            JOIN (SELECT topic, sqrt(sum(score * score)) AS tn FROM ctf GROUP BY topic) USING (topic)
            JOIN (SELECT doc_id, sqrt(sum(n * n * idf * idf)) AS dn FROM (
                    SELECT doc_id, term, count(*) AS n FROM (
                        SELECT doc_id, tok AS term FROM vtok WHERE topic = -1
                        UNION ALL
                        SELECT doc_id, tok || ' ' || nxt FROM (
                            SELECT doc_id, tok, lead(tok) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM vtok WHERE topic = -1)
                        WHERE nxt IS NOT NULL) GROUP BY doc_id, term)
                  JOIN (SELECT term, max(idf) AS idf FROM ctf GROUP BY term) USING (term) GROUP BY doc_id) USING (doc_id)
            GROUP BY doc_id, topic)
        GROUP BY doc_id"""),
    "anchor": ((), "SELECT label, arg_min(embedding, vec_id)::DOUBLE[] AS a FROM embeddings GROUP BY label"),
    "docvec": ((), """
        SELECT doc_id, x.label, list_transform(list_zip(x.embedding::DOUBLE[], y.embedding::DOUBLE[]), lambda v: v[1] + v[2] * 0.25::DOUBLE) AS e
        FROM documents, (SELECT count(*) AS n FROM embeddings) JOIN embeddings x ON x.vec_id = doc_id % n JOIN embeddings y ON y.vec_id = (doc_id * 7 + 3) % n"""),
    "emb": (("anchor", "docvec"), """
        SELECT doc_id, label, 'ch' || (doc_id % 20) AS channel,
               TIMESTAMP '2024-01-01' + to_days((doc_id % 30)::INT) AS created_at,
               CASE WHEN doc_id % 7 = 0 THEN -1 ELSE label END AS topic,
               CASE WHEN doc_id % 14 = 0 THEN e
                    ELSE list_transform(list_zip(a, e), lambda x: x[1] * 0.8::DOUBLE + x[2] * 0.6::DOUBLE) END AS embedding
        FROM docvec JOIN anchor USING (label)"""),
    "cent": (("emb",), """
        SELECT topic, list(m ORDER BY i) AS centroid FROM (
            SELECT topic, i, avg(v) AS m FROM (
                SELECT topic, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM emb) GROUP BY topic, i)
        GROUP BY topic"""),
    "rawemb": (("docvec",), """
        SELECT doc_id, 'ch' || (doc_id % 20) AS channel, TIMESTAMP '2024-01-01' + to_days((doc_id % 30)::INT) AS created_at,
               e AS embedding FROM docvec"""),
    "knn": (("emb",), _knn("emb")),
    "rawknn": (("rawemb",), _knn("rawemb")),
    "core": (("knn",), f"SELECT doc_id, round(1 - similarity, 10) AS core FROM knn WHERE rank = {CORE_NEIGHBOURS}"),
    "oldcent": (("anchor",), """
        SELECT x.label AS topic,
               CASE WHEN x.label = 5 THEN list_transform(list_zip(x.a, y.a), lambda v: v[1] * 0.55::DOUBLE - v[2] * 0.835::DOUBLE)
                    WHEN x.label = 2 THEN list_transform(list_zip(x.a, y.a), lambda v: v[1] * 0.75::DOUBLE + v[2] * 0.66::DOUBLE)
                    ELSE x.a END AS centroid
        FROM anchor x LEFT JOIN anchor y ON y.label = x.label + 1 WHERE x.label NOT IN (3, 9)"""),
    "nwords": (("cent",), """
        SELECT topic, r AS rank, 't' || topic || '_' || r AS word FROM cent, range(1, 11) t(r) WHERE topic <> -1"""),
    "owords": (("oldcent",), """
        SELECT topic, r AS rank, 't' || CASE WHEN r <= 8 THEN topic ELSE (topic + 1) % 10 END || '_' || r AS word
        FROM oldcent, range(1, 11) t(r)"""),
    "allpairs": (("cent", "oldcent", "nwords", "owords"), """
        SELECT new_topic, old_topic, cosine, jaccard, round(0.7::DOUBLE * cosine + 0.3::DOUBLE * jaccard, 10) AS combined FROM (
            SELECT n.topic AS new_topic, o.topic AS old_topic, round(list_cosine_similarity(n.centroid, o.centroid), 10) AS cosine,
                   len(list_intersect(nw.w, ow.w)) / len(list_distinct(list_concat(nw.w, ow.w)))::DOUBLE AS jaccard
            FROM cent n, oldcent o, (SELECT topic, list(word) AS w FROM nwords GROUP BY topic) nw,
                 (SELECT topic, list(word) AS w FROM owords GROUP BY topic) ow
            WHERE n.topic <> -1 AND nw.topic = n.topic AND ow.topic = o.topic)"""),
    "best": (("allpairs",), """
        SELECT 'new2old' AS direction, * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY new_topic ORDER BY combined DESC, old_topic) AS rn FROM allpairs) WHERE rn = 1
        UNION ALL
        SELECT 'old2new' AS direction, * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY old_topic ORDER BY combined DESC, new_topic) AS rn FROM allpairs) WHERE rn = 1"""),
    "border": (("best",), "SELECT * FROM best WHERE direction = 'new2old' AND cosine >= 0.4 AND cosine < 0.7"),
    "verdicts": (("border",), """
        SELECT new_topic, old_topic, new_topic <> old_topic AS same_topic,
               CASE WHEN new_topic <> old_topic THEN 'high' ELSE 'medium' END AS confidence FROM border"""),
    "matches": (("best", "verdicts"), """
        SELECT b.*, v.same_topic AS verdict, cosine >= 0.7 OR (cosine >= 0.4 AND coalesce(v.same_topic, false)) AS matched
        FROM best b LEFT JOIN verdicts v USING (new_topic, old_topic)"""),
    "records": (("matches",), """
        SELECT NULL::INT AS new_topic_id, 'Disappeared' AS evolution_type, old_topic AS matched_old_topic_id,
               NULL::DOUBLE AS similarity_score, NULL::INT AS inherited_topic_id, NULL::BOOLEAN AS llm_verdict
        FROM matches WHERE direction = 'old2new' AND NOT matched
        UNION ALL
        SELECT new_topic, CASE WHEN count(*) OVER (PARTITION BY old_topic) > 1 THEN 'Merged' ELSE 'Stable' END, old_topic, cosine, old_topic, verdict
        FROM matches WHERE direction = 'new2old' AND matched
        UNION ALL
        SELECT new_topic, 'Emerged', NULL, NULL, (SELECT max(topic) FROM oldcent) + row_number() OVER (ORDER BY new_topic), NULL
        FROM matches WHERE direction = 'new2old' AND NOT matched"""),
    "dist": (("emb", "cent"), """
        SELECT doc_id, topic, round(greatest(0, least(2, 1 - list_cosine_similarity(embedding, centroid))), 10) AS distance
        FROM emb JOIN cent USING (topic) WHERE topic <> -1"""),
    "bounds": (("dist",), f"""
        SELECT quantile_cont(distance, 0.25) AS q_low, quantile_cont(distance, 0.60) AS q_high FROM (
            SELECT distance, row_number() OVER (PARTITION BY topic ORDER BY {md5_key('doc_id')}, doc_id) AS rn,
                   count(*) OVER (PARTITION BY topic) AS n FROM dist) WHERE rn <= 200 AND n >= 2"""),
    "embdocs": (("emb", "posts"), f"""
        SELECT doc_id, coalesce(text, '') AS text, {clean('text')} AS text_clean FROM emb LEFT JOIN posts ON post_id = doc_id"""),
    "rings": (("dist", "bounds"), """
        SELECT doc_id, topic, distance, CASE WHEN distance < q_low THEN 1 WHEN distance < q_high THEN 2 WHEN distance < 1 THEN 3 END AS ring
        FROM dist, bounds"""),
    "samples": (("rings", "embdocs"), f"""
        SELECT topic, ring, ['Ядро', 'Основная', 'Периферия'][ring] AS name, count(*) AS total_docs,
               list(doc_id ORDER BY rn) FILTER (rn <= [5, 3, 2][ring]) AS sample_ids,
               list(text_clean ORDER BY rn) FILTER (rn <= [5, 3, 2][ring]) AS sample_docs
        FROM (SELECT *, row_number() OVER (PARTITION BY topic, ring ORDER BY {md5_key('doc_id')}, doc_id) AS rn
              FROM rings JOIN embdocs USING (doc_id) WHERE ring IS NOT NULL)
        GROUP BY topic, ring"""),
    "info": (("emb",), "SELECT topic, count(*) AS count FROM emb GROUP BY topic"),
    "ext": (("info",), """
        SELECT topic, CASE WHEN topic = 7 THEN 'no json' ELSE json_object('l1', 'A' || topic % 3, 'l2', 'B' || topic, 'l3', 'C' || topic,
               'core_topic', 'core ' || topic, 'periphery_topic', CASE WHEN topic % 2 = 1 THEN 'edge ' || topic END,
               'heterogeneous', topic % 4 = 1, 'coverage', 0.9::DOUBLE - topic / 100.0::DOUBLE)::VARCHAR END AS payload
        FROM info WHERE topic <> -1"""),
    "extlabels": (("ext",), """
        SELECT topic, CASE WHEN ok THEN j->>'l1' ELSE 'ERROR' END AS l1, CASE WHEN ok THEN j->>'l2' ELSE '' END AS l2,
               CASE WHEN ok THEN j->>'l3' ELSE '' END AS l3, CASE WHEN ok THEN j->>'core_topic' ELSE '' END AS core_topic,
               coalesce(CASE WHEN ok THEN j->>'periphery_topic' END, '') AS periphery_topic,
               CASE WHEN ok THEN (j->>'heterogeneous')::BOOLEAN END AS heterogeneous, CASE WHEN ok THEN (j->>'coverage')::DOUBLE END AS coverage
        FROM (SELECT topic, TRY_CAST(payload AS JSON) AS j, coalesce(json_valid(payload) AND list_contains(json_keys(TRY_CAST(payload AS JSON)), 'l1')
              AND list_contains(json_keys(TRY_CAST(payload AS JSON)), 'l2') AND list_contains(json_keys(TRY_CAST(payload AS JSON)), 'l3'), false) AS ok
              FROM ext)"""),
    "prodlabels": (("oldcent",), """
        SELECT topic, 'P' || topic % 3 AS l1, 'Q' || topic AS l2, CASE WHEN topic <> 4 THEN 'R' || topic ELSE '' END AS l3,
               topic % 4 = 0 AS heterogeneous, CASE WHEN topic % 3 = 0 THEN NULL ELSE 0.8::DOUBLE END AS coverage FROM oldcent"""),
    "labels": (("info", "samples", "extlabels", "prodlabels", "records", "bounds"), """
        SELECT i.topic AS Topic, coalesce(p.l1, x.l1) || ':' || coalesce(p.l2, x.l2) || ':' || coalesce(p.l3, x.l3) AS Human_Label,
               coalesce(CASE WHEN p.topic IS NOT NULL THEN p.heterogeneous ELSE x.heterogeneous END, false) AS is_heterogeneous,
               CASE WHEN p.topic IS NOT NULL THEN p.coverage ELSE x.coverage END AS coverage,
               (SELECT printf('%.4f,%.4f', q_low, q_high) FROM bounds) AS zone_boundaries_q25_q60,
               CASE WHEN p.topic IS NOT NULL THEN 'inherited' ELSE 'llm' END AS label_source,
               coalesce(p.l1, x.l1) AS l1, coalesce(p.l2, x.l2) AS l2, coalesce(p.l3, x.l3) AS l3,
               CASE WHEN p.topic IS NOT NULL THEN '' ELSE x.core_topic END AS core_topic,
               CASE WHEN p.topic IS NOT NULL THEN '' ELSE x.periphery_topic END AS periphery_topic, i.count,
               coalesce(r1, 0)::BIGINT AS ring_1_count, coalesce(r2, 0)::BIGINT AS ring_2_count, coalesce(r3, 0)::BIGINT AS ring_3_count,
               (count(*) FILTER (p.topic IS NULL) OVER (ORDER BY i.topic))::BIGINT AS calls,
               coalesce(e.evolution_type, 'Emerged') AS evolution_type
        FROM info i JOIN extlabels x USING (topic)
        LEFT JOIN records e ON e.new_topic_id = i.topic
        LEFT JOIN prodlabels p ON e.evolution_type = 'Stable' AND p.topic = e.matched_old_topic_id
        LEFT JOIN (SELECT topic, sum(total_docs) FILTER (ring = 1) AS r1, sum(total_docs) FILTER (ring = 2) AS r2,
                          sum(total_docs) FILTER (ring = 3) AS r3 FROM samples GROUP BY topic) s USING (topic)
        WHERE i.topic <> -1"""),
    "slabels": (("posts",), """
        SELECT slice, Topic, count, 'L' || Topic % 5 AS l1, 'L' || Topic || ':x' AS Human_Label, m % 4 = 0 AS is_heterogeneous,
               CASE WHEN m % 5 <> 0 THEN (m % 100) / 100.0::DOUBLE END AS coverage,
               CASE WHEN m % 3 = 0 THEN 'inherited' ELSE 'llm' END AS label_source, Topic + 1 AS calls
        FROM (SELECT strftime(created_at, '%Y-%m') AS slice, substr(channel, 4)::INT AS Topic, count(*) AS count, min(post_id) AS m
              FROM posts GROUP BY 1, 2)"""),
    "log": ((), """
        SELECT ts AS predicted_at,
               CASE WHEN event_id % 11 = 0 THEN NULL WHEN day(ts) % 7 < 3 THEN least(value / 100.0::DOUBLE, 1.0)
                    ELSE least(value / 100.0::DOUBLE + 0.35, 1.0) END::DOUBLE AS probability,
               CASE WHEN event_type = 'error' OR (day(ts) BETWEEN 20 AND 23 AND event_type IN ('click', 'view')) THEN -1
                    WHEN event_type = 'signup' AND event_id % 3 = 0 THEN NULL ELSE (user_id % 10)::INT END AS topic_id
        FROM events"""),
    "daily": (("log",), """
        SELECT day, avg_probability, low_confidence_ratio, noise_ratio_inference, topic_entropy, total_predictions,
               avg_probability < 0.5 AS avg_prob, low_confidence_ratio > 0.3 AS low_conf, noise_ratio_inference > 0.35 AS noise
        FROM (SELECT predicted_at::DATE AS day, coalesce(avg(probability), 0) AS avg_probability,
                     coalesce(count(*) FILTER (probability < 0.4) / nullif(count(probability), 0)::DOUBLE, 0) AS low_confidence_ratio,
                     count(*) FILTER (topic_id IS NULL OR topic_id < 0) / count(*)::DOUBLE AS noise_ratio_inference, count(*) AS total_predictions
              FROM log GROUP BY 1)
        JOIN (SELECT day, -sum(p * log2(p + 1e-10)) AS topic_entropy FROM (
                SELECT predicted_at::DATE AS day, topic_id, count(*) / (sum(count(*)) OVER (PARTITION BY predicted_at::DATE))::DOUBLE AS p
                FROM log WHERE topic_id IS NOT NULL GROUP BY 1, 2) GROUP BY day) USING (day)"""),
    "flags": (("daily",), """
        SELECT day, 'avg_prob' AS condition, avg_prob AS hit FROM daily
        UNION ALL SELECT day, 'low_conf', low_conf FROM daily
        UNION ALL SELECT day, 'noise', noise FROM daily"""),
    "streaks": (("flags",), """
        SELECT condition, min(start_day) AS start_day, 3 AS length FROM (
            SELECT condition, min(day) AS start_day, count(*) AS run FROM (
                SELECT *, row_number() OVER (PARTITION BY condition ORDER BY day)
                          - row_number() OVER (PARTITION BY condition, hit ORDER BY day) AS island FROM flags) WHERE hit
            GROUP BY condition, island) WHERE run >= 3 GROUP BY condition"""),
    "trials": ((), """
        SELECT *, CASE WHEN dbcv IS NULL THEN -999.0::DOUBLE ELSE dbcv - 0.5::DOUBLE * noise_ratio END AS score FROM (
            SELECT l_suppkey AS study, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS trial_id,
                   15 + l_partkey % 86 AS n_neighbors, 5 + l_orderkey % 11 AS n_components, (50 + l_quantity * 3)::INT AS min_cluster_size,
                   5 + l_orderkey % 146 AS min_samples, l_discount + l_tax AS noise_ratio,
                   CASE WHEN l_linenumber <> 7 THEN l_extendedprice / 110000.0::DOUBLE END AS dbcv,
                   0.70::DOUBLE + l_tax AS cv_coherence FROM lineitem)"""),
    "soft": (("emb", "cent"), """
        SELECT doc_id, arg_max(topic, (s, -topic)) AS topic, max(s) AS probability FROM (
            SELECT e.doc_id, c.topic, round(list_cosine_similarity(e.embedding, c.centroid), 10) AS s
            FROM emb e, cent c WHERE c.topic <> -1) GROUP BY doc_id"""),
    "hard": (("emb", "core"), """
        SELECT doc_id, CASE WHEN d <= core THEN topic ELSE -1 END AS topic,
               CASE WHEN d <= core THEN round(coalesce(1 - d / nullif(core, 0), 1), 10) ELSE 0 END AS probability FROM (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, iid) AS rn, round(1 - s, 10) AS d FROM (
                SELECT q.doc_id, t.doc_id AS iid, t.topic, c.core, round(list_cosine_similarity(q.embedding, t.embedding), 10) AS s
                FROM emb q JOIN emb t ON t.doc_id <> q.doc_id AND t.topic <> -1 JOIN core c ON c.doc_id = t.doc_id)) WHERE rn = 1"""),
    "chosen": (("soft", "hard"), """
        SELECT doc_id, CASE WHEN weak THEN st ELSE ct END AS topic_id, CASE WHEN weak THEN sp ELSE cp END AS probability,
               CASE WHEN weak THEN 'soft_assign' ELSE 'hdbscan' END AS assignment_method FROM (
            SELECT s.doc_id, s.topic AS st, s.probability AS sp, h.topic AS ct, h.probability AS cp, h.topic = -1 OR h.probability < 0.3 AS weak
            FROM soft s JOIN hard h USING (doc_id))"""),
}


def classified(source: str) -> str:
    """Classified documents from an assignment table (``chosen`` or a soft one)."""
    return f"""
        SELECT doc_id, CASE WHEN valid THEN topic_id ELSE -1 END AS topic_id,
               CASE WHEN valid THEN round(probability, 3) ELSE 0 END AS hdbscan_prob, CASE WHEN valid THEN round(d, 3) END AS cosine_dist,
               CASE WHEN valid THEN ['Ядро', 'Основная', 'Периферия'][ring] ELSE 'Шум' END AS zone,
               CASE WHEN valid THEN 'ring_' || ring END AS ring_key,
               CASE WHEN NOT valid THEN 'Неклассифицировано' WHEN l1 IS NULL THEN 'Нет метки'
                    WHEN ring = 1 THEN l1 || ' -> ' || l2 || ' -> ' || l3 WHEN ring = 2 THEN l1 || ' -> ' || l2
                    WHEN heterogeneous AND periphery_topic <> '' THEN l1 || ' [периферия гетерогенного кластера]' ELSE l1 END AS label,
               CASE WHEN valid AND l1 IS NOT NULL THEN words ELSE '' END AS top_words,
               CASE WHEN valid THEN coalesce(core_topic, '') ELSE '' END AS core_topic,
               CASE WHEN valid THEN coalesce(periphery_topic, '') ELSE '' END AS periphery_topic,
               valid AND coalesce(heterogeneous, false) AS heterogeneous,
               CASE WHEN valid THEN round(probability * (1 - least(d, 1)), 3) ELSE 0 END AS confidence,
               CASE WHEN valid THEN assignment_method ELSE 'invalid' END AS assignment_method
        FROM (SELECT *, CASE WHEN d < q_low THEN 1 WHEN d < q_high THEN 2 ELSE 3 END AS ring FROM (
                SELECT t.doc_id, s.topic_id, s.probability, s.assignment_method, l.* EXCLUDE (topic), w.words,
                       length(t.text) >= 50 AND length(regexp_replace(t.text, '[^\\p{{L}}]', '', 'g')) / length(t.text)::DOUBLE >= 0.3 AS valid,
                       round(1 - list_cosine_similarity(e.embedding, c.centroid), 10) AS d
                FROM embdocs t JOIN emb e USING (doc_id) JOIN {source} s USING (doc_id) JOIN cent c ON c.topic = s.topic_id
                JOIN (SELECT topic, string_agg(word, ' ' ORDER BY rank) AS words FROM nwords WHERE rank <= 6 GROUP BY topic) w ON w.topic = s.topic_id
                LEFT JOIN (SELECT * FROM extlabels WHERE topic <> 8) l ON l.topic = s.topic_id), bounds)"""


CTES["classified"] = (("embdocs", "emb", "chosen", "cent", "nwords", "extlabels", "bounds"), classified("chosen"))
CTES["softchosen"] = (("soft",), "SELECT doc_id, topic AS topic_id, probability, 'soft_assign' AS assignment_method FROM soft")
CTES["softclassified"] = (("embdocs", "emb", "softchosen", "cent", "nwords", "extlabels", "bounds"), classified("softchosen"))


def statement(body: str, *names: str) -> str:
    """``body`` with the views it names, in order of dependence."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for needed in CTES[name][0]:
                visit(needed)
            order.append(name)

    for name in names:
        visit(name)
    if not order:
        return body.strip()
    views = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name][1].strip()})" for name in order)
    recursive = "RECURSIVE " if "walk(" in body else ""
    return f"WITH {recursive}{views}\n{body.strip()}"
