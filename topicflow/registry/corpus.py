"""Queries over posts: sources, profiles, text functions, samples."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import preprocess, profiling, sampling
from ..operators.evolution import topic_similarity
from ..session import scratch_path
from ..sources import inference_log, posts as src, sinks
from . import sql as S
from .base import joined, query, rounded, stamp
from .views import ALL_STOP_WORDS, Views

_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"


def _written(v: Views, df: DataFrame, name: str) -> str:
    path = scratch_path(v.spark, name)
    df.write.parquet(f"{path}/part=1/raw")
    return path


@query("scan_posts_range", f"""
    SELECT id_post, channel_name, {_STAMP.format('post_date')}, length(text) AS len, views FROM raw_posts
    WHERE post_date >= TIMESTAMP '2023-01-01' AND post_date < TIMESTAMP '2023-07-01'""", "raw_posts")
def _(v):
    rows = src.scan_posts_range(v.spark, _written(v, v.raw_posts, "raw"), "2023-01-01", "2023-06-30")
    return rows.select("id_post", "channel_name", stamp("post_date"), F.length("text").cast("long").alias("len"), "views")


@query("normalize_posts", f"""
    SELECT id_post AS post_id, channel_name AS channel, strftime(post_date, '%Y-%m-%d %H:%M:%S') AS created_at, md5(text) AS text_md5
    FROM raw_posts WHERE id_post % 50 <> 3""", "raw_posts")
def _(v):
    # times as text, some of them unreadable
    spoiled = F.when(F.col("id_post") % 50 == 3, "not a time").otherwise(F.date_format("post_date", "yyyy-MM-dd HH:mm:ss"))
    rows = src.normalize_posts(v.raw_posts.withColumn("post_date", spoiled))
    return rows.select("post_id", "channel", stamp("created_at"), F.md5("text").alias("text_md5"))


@query("latest_n_posts", f"""
    SELECT post_id, {_STAMP.format('created_at')} FROM (SELECT * FROM posts ORDER BY created_at DESC, post_id DESC LIMIT 150)""", "posts")
def _(v):
    return src.latest_n_posts(v.posts, 150).select("post_id", stamp("created_at"))


@query("append_delta", f"""
    SELECT id_post, channel_name, {_STAMP.format('post_date')}, md5(text) AS text_md5, views FROM raw_posts WHERE id_post % 3 = 0
    """, "raw_posts")
def _(v):
    """Two thirds of the posts are known; the delta is all posts, half of them also in an older version, through CSV."""
    base = v.raw_posts.where(F.col("id_post") % 3 != 0)
    older = v.raw_posts.where(F.col("id_post") % 2 == 0)
    again = older.select("id_post", "channel_name", (F.col("post_date") - F.make_dt_interval(F.lit(30))).alias("post_date"), F.lit("~ old").alias("text"), "views", "reactions", "comments")
    path = scratch_path(v.spark, "delta")
    delta = v.raw_posts.unionByName(again).withColumn("post_date", F.date_format("post_date", "yyyy-MM-dd HH:mm:ss"))
    delta.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    rows = src.append_delta(base, src.read_delta(v.spark, path))
    return rows.select("id_post", "channel_name", stamp("post_date"), F.md5("text").alias("text_md5"), "views")


@query("union_versions", "SELECT id_post, channel_name, CASE WHEN id_post % 2 = 0 THEN views END::DOUBLE AS views FROM raw_posts", "raw_posts")
def _(v):
    """Two versions of the post table; the older one has no view counts."""
    old = _written(v, v.raw_posts.where(F.col("id_post") % 2 == 1).drop("views"), "v1")
    new = _written(v, v.raw_posts.where(F.col("id_post") % 2 == 0), "v2")
    return src.union_versions(v.spark, [old, new]).select("id_post", "channel_name", F.col("views").cast("double").alias("views"))


_NOW = datetime(2024, 1, 25, 12)


@query("read_inference_log", """
    SELECT strftime(predicted_at, '%Y-%m-%d %H:%M:%S') AS predicted_at, round(probability, 6) AS probability, topic_id::DOUBLE AS topic_id FROM log
    WHERE predicted_at >= TIMESTAMP '2024-01-18 12:00:00'""", "log")
def _(v):
    log = inference_log.scan_inference_log(v.spark, _written(v, v.log, "log"))
    return rounded(inference_log.read_inference_log(log, _NOW, 7).select(stamp("predicted_at"), "probability", F.col("topic_id").cast("double").alias("topic_id")))


@query("write_artifacts", """
    SELECT format, count(*) AS n, sum(len(tokens))::BIGINT AS tokens, sum(length(text_clean))::BIGINT AS chars
    FROM prep, (SELECT unnest(['parquet', 'csv', 'json']) AS format) GROUP BY format""", "prep")
def _(v):
    """Rows and cell sums after a round trip through each format."""
    table = v.prep.select("post_id", "channel", "tokens", "text_clean")
    out = None
    for fmt in ("parquet", "csv", "json"):
        path = scratch_path(v.spark, fmt)
        sinks.write_artifacts(table, path, fmt)
        if fmt == "csv":
            back = v.spark.read.option("header", True).option("escape", '"').csv(path)
            back = back.withColumn("tokens", F.from_json("tokens", "array<string>"))
        else:
            back = v.spark.read.schema(table.schema).format(fmt).load(path)
        found = back.agg(
            F.lit(fmt).alias("format"), F.count("*").alias("n"), F.sum(F.size("tokens")).alias("tokens"), F.sum(F.length("text_clean")).alias("chars")
        )
        out = found if out is None else out.unionByName(found)
    return out


@query("embed_index_map", "SELECT row_number() OVER (ORDER BY id_post) - 1 AS embed_idx, id_post FROM raw_posts", "raw_posts")
def _(v):
    return src.embed_index_map(v.raw_posts)


# --- profiles ---------------------------------------------------------------


@query("dataset_profile", """
    SELECT count(*) AS num_records, count(DISTINCT channel) AS channels_count, 1096 AS date_range_days,
           strftime(min(created_at), '%Y-%m-%d') AS min_date, strftime(max(created_at), '%Y-%m-%d') AS max_date FROM posts""", "posts")
def _(v):
    row = profiling.dataset_profile(v.posts, "2022-01-01", "2024-12-31")
    return row.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("min_date", "max_date")})


@query("monthly_distribution", "SELECT strftime(created_at, '%Y-%m') AS month, count(*) AS posts FROM posts GROUP BY 1", "posts")
def _(v):
    return profiling.monthly_distribution(v.posts)


@query("top_channels", "SELECT channel, count(*) AS posts FROM posts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20", "posts")
def _(v):
    return profiling.top_channels(v.posts)


@query("yearly_distribution", "SELECT year(created_at) AS year, count(*) AS posts FROM posts GROUP BY 1", "posts")
def _(v):
    return profiling.yearly_distribution(v.posts).withColumn("year", F.col("year").cast("long"))


@query("top_months", "SELECT strftime(created_at, '%Y-%m') AS month, count(*) AS posts FROM posts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5", "posts")
def _(v):
    return profiling.top_months(v.posts)


_SEASON = """CASE WHEN month({0}) IN (12, 1, 2) THEN 'winter' WHEN month({0}) IN (3, 4, 5) THEN 'spring'
             WHEN month({0}) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END"""


@query("season_distribution", f"""
    SELECT {_SEASON.format('created_at')} AS season, count(*) AS posts, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM posts), 1) AS pct
    FROM posts GROUP BY 1""", "posts")
def _(v):
    return profiling.season_distribution(v.posts)


@query("null_audit", """
    SELECT 'predicted_at' AS column_name, count(*) FILTER (predicted_at IS NULL) AS nulls FROM log
    UNION ALL SELECT 'probability', count(*) FILTER (probability IS NULL) FROM log
    UNION ALL SELECT 'topic_id', count(*) FILTER (topic_id IS NULL) FROM log""", "log")
def _(v):
    return profiling.null_audit(v.log)


@query("text_length_stats", """
    SELECT count(*) AS count, round(avg(n), 1) AS mean, round(stddev_samp(n), 1) AS std, min(n) AS min, max(n) AS max,
           round(quantile_cont(n, 0.25), 1) AS p25, round(quantile_cont(n, 0.5), 1) AS p50, round(quantile_cont(n, 0.75), 1) AS p75,
           round(quantile_cont(n, 0.9), 1) AS p90, round(quantile_cont(n, 0.95), 1) AS p95, round(quantile_cont(n, 0.99), 1) AS p99
    FROM (SELECT length(coalesce(text, '')) AS n FROM posts)""", "posts")
def _(v):
    return profiling.text_length_stats(v.posts).withColumns({c: F.col(c).cast("long") for c in ("min", "max")})


@query("length_histogram", """
    SELECT least(floor(least(length(text), 2000) * 80 / 2000.0::DOUBLE), 79)::INT AS bin, count(*) AS n FROM posts GROUP BY 1""", "posts")
def _(v):
    return profiling.length_histogram(v.posts, tx.text_length(F.col("text")), 80, 0, 2000)


@query("quality_flags", f"""
    SELECT total, empty, url_only, short, round(empty * 100.0::DOUBLE / total, 2) AS empty_pct,
           round(url_only * 100.0::DOUBLE / total, 2) AS url_only_pct, round(short * 100.0::DOUBLE / total, 2) AS short_pct FROM (
        SELECT count(*) AS total, count(*) FILTER (regexp_matches(coalesce(text, ''), '^[{tx.SPACE}]*$')) AS empty,
               count(*) FILTER (regexp_matches(coalesce(text, ''), '{tx.URL_ONLY}')) AS url_only,
               count(*) FILTER (length(coalesce(text, '')) < 50) AS short FROM posts)""", "posts")
def _(v):
    return profiling.quality_flags(v.posts)


@query("preprocessing_stats", """
    SELECT count(*) FILTER (len(tokens) = 0) AS empty_after_lemm, quantile_cont(len(tokens), 0.5) FILTER (len(tokens) > 0) AS median_token_count,
           quantile_cont(length(text_clean), 0.5) FILTER (len(tokens) > 0) AS median_char_length FROM tok""", "tok")
def _(v):
    return profiling.preprocessing_stats(preprocess.preprocess_posts(v.posts, stop_words=ALL_STOP_WORDS, drop_blank=False))


# --- text -------------------------------------------------------------------


@query("clean_text", f"SELECT post_id, {S.clean('text')} AS text_clean FROM posts", "posts")
def _(v):
    return v.posts.select("post_id", tx.clean_text(F.col("text")).alias("text_clean"))


@query("tokenize_filter", "SELECT post_id, array_to_string(tokens, ' ') AS tokens, len(tokens) AS n FROM tok", "tok")
def _(v):
    rows = v.posts.select("post_id", tx.tokenize_filter(F.col("text"), ALL_STOP_WORDS).alias("t"))
    return rows.select("post_id", joined("t").alias("tokens"), F.size("t").cast("long").alias("n"))


@query("lemmatize", """
    SELECT post_id, string_agg(coalesce(lemma, form), ' ' ORDER BY i) AS lemmas FROM (
        SELECT post_id, unnest(tokens) AS form, generate_subscripts(tokens, 1) AS i FROM prep) LEFT JOIN lemmas USING (form)
    GROUP BY post_id""", "prep lemmas")
def _(v):
    rows = preprocess.lemmatize(v.prep.select("post_id", "tokens"), v.lemmas)
    return rows.select("post_id", joined("tokens").alias("lemmas"))


@query("lemmatize_join", """
    SELECT post_id, string_agg(coalesce(lemma, form), ' ' ORDER BY i) AS lemmas FROM (
        SELECT post_id, unnest(tokens) AS form, generate_subscripts(tokens, 1) AS i FROM prep) LEFT JOIN lemmas USING (form)
    GROUP BY post_id""", "prep lemmas")
def _(v):
    """The plan for a lemma table beyond the broadcast bound."""
    rows = preprocess.lemmatize(v.prep.select("post_id", "tokens"), v.lemmas, broadcast_bytes=0)
    return rows.select("post_id", joined("tokens").alias("lemmas"))


@query("preprocess_posts", f"""
    SELECT post_id, channel, {_STAMP.format('created_at')}, text_clean, text_lemm FROM (
        SELECT post_id, string_agg(coalesce(lemma, form), ' ' ORDER BY i) AS text_lemm FROM (
            SELECT post_id, unnest(tokens) AS form, generate_subscripts(tokens, 1) AS i FROM prep) LEFT JOIN lemmas USING (form)
        GROUP BY post_id) JOIN (SELECT * EXCLUDE (text_lemm) FROM prep) USING (post_id)""", "prep lemmas")
def _(v):
    rows = preprocess.preprocess_posts(v.posts, v.lemmas, ALL_STOP_WORDS)
    return rows.select("post_id", "channel", stamp("created_at"), "text_clean", "text_lemm")


@query("min_length_filter", "SELECT post_id, length(text) AS len FROM posts WHERE length(coalesce(text, '')) >= 50", "posts")
def _(v):
    return v.posts.where(tx.min_length(F.col("text"))).select("post_id", F.length("text").cast("long").alias("len"))


@query("is_valid_input", """
    SELECT page_id, length(html) >= 50 AND length(regexp_replace(html, '[^\\p{L}]', '', 'g')) / length(html)::DOUBLE >= 0.55 AS valid FROM pages""")
def _(v):
    return v.table("pages").select("page_id", tx.is_valid_input(F.col("html"), 50, 0.55).alias("valid"))


@query("prepare_texts", f"""
    SELECT post_id, CASE WHEN regexp_matches(text_clean, '^[{tx.SPACE}]*$') THEN ' ' ELSE text_clean END AS text
    FROM (SELECT post_id, {S.clean('text')} AS text_clean FROM posts)""", "posts")
def _(v):
    return v.posts.select("post_id", tx.prepare_text(tx.clean_text(F.col("text"))).alias("text"))


_SPARK_LABEL = lambda: F.when(F.col("post_id") % 5 == 0, F.lit(None)).when(F.col("post_id") % 5 == 1, "Неклассифицировано").otherwise(
    F.concat_ws(" -> ", F.slice(F.split("channel", ""), 1, (F.col("post_id") % 5).cast("int")))
)
_SQL_LABEL = """CASE WHEN post_id % 5 = 0 THEN NULL WHEN post_id % 5 = 1 THEN 'Неклассифицировано'
                ELSE array_to_string(list_slice(string_split(channel, ''), 1, post_id % 5), ' -> ') END"""


@query("label_depth", f"""
    SELECT post_id, CASE WHEN label IS NULL OR label IN ('', 'Неклассифицировано') THEN 0
           ELSE (length(label) - length(replace(label, '->', ''))) // 2 + 1 END::BIGINT AS depth
    FROM (SELECT post_id, {_SQL_LABEL} AS label FROM posts)""", "posts")
def _(v):
    return v.posts.select("post_id", tx.label_depth(_SPARK_LABEL()).cast("long").alias("depth"))


@query("multi_level_labels", f"SELECT * FROM (SELECT post_id, {_SQL_LABEL} AS label FROM posts) WHERE contains(label, '->')", "posts")
def _(v):
    labelled = v.posts.select("post_id", _SPARK_LABEL().alias("label"))
    return labelled.where(tx.is_multi_level(F.col("label")))


@query("jaccard", """
    SELECT conv_id, turn, round(coalesce(len(list_intersect(a, b)) / nullif(len(list_distinct(list_concat(a, b))), 0)::DOUBLE, 0), 6) AS jaccard FROM (
        SELECT conv_id, turn, regexp_extract_all(lower(text), '[\\p{L}]+') AS a,
               coalesce(regexp_extract_all(lower(lead(text) OVER (PARTITION BY conv_id ORDER BY turn)), '[\\p{L}]+'), []) AS b FROM conversations)""")
def _(v):
    """Word overlap of each turn of a conversation with the next one."""
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}]+"), F.lit(0))
    turns = v.table("conversations").select("conv_id", "turn", words("text").alias("a"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("a").alias("b"))
    both = turns.join(after, ["conv_id", "turn"], "left")
    empty = F.array().cast("array<string>")
    return both.select("conv_id", "turn", F.round(tx.jaccard(F.col("a"), F.coalesce("b", empty)), 6).alias("jaccard"))


@query("parse_label_json", """
    SELECT topic, l1, l2, l3, core_topic, coalesce(periphery_topic, '') AS periphery_topic, heterogeneous::VARCHAR AS heterogeneous, round(coverage, 6) AS coverage FROM extlabels
    """, "extlabels")
def _(v):
    rows = v.external_labels.select("topic", tx.parse_label_json(F.col("payload")).alias("l")).select("topic", "l.*")
    rows = rows.withColumn("heterogeneous", F.col("heterogeneous").cast("string"))
    return rounded(rows.withColumn("periphery_topic", F.coalesce("periphery_topic", F.lit(""))))


@query("parse_verdict_json", """
    SELECT event_id, CASE WHEN event_id % 7 = 0 THEN false ELSE value >= 25 END AS same_topic,
           CASE WHEN event_id % 7 = 0 THEN 'low' ELSE event_type END AS confidence FROM events""")
def _(v):
    """Answers built from the events, every seventh without a verdict."""
    answer = F.to_json(F.struct((F.col("value") >= 25).alias("same_topic"), F.col("event_type").alias("confidence")))
    payload = F.when(F.col("event_id") % 7 == 0, F.col("props")).otherwise(answer)
    parsed = v.table("events").select("event_id", tx.parse_verdict_json(payload).alias("p"))
    return parsed.select("event_id", "p.same_topic", "p.confidence")


# --- samples ----------------------------------------------------------------


@query("stratified_sample_season", f"""
    SELECT post_id, stratum FROM (
        SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {S.md5_key('post_id')}, post_id) AS rn,
               least(round_even(count(*) OVER (PARTITION BY stratum) / (count(*) OVER ())::DOUBLE * 300, 0), count(*) OVER (PARTITION BY stratum)) AS take
        FROM (SELECT post_id, year(created_at) || '_' || {_SEASON.format('created_at')} AS stratum FROM posts
              WHERE created_at >= TIMESTAMP '2022-06-01' AND length(text) >= 50)) WHERE rn <= take""", "posts")
def _(v):
    return sampling.stratified_sample_season(v.posts, 300, "2022-06-01").select("post_id", "stratum")


@query("stratified_sample_channel", f"""
    SELECT post_id, channel FROM (
        SELECT post_id, channel, row_number() OVER (ORDER BY {S.md5_key('post_id')}, post_id) AS place FROM (
            SELECT post_id, channel, row_number() OVER (PARTITION BY channel ORDER BY {S.md5_key('post_id')}, post_id) AS rn,
                   ceil(count(*) OVER (PARTITION BY channel) * 100 / (count(*) OVER ())::DOUBLE) AS take FROM posts) WHERE rn <= take)
    WHERE place <= 100""", "posts")
def _(v):
    return sampling.stratified_sample_channel(v.posts, 100).select("post_id", "channel")


@query("uniform_sample_n", f"SELECT post_id FROM posts ORDER BY {S.md5_key('post_id')}, post_id LIMIT 120", "posts")
def _(v):
    return sampling.uniform_sample_n(v.posts, 120).select("post_id")


@query("time_slices", """
    SELECT slice, count(*) AS posts, min(post_id) AS first_id FROM (
        SELECT post_id, CASE WHEN created_at < TIMESTAMP '2023-07-01' THEN 'A' ELSE 'B' END AS slice FROM posts
        WHERE created_at >= TIMESTAMP '2023-01-01' AND created_at < TIMESTAMP '2023-07-01'
           OR created_at >= TIMESTAMP '2024-01-01' AND created_at < TIMESTAMP '2024-07-01') GROUP BY slice""", "posts")
def _(v):
    rows = sampling.time_slices(v.posts, {"A": ("2023-01-01", "2023-07-01"), "B": ("2024-01-01", "2024-07-01")})
    return rows.groupBy("slice").agg(F.count("*").alias("posts"), F.min("post_id").alias("first_id"))


@query("drop_noise_docs", "SELECT doc_id, length(text_lemm) AS len FROM docs WHERE doc_id % 7 <> 0", "docs")
def _(v):
    return sampling.drop_noise_docs(v.docs, v.text_topics).select("doc_id", F.length("text_lemm").cast("long").alias("len"))


@query("cap_per_group", f"""
    SELECT doc_id, topic FROM (
        SELECT *, row_number() OVER (PARTITION BY topic ORDER BY {S.md5_key('doc_id')}, doc_id) AS rn FROM ttopics WHERE topic <> -1) WHERE rn <= 30
    """, "ttopics")
def _(v):
    return sampling.cap_per_group(v.text_topics, "topic", 30)


@query("cap_per_group_large", f"""
    SELECT study, trial_id FROM (
        SELECT study, trial_id, row_number() OVER (PARTITION BY study ORDER BY {S.md5_key('trial_id')}, trial_id) AS rn FROM trials) WHERE rn <= 500
    """, "trials")
def _(v):
    return sampling.cap_per_group(v.trials, "study", 500, "trial_id").select("study", "trial_id")


@query("sample_pairs_for_review", f"""
    SELECT new_topic, old_topic, round(cosine, 6) AS cosine, kind FROM (
        SELECT new_topic, old_topic, cosine, 'border' AS kind FROM border
        UNION ALL (SELECT new_topic, old_topic, cosine, 'confident' FROM best WHERE direction = 'new2old' AND cosine >= 0.7
                   ORDER BY md5(new_topic || '|' || old_topic || '|42'), 1, 2 LIMIT 5)
        UNION ALL (SELECT new_topic, old_topic, cosine, 'low' FROM allpairs WHERE cosine < 0.4
                   ORDER BY md5(new_topic || '|' || old_topic || '|42'), 1, 2 LIMIT 30))""", "border best allpairs")
def _(v):
    side = lambda df: df.select(F.col("new_topic").alias("topic_a"), F.col("old_topic").alias("topic_b"), "cosine")
    best = side(v.best.where("direction = 'new2old'"))
    rows = sampling.sample_pairs_for_review(best, side(topic_similarity(v.centroids, v.old_centroids)), n_confident=5)
    return rounded(rows.withColumnsRenamed({"topic_a": "new_topic", "topic_b": "old_topic"}))
