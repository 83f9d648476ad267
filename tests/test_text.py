import pytest
from pyspark.sql import functions as F

from topicflow.functions import text as tx
from topicflow.operators.preprocess import lemmatize, preprocess_posts


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_clean_text(spark):
    cases = {
        "Новость дня 🙏 подробности https://t.me/example **важно**": "Новость дня подробности важно",
        "www.site.ru/link #тег _курсив_": "тег курсив",
        "без мусора": "без мусора",
        None: "",
        "💥💥💥": "",
        "a b c\x1cd": "a b c d",
        "x www.site.ru y": "x y",
        "☀✂ [a](b) ~c~ > d|e `f`": "a (b) c d e f",
    }
    assert column(spark, list(cases), tx.clean_text) == list(cases.values())


def test_tokens(spark):
    cases = {
        "Кое-что об этом ab 2024 слово": ["слово"],
        "Он и она ДОМА, дома; дом": ["дома", "дома", "дом"],
        "covid19 вирус x2": ["вирус"],
        "": [],
        None: [],
    }
    assert column(spark, list(cases), tx.tokenize_filter) == list(cases.values())


def test_stop_words_are_a_set_of_lower_case_words():
    assert len(set(tx.STOP_WORDS)) == len(tx.STOP_WORDS) and all(w == w.lower() and w.isalpha() for w in tx.STOP_WORDS)


def test_length_rules(spark):
    values = ["a" * 49, "a" * 50, None, "a" * 15 + "1" * 35, "a" * 14 + "1" * 36, "🙏" * 60]
    assert column(spark, values, tx.min_length) == [False, True, False, True, True, True]
    assert column(spark, values, tx.is_valid_input) == [False, True, False, True, False, False]


def test_prepare_and_labels(spark):
    assert column(spark, ["", None, "  ", "x"], tx.prepare_text) == [" ", " ", " ", "x"]
    labels = [None, "", "Неклассифицировано", "a", "a -> b", "a -> b -> c"]
    assert column(spark, labels, tx.label_depth) == [0, 0, 0, 1, 2, 3]
    assert column(spark, labels, tx.is_multi_level) == [False, False, False, False, True, True]


def test_jaccard(spark):
    rows = [([], []), ([], ["a"]), (["a", "b"], ["b", "a"]), (["a"], ["b"]), (["a", "b"], ["b", "c"])]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    assert [round(r[0], 4) for r in df.select(tx.jaccard(F.col("a"), F.col("b"))).collect()] == [0, 0, 1, 0, 0.3333]


def test_json_answers(spark):
    good = '{"l1": "A", "l2": "B", "l3": "C", "heterogeneous": true, "coverage": 0.5}'
    label = column(spark, [good, '{"l1": "A"}', "oops", None], tx.parse_label_json)
    assert label[0].l1 == "A" and label[0].heterogeneous is True and label[0].coverage == 0.5 and label[0].core_topic is None
    assert [x.l1 for x in label[1:]] == ["ERROR"] * 3 and label[1].coverage is None
    verdict = column(spark, ['{"same_topic": true, "confidence": "high"}', '{"same_topic": true}', "x"], tx.parse_verdict_json)
    assert [(v.same_topic, v.confidence) for v in verdict] == [(True, "high"), (False, "low"), (False, "low")]


@pytest.mark.parametrize("bound", [0, 1000])
def test_lemmatize_both_plans(spark, bound):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, ["z", None, "a"]), (4, None)], "post_id long, tokens array<string>")
    lemmas = spark.createDataFrame([("a", "A2"), ("a", "A1"), ("b", "B")], "form string, lemma string")
    rows = lemmatize(df, lemmas, broadcast_bytes=bound).collect()
    assert {r.post_id: r.tokens for r in rows} == {1: ["B", "A1", "B"], 2: [], 3: ["z", None, "A1"], 4: None}


def test_preprocess_drops_blank_rows(spark):
    rows = [(1, "c", "2024-01-01", "Важная новость сегодня"), (2, "c", "2024-01-01", "и в на"), (3, "c", "2024-01-01", None)]
    df = spark.createDataFrame(rows, "post_id long, channel string, created_at string, text string")
    kept = preprocess_posts(df).collect()
    assert [(r.post_id, r.text_lemm) for r in kept] == [(1, "важная новость сегодня")]
    every = preprocess_posts(df, drop_blank=False).orderBy("post_id").collect()
    assert [r.text_lemm for r in every] == ["важная новость сегодня", "", ""]


def test_text_functions_stay_in_the_jvm(spark, views):
    plan = preprocess_posts(views.posts)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
