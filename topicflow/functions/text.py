"""Text columns: cleaning, tokens, predicates, labels, answers in JSON.

Everything is a built-in column expression, so scans, filters and these functions share one
generated stage; no Python worker is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import LABEL_UNCLASSIFIED, MIN_ALPHA_RATIO, MIN_TEXT_LEN

# What counts as a link, emoji, markup and white space (the set of str.isspace).
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
URL = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
EMOJI = r"\x{10000}-\x{10FFFF}\x{2600}-\x{27BF}"
MARKUP = r"*_`#|>\[\]~"
URL_ONLY = rf"^https?://[^{SPACE}]+[{SPACE}]*$"
WORD = r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*"

# Function words dropped from the token list.
STOP_WORDS = tuple(
    """
    и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по только ее мне было вот от
    меня еще нет о из ему теперь когда даже ну вдруг ли если уже или ни быть был него до вас нибудь опять уж вам
    ведь там потом себя ничего ей может они тут где есть надо ней для мы тебя их чем была сам чтоб без будто
    человек чего раз тоже себе под будет ж тогда кто этот того потому этого какой совсем ним здесь этом один
    почти мой тем чтобы нее сейчас были куда зачем всех никогда можно при наконец два об другой хоть после над
    больше тот через эти нас про всего них какая много разве три эту моя впрочем хорошо свою этой перед иногда
    лучше чуть том нельзя такой им более всегда конечно всю между
    """.split()
)

# Channel boilerplate kept out of topic words.
ARTIFACT_WORDS = tuple("truekpru truekpspbru подписаться наш известный масштабный важный".split())


def clean_text(text: Column) -> Column:
    """Links, then emoji and markup, become single spaces; null becomes the empty string.

    Emoji, markup and white space collapse to one space in the end, so one pass replaces any
    run of them.
    """
    no_links = F.regexp_replace(F.coalesce(text, F.lit("")), URL, " ")
    return F.trim(F.regexp_replace(no_links, f"[{EMOJI}{MARKUP}{SPACE}]+", " "))


def tokenize(clean: Column, stop_words: Sequence[str] = STOP_WORDS, min_len: int = 3) -> Column:
    """Lower-case alphabetic tokens of already cleaned text, in order.

    A hyphenated or mixed letter-digit run is one token and fails the alphabetic test.
    """
    words = F.regexp_extract_all(F.lower(clean), F.lit(WORD), F.lit(0))
    keep = lambda t: (F.length(t) >= min_len) & t.rlike(r"^\p{L}+$") & ~t.isin(list(stop_words))
    return F.filter(words, keep if stop_words else lambda t: (F.length(t) >= min_len) & t.rlike(r"^\p{L}+$"))


def tokenize_filter(text: Column, stop_words: Sequence[str] = STOP_WORDS, min_len: int = 3) -> Column:
    return tokenize(clean_text(text), stop_words, min_len)


def text_length(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def min_length(text: Column, n: int = MIN_TEXT_LEN) -> Column:
    return text_length(text) >= n


def is_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(rf"^[{SPACE}]*$")


def is_url_only(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(URL_ONLY)


def is_valid_input(text: Column, min_len: int = MIN_TEXT_LEN, min_alpha: float = MIN_ALPHA_RATIO) -> Column:
    """Long enough, and enough of it letters."""
    letters = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}]", ""))
    share = F.coalesce(F.try_divide(letters, text_length(text)), F.lit(0.0))
    return min_length(text, min_len) & (share >= min_alpha)


def prepare_text(text: Column) -> Column:
    """Encoders want at least one character."""
    return F.when(is_blank(text), F.lit(" ")).otherwise(text)


def label_depth(label: Column) -> Column:
    unlabelled = label.isNull() | label.isin("", LABEL_UNCLASSIFIED)
    return F.when(unlabelled, F.lit(0)).otherwise(F.regexp_count(label, F.lit("->")) + 1)


def is_multi_level(label: Column) -> Column:
    return F.coalesce(label.contains("->"), F.lit(False))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


_LABEL_SCHEMA = (
    "l1 string, l2 string, l3 string, core_topic string, periphery_topic string, "
    "heterogeneous boolean, coverage double"
)
_VERDICT_SCHEMA = "same_topic boolean, confidence string, reasoning string"


def _has_keys(payload: Column, keys: Sequence[str]) -> Column:
    found = F.json_object_keys(payload)
    check = F.lit(True)
    for key in keys:
        check = check & F.coalesce(F.array_contains(found, key), F.lit(False))
    return check


def parse_label_json(payload: Column) -> Column:
    """The label in an external answer; an answer without l1, l2 and l3 is an error row."""
    parsed = F.from_json(payload, _LABEL_SCHEMA)
    failed = F.struct(
        F.lit("ERROR").alias("l1"),
        F.lit("").alias("l2"),
        F.lit("").alias("l3"),
        F.lit("").alias("core_topic"),
        F.lit("").alias("periphery_topic"),
        F.lit(None).cast("boolean").alias("heterogeneous"),
        F.lit(None).cast("double").alias("coverage"),
    )
    return F.when(_has_keys(payload, ("l1", "l2", "l3")), parsed).otherwise(failed)


def parse_verdict_json(payload: Column) -> Column:
    """The judgement in an external answer; an unusable answer means different topics, low."""
    parsed = F.from_json(payload, _VERDICT_SCHEMA)
    failed = F.struct(
        F.lit(False).alias("same_topic"), F.lit("low").alias("confidence"), F.lit("ERROR").alias("reasoning")
    )
    return F.when(_has_keys(payload, ("same_topic", "confidence")), parsed).otherwise(failed)
