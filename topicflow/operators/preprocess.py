"""From raw posts to clean and normalised text."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scale import explode_once
from ..functions.text import STOP_WORDS, clean_text, tokenize
from ..session import materialize

BROADCAST_BYTES = 64 << 20


def _lookup(forms: pa.Array, lemmas: pa.Array, spark: SparkSession):
    """A column function that replaces known forms in a list of tokens, one Arrow batch at a time."""
    shared = spark.sparkContext.broadcast((forms, lemmas))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def replace(tokens: pa.Array) -> pa.Array:
        known, wanted = shared.value
        flat = tokens.flatten()
        place = pc.index_in(flat, value_set=known.cast(flat.type))
        found = pc.coalesce(wanted.cast(flat.type).take(place), flat)
        sizes = pc.fill_null(pc.list_value_length(tokens), 0)
        offsets = np.concatenate([[0], np.cumsum(np.asarray(sizes))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), found, mask=tokens.is_null())

    return replace


def lemmatize(
    df: DataFrame, lemmas: DataFrame, id_col: str = "post_id", tokens: str = "tokens", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Replace each token by the lemma of a user table ``(form, lemma)``; unknown tokens stay.

    A table of at most ``broadcast_bytes`` is shipped to the tasks and looked up in place, so no
    token is shuffled. A larger one is joined: the corpus' distinct forms meet the table, and every row's
    tokens are put together again by id. Both give the same rows: null tokens and null lists stay as they are.
    A repeated form uses its smallest lemma.
    """
    spark = df.sparkSession
    forms = lemmas.where("form IS NOT NULL").groupBy("form").agg(F.min("lemma").alias("lemma"))
    forms = materialize(forms, "forms")
    width = F.octet_length("form") + F.coalesce(F.octet_length("lemma"), F.lit(0)) + 8
    if (forms.agg(F.sum(width).alias("bytes")).first()["bytes"] or 0) <= broadcast_bytes:
        table = forms.toArrow()
        replace = _lookup(table.column("form").combine_chunks(), table.column("lemma").combine_chunks(), spark)
        return df.withColumn(tokens, replace(F.col(tokens)))
    rows = df.repartition(id_col)
    exploded = rows.select(id_col, F.posexplode_outer(tokens).alias("pos", "form")).where("pos IS NOT NULL")
    named = exploded.join(forms, "form", "left").select(
        id_col, F.struct("pos", F.coalesce("lemma", "form").alias("lemma")).alias("item")
    )
    ordered = F.transform(F.sort_array(F.collect_list("item")), lambda item: item["lemma"])
    regrouped = named.groupBy(id_col).agg(ordered.alias("__lemmas"))
    return rows.join(regrouped, id_col, "left").withColumn(tokens, F.coalesce("__lemmas", tokens)).drop("__lemmas")


def preprocess_posts(
    df: DataFrame,
    lemmas: DataFrame | None = None,
    stop_words: Sequence[str] = STOP_WORDS,
    min_len: int = 3,
    keep: Sequence[str] = ("post_id", "channel", "created_at"),
    with_tokens: bool = False,
    drop_blank: bool = True,
) -> DataFrame:
    """Add ``text_clean`` and ``text_lemm``; drop rows without any token left."""
    out = df.withColumn("text_clean", clean_text(F.col("text")))
    tokens = tokenize(F.col("text_clean"), stop_words, min_len)
    if drop_blank:
        # no or one token list per row: blank rows vanish without computing the tokens twice, as a
        # filter pushed below the projection would
        out = explode_once(out, [*keep, "text_clean"], F.filter(F.array(tokens), lambda t: F.size(t) > 0), "tokens")
    else:
        out = out.select(*keep, "text_clean", tokens.alias("tokens"))
    if lemmas is not None:
        out = lemmatize(out, lemmas, keep[0])
    out = out.withColumn("text_lemm", F.array_join("tokens", " "))
    columns = [*keep, "text_clean", "text_lemm"]
    return out.select(*columns, *(["tokens"] if with_tokens else []))
