"""Exact deduplication with keyed state on disk, in DataFrame operations only.

A Structured Streaming aggregation keeps one state row per digest in RocksDB, without a watermark,
so nothing expires: the number of copies, the identifier of the row that stays and the place of
that row in the scan. The state is read back through Spark's state reader. Digests that were hit
more than once are not trusted: the whole texts of their rows are compared with the text of the row that stays.

A lasting ``store`` is a shared folder with the state, the marks of all batches, and the content table (one
folder per batch). There the locator is (run, place), which names a row of the content table for good, so that
a later batch is compared byte by byte with texts of earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, materialize, scratch_path
from .common import key_filter

LOWEST = -(2**63)  # stands for a null doc_id, which loses to any other
HOT_SHARE = 1000  # a digest with a thousandth of all rows is hot, so there are at most 1000 of them
ROWS_PER_SALT = 256
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    # many small stores: no space set aside in advance, changes rather than snapshots per batch
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def plain_text(text: str = "text") -> Column:
    """A null as the empty text, A-Z lower-cased, all else as it is."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), A_TO_Z, A_TO_Z.lower())


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


@contextmanager
def state_settings(spark: SparkSession):
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def remember(spark: SparkSession, marks: str, store: str, place: str = "long", first: bool = False) -> DataFrame:
    """Feeds new files of the folder ``marks`` (digest, rank, place) to the state in ``store``; returns the whole state.

    ``place`` is the type of the locator; with ``first`` the state also keeps the smallest locator of a digest.
    """
    least = [F.min("place").alias("first")] if first else []
    with state_settings(spark):
        stream = spark.readStream.schema(f"digest string, rank long, place {place}").parquet(marks)
        state = stream.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("top"), F.max_by("place", "rank").alias("at"), *least)
        run = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", store)
        run.trigger(availableNow=True).start().awaitTermination()
        kept = spark.read.format("statestore").load(store)
        count, top, at, _, *rest = [F.col("value")[name] for name in kept.schema["value"].dataType.names]
        state = kept.select(F.col("key.digest").alias("digest"), count.alias("n"), top.alias("top"), at.alias("at"), *[c.alias("first") for c in rest])
        return materialize(state, "state")


def deduplicate(docs: DataFrame, digest: Callable[[Column], Column] = sha256, store: str | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 per row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; a null text is an empty one. Of equal texts the
    row with the largest doc_id stays; a null doc_id loses to any other; of repeated rows with that doc_id one stays.
    An empty table gives no rows. ``digest`` may be weak: rows of one digest and several texts are told apart.
    With a ``store`` the rows are judged against all batches that it has seen, see :class:`Store`.
    """
    if store is not None:
        return Store(docs.sparkSession, store, digest).add(docs)
    spark = configure(docs.sparkSession)
    rank = F.coalesce(F.col("doc_id"), F.lit(LOWEST))
    mine = docs.select("doc_id", plain_text().alias("plain"))
    marks = mine.select("doc_id", rank.alias("rank"), digest(F.col("plain")).alias("digest"), sha256(F.col("plain")).alias("sha"), F.monotonically_increasing_id().alias("place"))
    folder = scratch_path(spark, "marks")
    marks.write.parquet(folder)
    marks = spark.read.schema(marks.schema).parquet(folder)
    state = remember(spark, folder, scratch_path(spark, "store"))
    groups = materialize(state.where("n > 1"), "groups")
    total = marks.count()
    hot = groups.where(F.col("n") * HOT_SHARE >= total)
    members = materialize(_with_groups(marks, groups, hot, total), "members")
    odd = _other_texts(docs, members, groups, hot, total, digest)
    fewer = odd.groupBy("digest").agg(F.count(F.lit(1)).alias("fewer"))
    held = members.join(odd.select("doc_id", "digest").distinct().withColumnRenamed("doc_id", "__id").withColumnRenamed("digest", "__digest"),
                        F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left_anti")
    held = held.join(fewer, "digest", "left").select(
        "doc_id", F.when(F.col("top") != LOWEST, F.col("top")).alias("keep_id"),
        (F.coalesce("n", F.lit(1)) - F.when(F.col("n").isNotNull(), F.coalesce("fewer", F.lit(0))).otherwise(0)).cast("long").alias("group_size"),
        F.coalesce(F.col("place") == F.col("at"), F.lit(True)).alias("kept"), F.col("sha").alias("text_sha256"),
    )
    return held.unionByName(_groups_of(odd))


def _with_groups(marks: DataFrame, groups: DataFrame, hot: DataFrame, total: int) -> DataFrame:
    """Marks with n, top, at of their group (a lone row: null, itself, null). Hot groups come by a broadcast of at most 1000 rows."""
    both = marks.join(F.broadcast(hot.select("digest", "n", "top", "at")), "digest", "left")
    cold = both.where("n is null").drop("n", "top", "at").join(groups.where(F.col("n") * HOT_SHARE < total), "digest", "left")
    return both.where("n is not null").unionByName(cold.withColumn("top", F.coalesce("top", "rank")))


def _other_texts(docs: DataFrame, members: DataFrame, groups: DataFrame, hot: DataFrame, total: int, digest) -> DataFrame:
    """Rows whose digest is that of a group and whose text is not (doc_id, digest, plain): none, unless digests collide.

    Only rows whose doc_id passes the key filter are shuffled with their text; hot groups are dealt out by salt.
    """
    ids = members.where("n is not null").select(F.col("rank").alias("id"))
    rows = docs.select("doc_id", "text").withColumn("rank", F.coalesce(F.col("doc_id"), F.lit(LOWEST)))
    rows = key_filter(ids, "id")(rows, "rank").where("__hit").select("doc_id", "rank", plain_text().alias("plain"))
    salts = hot.select("digest", F.ceil(F.col("n") / ROWS_PER_SALT).cast("int").alias("salts"))
    rows = rows.withColumn("digest", digest(F.col("plain"))).join(F.broadcast(salts), "digest", "left")
    rows = rows.withColumn("salts", F.coalesce("salts", F.lit(1)))
    keepers = groups.select("digest", F.col("top").alias("rank"))
    first = rows.join(keepers, ["digest", "rank"]).groupBy("digest", "salts").agg(F.min("plain").alias("first"))
    first = first.select("digest", "first", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("rank"), F.col("salts")).cast("int"))
    return materialize(salted.join(first, ["digest", "salt"]).where("plain != first").select("doc_id", "digest", "plain"), "odd")


def _groups_of(odd: DataFrame) -> DataFrame:
    """The same result for the rows that collided, grouped by their text itself."""
    rank = F.coalesce(F.col("doc_id"), F.lit(LOWEST))
    return _by_text(odd.withColumn("rank", rank).withColumn("place", F.monotonically_increasing_id()))


def _by_text(odd: DataFrame, *more: str) -> DataFrame:
    sizes = odd.groupBy("digest", "plain").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("rank", "place")).alias("top"))
    return odd.join(sizes, ["digest", "plain"]).select(
        "doc_id", F.when(F.col("top.rank") != LOWEST, F.col("top.rank")).alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("place") == F.col("top.place")).alias("kept"), sha256(F.col("plain")).alias("text_sha256"), *more,
    )


class Store:
    """Exact copies over batches that come one after another, in a folder that all executors reach.

    ``add`` takes a batch and returns its verdicts against everything seen so far; ``verdicts`` returns those of
    all rows ever added, which equal one run over the union (a later row with a larger doc_id takes over). Nothing
    expires. Texts are written once, to the content table; a later batch reads of it only the texts that its own digests
    point at. If a call dies after its marks were written, the next call counts and checks them, so don't add that batch
    again. One writer at a time.
    """

    LOCATOR = "struct<run:int,place:bigint>"

    def __init__(self, spark: SparkSession, folder: str, digest: Callable[[Column], Column] = sha256):
        self.spark, self.digest = configure(spark), digest
        self.content, self.marks, self.state, self.odd = (f"{folder.rstrip('/')}/{part}" for part in ("content", "marks", "state", "odd"))

    def add(self, docs: DataFrame) -> DataFrame:
        run = len(self._runs(self.content))
        rank, plain = F.coalesce(F.col("doc_id"), F.lit(LOWEST)).alias("rank"), plain_text().alias("plain")
        rows = docs.select("doc_id", rank, plain).withColumn("digest", self.digest(F.col("plain"))).withColumn("place", F.monotonically_increasing_id())
        rows.write.parquet(f"{self.content}/run={run}")  # places of the written rows never change
        written = self.spark.read.schema(rows.schema).parquet(f"{self.content}/run={run}")
        place = F.struct(F.lit(run).alias("run"), "place").alias("place")
        written.select("doc_id", "rank", "digest", sha256(F.col("plain")).alias("sha"), place).write.mode("append").parquet(self.marks)
        state = remember(self.spark, self.marks, self.state, self.LOCATOR, first=True)
        self._check(run, state)
        return self._judged(state).where(F.col("run") == run).drop("run")

    def verdicts(self) -> DataFrame:
        """doc_id, keep_id, group_size, kept, text_sha256 of every row ever added."""
        return self._judged(remember(self.spark, self.marks, self.state, self.LOCATOR, first=True)).drop("run")

    def _runs(self, folder: str) -> list[int]:
        """Numbers of the batches with a folder below ``folder``: names only, one per batch."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in system.listStatus(path)] if system.exists(path) else []
        return sorted(int(n[4:]) for n in names if n.startswith("run="))

    def _marks(self) -> DataFrame:
        return self.spark.read.schema(f"doc_id long, rank long, digest string, sha string, place {self.LOCATOR}").parquet(self.marks)

    def _odd(self) -> DataFrame:
        return self.spark.read.schema(f"doc_id long, rank long, digest string, plain string, place {self.LOCATOR}").parquet(f"{self.odd}/run=*")

    def _check(self, run: int, state: DataFrame) -> None:
        """Writes the rows of batches not checked yet whose text is not the first one of their digest.

        The first text comes from the content table by its locator. Only rows whose digest occurs twice move with
        their text; hot digests are dealt out by salt, and each salt gets the first text once.
        """
        content = self.spark.read.schema("doc_id long, rank long, plain string, digest string, place long, run int").option("basePath", self.content).parquet(self.content)
        last = max(self._runs(self.odd), default=-1)
        again = materialize(state.where("n > 1"), "again")
        mine = self._marks().where(F.col("place.run") > last)
        total = mine.count()
        mine = mine.select("digest", F.col("place.run").alias("run"), F.col("place.place").alias("place"))
        touched = materialize(again.join(mine.select("digest"), "digest", "left_semi"), "touched")
        fresh = content.where(F.col("run") > last).join(mine.select("run").distinct(), "run", "left_semi")  # marked batches only
        rows = key_filter(touched, "digest")(fresh, "digest").where("__hit").drop("__hit")
        salts = touched.where(F.col("n") * HOT_SHARE >= F.greatest(F.lit(total), F.col("n"))).select("digest", F.ceil(F.col("n") / ROWS_PER_SALT).cast("int").alias("salts"))
        rows = rows.join(salts, "digest", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("run", "place"), F.col("salts")).cast("int"))
        at = touched.select("digest", F.col("first.run").alias("run"), F.col("first.place").alias("place"))
        first = key_filter(touched, "digest")(content, "digest").where("__hit").join(at, ["digest", "run", "place"]).select("digest", F.col("plain").alias("first"))
        first = first.join(salts, "digest", "left").select("digest", "first", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
        other = rows.join(first, ["digest", "salt"]).where("plain != first")
        other.select("doc_id", "rank", "digest", "plain", F.struct("run", "place").alias("place")).write.parquet(f"{self.odd}/run={run}")

    def _judged(self, state: DataFrame) -> DataFrame:
        """Verdicts of all marks; digests with several texts are counted anew without the rows of other texts."""
        marks, odd = self._marks(), materialize(self._odd(), "odd")
        several, total = odd.select("digest").distinct(), marks.count()
        alike = marks.join(odd.select("place"), "place", "left_anti")
        anew = alike.join(several, "digest", "left_semi").groupBy("digest").agg(
            F.count(F.lit(1)).alias("n"), F.max("rank").alias("top"), F.max_by("place", "rank").alias("at"))
        groups = state.where("n > 1").select("digest", "n", "top", "at").join(several, "digest", "left_anti")
        groups = materialize(groups.unionByName(anew), "groups")
        members = _with_groups(alike, groups, groups.where(F.col("n") * HOT_SHARE >= total), total)
        held = members.select(
            "doc_id", F.when(F.col("top") != LOWEST, F.col("top")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce(F.col("place") == F.col("at"), F.lit(True)).alias("kept"), F.col("sha").alias("text_sha256"), F.col("place.run").alias("run"),
        )
        return held.unionByName(_by_text(odd.withColumn("run", F.col("place.run")), "run"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each text; rows that surely stay are not shuffled."""
    result = materialize(deduplicate(docs), "copies")
    lost = result.where("not kept").select("doc_id").distinct()
    tested = key_filter(lost, "doc_id")(docs, "doc_id")
    stays = result.where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__wanted"))
    hits = tested.where("__hit").withColumn("__sha", sha256(plain_text()))
    exact = hits.join(stays, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__wanted")))
    return tested.where("not __hit").unionByName(exact.dropDuplicates(["doc_id", "__sha"]).select(*tested.columns)).select(*docs.columns)
