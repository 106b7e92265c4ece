"""Line dedup over levelled sorted runs of line hashes.

Documents are taken in batches of falling id. A run is a table of line keys, bucketed and sorted by
key, with the number of documents seen and the largest id. A new batch is reduced to one row per
key, merge-anti-joined with each run's settled keys (those already in enough documents: later
batches hold only lower ids, so nothing about them can change), and what is left becomes a run of
its own. When a level has ``fanout`` runs they are merged into one run of the next level. The runs
lie in buckets of the join key, so only the batch is shuffled. At the end the runs fold into the
keys to drop, and those are joined with the lines.

DataFrame operations only. A line in a third of all documents is one row per map task after partial
aggregation; the final join has one row per key on one side, and AQE splits the other.

Defined results: null or empty text is one empty line; a null id ranks below all others and all null
ids count as one document; repeated rows of an id count once, and each loses the same lines. Ids are
numbers of any type and size.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replaystats.llm.text import BLANKS, LOWER, UPPER, let, pick
from replaystats.session import delete, stage, staging_root

KEY = ("k1", "k2")


class LineRuns:
    """Levelled sorted runs of line keys; batches must come with falling ids."""

    def __init__(self, spark: SparkSession, min_docs: int, buckets: int, fanout: int):
        self.spark, self.min_docs, self.buckets, self.fanout = spark, min_docs, buckets, fanout
        self.levels: list[list[str]] = [[]]
        self.folders: dict[str, str] = {}

    def add(self, batch: DataFrame) -> None:
        """Add distinct (k1, k2, id) rows whose ids are all below those added before."""
        fresh = batch.groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("owner"))
        for run in self._runs():
            fresh = fresh.join(run.filter(F.col("docs") >= self.min_docs), [*KEY], "left_anti")
        self.levels[0].append(self._write(fresh))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self._write(self._fold(self.levels[level]))
            self._drop(self.levels[level])
            self.levels[level] = []
            level += 1
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(merged)

    def repeated(self) -> DataFrame:
        """Keys in at least ``min_docs`` documents with the largest id that holds them."""
        names = [n for level in self.levels for n in level]
        return stage(self._fold(names).filter(F.col("docs") >= self.min_docs).select(*KEY, "owner"), "lines")

    def drop(self) -> None:
        for level in self.levels:
            self._drop(level)

    def _runs(self) -> list[DataFrame]:
        return [self.spark.table(n) for level in self.levels for n in level]

    def _fold(self, names: list[str]) -> DataFrame:
        rows = self.spark.table(names[0])
        for name in names[1:]:
            rows = rows.unionByName(self.spark.table(name))
        return rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("owner").alias("owner"))

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.folders[name] = f"{staging_root(self.spark)}/{name}"
        (
            rows.repartition(self.buckets, *KEY)
            .write.bucketBy(self.buckets, *KEY)
            .sortBy(*KEY)
            .option("path", self.folders[name])
            .saveAsTable(name)
        )
        return name

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete(self.spark, self.folders[name])  # a table with a path of its own leaves its files


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, text_key, pos, k1, k2): a row per line whose key is long enough. docs: (id, text)."""
    lines = F.split(F.translate("text", UPPER, LOWER), "\n", -1)
    rows = docs.select("id", F.xxhash64("text").alias("text_key"), F.posexplode(lines).alias("pos", "line"))
    key = F.btrim("line", F.lit(BLANKS))
    rows = rows.select("id", "text_key", "pos", key.alias("key")).filter(F.length("key") >= min_chars)
    return rows.select(
        "id", "text_key", "pos", F.xxhash64("key").alias("k1"), F.xxhash64("key", F.lit("line")).alias("k2")
    )


def _kept(lines: Column, dropped: Column) -> Column:
    """Lines without the positions of the sorted array ``dropped``, as slices between them."""

    def slices(bound: Column) -> Column:
        line, drop = bound["lines"], bound["dropped"]

        def piece(i: Column) -> Column:
            start = F.coalesce(F.get(drop, i - 1) + 1, F.lit(0))
            end = F.coalesce(F.get(drop, i), F.size(line))
            return F.slice(line, start + 1, end - start)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(drop)), piece))

    return let(F.struct(lines.alias("lines"), dropped.alias("dropped")), slices)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    fanout: int = 2,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id, text, n_lines, n_dropped) per input row, and the columns named in ``carry``.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of at least
    ``min_chars`` characters found in at least ``min_docs`` documents lose all their lines except
    those of the largest id holding them; the other lines are joined again.
    """
    spark = docs.sparkSession
    docs = pick(docs, id_col, text_col, *carry).toDF("id", "text", *(f"carry_{i}" for i in range(len(carry))))
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    keys = stage(line_keys(docs.select("id", "text"), min_chars), "line-keys")
    # Batches of about equal size, whatever the ids are.
    shares = [1 - (i + 1) / batches for i in range(batches - 1)]
    found = keys.agg(F.percentile_approx("id", shares, 1000).alias("bounds")).first()["bounds"] if shares else None
    runs = LineRuns(spark, min_docs, int(spark.conf.get("spark.sql.shuffle.partitions")), fanout)
    try:
        above = None
        for low in [*sorted(set(found or []), reverse=True), None]:
            part = F.lit(True) if above is None else F.col("id") <= above
            part = part & (F.col("id") > low) if low is not None else part | F.col("id").isNull()
            runs.add(keys.filter(part).select(*KEY, "id").distinct())
            above = low
        repeated = runs.repeated()
    finally:
        runs.drop()
    dropped = (
        keys.join(repeated, [*KEY])
        .filter(~F.col("id").eqNullSafe(F.col("owner")))
        .groupBy("id", "text_key")
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
        .withColumnRenamed("id", "drop_id")
        .withColumnRenamed("text_key", "drop_key")
    )
    found = docs.withColumn("text_key", F.xxhash64("text")).join(
        dropped, F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("text_key") == F.col("drop_key")), "left"
    )
    lines = F.split("text", "\n", -1)
    return found.select(
        F.col("id").alias(id_col),
        F.when(F.col("dropped").isNull(), F.col("text"))
        .otherwise(F.array_join(_kept(lines, F.col("dropped")), "\n"))
        .alias(text_col),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        *(F.col(f"carry_{i}").alias(name) for i, name in enumerate(carry)),
    )
