"""Keep-first over batches: each batch adds the keys that no batch before it had.

Stored keys are mirrored by a Bloom filter that is a table itself: (word, bits), 64 bits a word,
a few bits per key.  A batch asks it first, by one equality join on the words of its keys, and
only keys that are probably stored meet the stored rows, which are laid out by key range.  A false
positive costs a look at the rows and nothing else.  Rows and bits of a batch are committed
together, so a replayed batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.operators.clean import keep_first
from panelworks.operators.ranking import join_groups
from panelworks.schema import PanelSpec
from panelworks.session import scratch, stored
from panelworks.sinks.commits import (
    CommitLog,
    Record,
    batch_folder,
    commit_batch,
    commit_path,
    committed,
)
from panelworks.sinks.files import write_counted

_BITS = T.StructType([T.StructField("word", T.LongType()), T.StructField("bits", T.LongType())])


@dataclass(frozen=True)
class FirstRows:
    """The first row of each key below a folder, batch by batch.

    ``words`` is the size of the Bloom filter in 64-bit words; about one word per six keys keeps
    false positives near one in a hundred.  Fewer words cost speed, not rows.
    """

    path: str
    spec: PanelSpec = PanelSpec()
    words: int = 1 << 22
    probes: int = 5
    ranges: int = 64

    @property
    def _rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def _bits(self) -> str:
        return f"{self.path}/bits"

    def _range(self) -> Column:
        return F.pmod(F.xxhash64(*self.spec.key), F.lit(self.ranges)).cast("int")

    def _places(self) -> Column:
        """Numbers of the bits that a key sets."""
        size = F.lit(64 * self.words)
        first, step = F.xxhash64(*self.spec.key), F.xxhash64(F.lit(1), *self.spec.key)
        return F.transform(
            F.sequence(F.lit(0), F.lit(self.probes - 1)),
            # wrap-around is fine for a hash, an overflow error is not
            lambda k: F.pmod(F.pmod(first, size) + k * F.pmod(step, size), size),
        )

    def _marked(self, keys: DataFrame) -> DataFrame:
        """(word, bits) of the keys' bits, one row per word."""
        place = keys.select(F.explode(self._places()).alias("p"))
        bit = F.expr("shiftleft(1L, cast(p % 64 as int))")
        return (
            place.select(F.expr("p div 64").alias("word"), bit.alias("bits"))
            .groupBy("word")
            .agg(F.bit_or("bits").alias("bits"))
        )

    def probable(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        """The distinct keys whose bits are all set."""
        held = committed(spark, self._bits, _BITS, "bits", commit_path(self.path))
        asked = keys.select(*self.spec.key, F.explode(F.array_distinct(self._places())).alias("p"))
        asked = asked.withColumn("word", F.expr("p div 64"))
        # a word may have a row per batch; any of them may hold the bit
        hit = F.max(F.expr("(shiftright(bits, cast(p % 64 as int)) & 1)"))
        return (
            asked.join(held, "word", "left")
            .groupBy(*self.spec.key, "p")
            .agg(F.coalesce(hit, F.lit(0)).alias("hit"))
            .groupBy(*self.spec.key)
            .agg(F.min("hit").alias("all"))
            .where("all = 1")
            .drop("all")
        )

    def add(self, batch: DataFrame, batch_id: int) -> int | None:
        """Store the rows of keys that are new; their number, or None if the batch was stored
        before.  Batches come in input order."""
        spark, spec = batch.sparkSession, self.spec
        log = CommitLog(spark, commit_path(self.path))

        def write(last: Record | None) -> tuple[dict[str, int], dict]:
            fresh = first = stored(keep_first(batch, spec), "first")
            if last is not None:
                likely = stored(self.probable(spark, first.select(*spec.key)), "likely")
                seen = join_groups(
                    self._stored_keys(spark, first.schema, likely), likely, spec.key, "left_semi"
                )
                fresh = join_groups(first, seen, spec.key, "left_anti")
            rows = fresh.withColumn("range", self._range())
            folder = batch_folder(self._rows, batch_id)
            n = write_counted(
                rows,
                lambda x: x.write.mode("overwrite").option("compression", "zstd")
                .partitionBy("range").parquet(folder),
            )
            bits = 0
            if n:
                keys = spark.read.schema(rows.schema).parquet(folder).select(*spec.key)
                target = batch_folder(self._bits, batch_id)
                bits = write_counted(
                    self._marked(keys), lambda x: x.write.mode("overwrite").parquet(target)
                )
            return {"rows": n, "bits": bits}, {}

        record = commit_batch(log, batch_id, write)
        return None if record is None else record.outputs["rows"]

    def _stored_keys(self, spark: SparkSession, schema: T.StructType, likely: DataFrame) -> DataFrame:
        """Stored keys of the ranges that the likely keys fall into."""
        with_range = T.StructType([*schema.fields, T.StructField("range", T.IntegerType())])
        rows = committed(spark, self._rows, with_range, "rows", commit_path(self.path))
        wanted = [r[0] for r in likely.select(self._range().alias("range")).distinct().collect()]
        return rows.where(F.col("range").isin(wanted)).select(*self.spec.key)

    def table(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """All rows stored so far; ``schema`` is that of the batches."""
        return committed(spark, self._rows, schema, "rows", commit_path(self.path))


def keep_first_batches(
    batches: Sequence[DataFrame], spec: PanelSpec = PanelSpec(), path: str | None = None
) -> DataFrame:
    """The first row of each key over batches that follow each other in input order."""
    spark = batches[0].sparkSession
    rows = FirstRows(path or scratch(spark, "first-rows"), spec)
    for number, batch in enumerate(batches):
        rows.add(batch, number)
    return rows.table(spark, batches[0].schema)
