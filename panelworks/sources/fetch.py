"""Filtered fetch as a data source that takes the filter itself.

``panel_fetch`` reads a dataset of Parquet or NDJSON files.  Filters of the query reach it:
those on folder columns decide which files become partitions at all, the others go
with the read, where Parquet statistics skip row groups, and only matching rows leave a task, in
Arrow batches of a bounded size.  Filters that Arrow would answer otherwise than Spark, such
as those on floating point columns, are left to Spark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as sources
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from panelworks.operators.reports import matches
from panelworks.schema import FilterSpec, PanelSpec
from panelworks.session import ship

FORMAT = "panel_fetch"
BATCH_ROWS = 1000
_PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
# Types whose comparisons mean the same to Spark and to Arrow.
_ALIKE = (T.StringType, T.IntegralType, T.BooleanType, T.DateType)


def _dataset(address: str, form: str, files: Sequence[str] | None = None) -> ds.Dataset:
    if address.startswith("file:/") and not address.startswith("file://"):
        address = "file://" + address.removeprefix("file:")
    system, root = pafs.FileSystem.from_uri(address.rstrip("/"))
    hive = ds.partitioning(flavor="hive")
    return ds.dataset(
        list(files) if files else root, filesystem=system, format=form, partitioning=hive,
        partition_base_dir=root,
    )


def _expression(found: sources.Filter, kinds: dict[str, T.DataType]) -> ds.Expression | None:
    """The filter as an Arrow expression that is true for the same rows; None if there is none."""
    if isinstance(found, sources.Not):
        inner = _expression(found.child, kinds)
        return None if inner is None else ~inner
    name = ".".join(found.attribute)
    if len(found.attribute) != 1 or not isinstance(kinds.get(name), _ALIKE):
        return None
    column = ds.field(name)
    match found:
        case sources.EqualTo():
            return column == found.value
        case sources.GreaterThan():
            return column > found.value
        case sources.GreaterThanOrEqual():
            return column >= found.value
        case sources.LessThan():
            return column < found.value
        case sources.LessThanOrEqual():
            return column <= found.value
        case sources.In() if None not in found.value:
            return column.isin(list(found.value))
        case sources.StringStartsWith():
            return pc.starts_with(column, found.value)
        case sources.IsNotNull():
            return column.is_valid()
        case sources.IsNull():
            return column.is_null()
    return None


@dataclass
class _File(sources.InputPartition):
    path: str


class _Reader(sources.DataSourceReader):
    def __init__(self, address: str, form: str, batch_rows: int, schema: T.StructType):
        self.address, self.form, self.batch_rows, self.schema = address, form, batch_rows, schema
        self.filter: ds.Expression | None = None

    def pushFilters(self, filters: list[sources.Filter]) -> Iterable[sources.Filter]:
        kinds = {f.name: f.dataType for f in self.schema.fields}
        for found in filters:
            expression = _expression(found, kinds)
            if expression is None:
                yield found
            else:
                self.filter = expression if self.filter is None else self.filter & expression

    def partitions(self) -> Sequence[sources.InputPartition]:
        """The files whose folders do not rule them out."""
        return [_File(x.path) for x in _dataset(self.address, self.form).get_fragments(self.filter)]

    def read(self, partition: _File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        shape = to_arrow_schema(self.schema)
        whole = _dataset(self.address, self.form, [partition.path])
        batches = whole.to_batches(
            columns=shape.names, filter=self.filter, batch_size=self.batch_rows
        )
        for batch in batches:
            if batch.num_rows:
                arrays = [c.cast(f.type) for c, f in zip(batch.columns, shape, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=shape)


class PanelFetch(sources.DataSource):
    """Options: path, form (parquet or json) and batch (rows of a batch at most)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> sources.DataSourceReader:
        rows = int(self.options.get("batch", BATCH_ROWS))
        return _Reader(self.options["path"], self.options.get("form", "parquet"), rows, schema)


def fetch_from(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    want: FilterSpec = FilterSpec(),
    spec: PanelSpec = PanelSpec(),
    form: str = "parquet",
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """Matching rows of a dataset, filtered where they are read.

    ``schema`` names the columns, those of folders included.  Filters on them may be
    added to the result; Spark hands on what the source can take.
    """
    ship(spark)
    spark.conf.set(_PUSHDOWN, "true")
    spark.dataSource.register(PanelFetch)
    reader = spark.read.format(FORMAT).schema(schema).option("form", form)
    return reader.option("batch", batch_rows).load(path).where(matches(want, spec))
