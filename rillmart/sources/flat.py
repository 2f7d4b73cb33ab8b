"""The flattened goods dimension, kept beside the dimension tables it is made of.

A micro-batch of routed dimension rows changes rows of any level. Only the skus that are changed or hang below a
changed row are joined anew, and go into a keyed table as one more part. Facts then meet one table in one join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import flat_skus, touched
from .sinks import DELETED, read_dim, read_upserts, upsert_dims
from .tiers import KeyedTable

#: Columns that each level needs of its table.
COLUMNS = {"sku": "id,sku_name,spu_id,tm_id,category3_id", "spu": "id,spu_name", "trademark": "id,tm_name",
           "category3": "id,name,category2_id", "category2": "id,name,category1_id", "category1": "id,name"}


@dataclass(frozen=True)
class FlatGoods:
    """``tables`` names the sink table of each level: sku, spu, trademark, category3, category2, category1."""
    path: str
    dims_path: str
    tables: Mapping[str, str]

    def levels(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {level: read_dim(spark, self.dims_path, self.tables[level], COLUMNS[level]) for level in COLUMNS}

    def refresh(self, batch: DataFrame, run: int, batch_id: int) -> None:
        """Join anew the skus that routed rows touch; the dimension tables hold these rows already."""
        spark = batch.sparkSession
        dims = self.levels(spark)
        changed = {level: batch.where(F.col("sink_table") == name).select(F.col("data")[F.col("sink_pk")].alias("id"))
                   for level, name in self.tables.items()}
        ids = touched(dims, changed).where(F.col("id").isNotNull())
        rows = flat_skus(dims, ids).withColumn(DELETED, F.lit(False))
        # A sku that is gone has no row to join; its id alone ends the row kept so far.
        gone = ids.join(dims["sku"], "id", "left_anti").withColumn(DELETED, F.lit(True))
        KeyedTable(self.path, ["id"]).put(rows.unionByName(gone, allowMissingColumns=True), run, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        """``id`` and the columns of the snowflake, for ``dims["flat"]``. Read it anew in every micro-batch."""
        return read_upserts(spark, self.path, ["id"])


def keep_flat(flat: FlatGoods, order: list[str], run: int = 0) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` for routed dimension rows: their tables as :func:`.sinks.upsert_dims` does, then the flattened one.

    A micro-batch that is repeated after a failure writes both parts again. ``order`` and ``run`` are as there.
    """
    write_dims = upsert_dims(flat.dims_path, order, run)

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        write_dims(batch, batch_id)
        flat.refresh(batch, run, batch_id)

    return write
