"""What a named extraction has finished, so that one that was stopped goes on from there.

Below ``_runs/<run>`` of the lake there is a file per entity with the cut of its order, a file per part
of an entity that has been written, and one per entity that is whole. Files appear whole or not at
all, after what they tell of. A part is a number of blocks; blocks replace themselves, so
a part that was stopped half-way is simply written again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from entitylake.functions.ordering import OrderBy, sort_keys
from entitylake.operators.numbering import Blocks, cut_blocks, stored_key
from entitylake.operators.upsert import skip_done
from entitylake.schemas import ENTITY
from entitylake.sources.files import Files, escaped
from entitylake.sources.pageindex import BLOCKS_PER_JOB, clear_entity, write_blocks, write_index

RUNS = "_runs"
FINISHED = f"{ENTITY} string, records bigint, blocks bigint"


class Run:
    """One extraction by its name; another name starts from nothing."""

    def __init__(self, spark: SparkSession, path: str, name: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.files = Files(spark, f"{self.path}/{RUNS}/{escaped(spark, name)}")

    def finished(self) -> DataFrame:
        """``(entity, records, blocks)`` of the entities that are whole."""
        if not self.files.names("whole"):
            return self.spark.createDataFrame([], FINISHED)
        return self.spark.read.schema(FINISHED).json(f"{self.files.root}/whole")

    def remaining(self, worklist: DataFrame) -> DataFrame:
        """The rows of a work list (with ``entity``) that this run has not finished."""
        return skip_done(worklist, self.finished(), [ENTITY])

    def save(
        self,
        df: DataFrame,
        entity: str,
        order_by: OrderBy,
        size: int,
        rows_per_block: int | None = None,
        blocks_per_job: int = BLOCKS_PER_JOB,
    ) -> bool:
        """Save an entity, or what is left to do of it; False if this run has it whole already.

        The stored cut is used again if the order, the page size and the number of rows
        are those it was made for; otherwise the entity starts anew.
        """
        name = escaped(self.spark, entity)
        if self.files.get(f"whole/{name}") is not None:
            return False
        shape = {"order": [[key.name, key.descending] for key in sort_keys(order_by)], "page": size, "job": blocks_per_job}
        blocks = self._cut(df, name, order_by, shape)
        if blocks is None:
            blocks = cut_blocks(df, order_by, align=size, rows_per_block=rows_per_block)
            for old in self.files.names(f"parts/{name}"):
                self.files.remove(f"parts/{name}/{old}")
            clear_entity(self.spark, self.path, entity)
            ends = [stored_key(df, blocks.keys, end) for end in blocks.ends]
            cut = {**shape, "total": blocks.total, "rows": blocks.size, "grouped": blocks.grouped, "ends": ends}
            self.files.put(f"cuts/{name}", json.dumps(cut))
        written = set(self.files.names(f"parts/{name}"))
        for first, stop in blocks.parts(blocks_per_job):
            if str(first) not in written:
                write_blocks(df, entity, blocks, self.path, size, first, stop)
                self.files.put(f"parts/{name}/{first}", "")
        write_index(df, entity, blocks, self.path, size)
        told = {ENTITY: entity, "records": blocks.total, "blocks": blocks.count}
        self.files.put(f"whole/{name}", json.dumps(told))
        return True

    def _cut(self, df: DataFrame, name: str, order_by: OrderBy, shape: dict) -> Blocks | None:
        text = self.files.get(f"cuts/{name}")
        if text is None:
            return None
        cut = json.loads(text)
        if any(cut[key] != value for key, value in shape.items()) or cut["total"] != df.count():
            return None
        ends = [tuple(end) for end in cut["ends"]]
        return Blocks(sort_keys(order_by), cut["total"], cut["rows"], ends, cut.get("grouped", 1))
