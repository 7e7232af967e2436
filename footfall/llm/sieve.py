"""A bitmap of hashed keys, to drop rows before they are shuffled for a join.

``Sieve(keys)`` holds one bit per key in ``PER_KEY`` times as many bits, up to ``MOST_BITS`` (32 MB); the bits
are set in tasks, and the driver only puts their blocks together.  ``rows`` keeps the rows whose bit
is set: all rows with a key in it and some others, so an exact join must follow.  With more keys
than bits it keeps nearly all rows, which costs time, not results.  Null keys are hashed like others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PER_KEY, LEAST_BITS, MOST_BITS, BLOCK_BITS = 16, 1 << 18, 1 << 28, 1 << 18


class Sieve:
    def __init__(self, keys: DataFrame):
        """``keys``: a written table; all its columns are the key."""
        bits = LEAST_BITS
        while bits < min(MOST_BITS, PER_KEY * keys.count()):
            bits *= 2
        self.bits = bits
        place = self._place(*keys.columns)
        placed = keys.select(F.floor(place / BLOCK_BITS).cast("long").alias("block"), (place % BLOCK_BITS).alias("bit"))

        def run(batches):
            last, held = None, np.zeros(BLOCK_BITS, bool)
            names = ["block", "bits"]

            def row():
                return pa.RecordBatch.from_arrays([pa.array([last]), pa.array([np.packbits(held).tobytes()])], names)

            for x in batches:
                block, bit = x.column(0).to_numpy(), x.column(1).to_numpy()
                for b in np.unique(block):
                    if b != last:
                        if last is not None:
                            yield row()
                        last, held = int(b), np.zeros(BLOCK_BITS, bool)
                    held[bit[block == b]] = True
            if last is not None:
                yield row()

        blocks = placed.repartition("block").sortWithinPartitions("block").mapInArrow(run, "block long, bits binary")
        found = np.zeros(bits // 8, np.uint8)
        for r in blocks.toArrow().to_pylist():
            found[r["block"] * BLOCK_BITS // 8:(r["block"] + 1) * BLOCK_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
        self.found = keys.sparkSession.sparkContext.broadcast(found)

    def _place(self, *columns: str):
        return F.pmod(F.xxhash64(*columns), F.lit(self.bits))

    def rows(self, df: DataFrame, *columns: str) -> DataFrame:
        """Rows of ``df`` whose ``columns`` may be a key."""
        found, place = self.found, "_".join(["_", *df.columns])

        def run(batches):
            for x in batches:
                at = x.column(x.num_columns - 1).to_numpy()
                ok = found.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1
                yield pa.RecordBatch.from_arrays(x.columns[:-1], x.schema.names[:-1]).filter(pa.array(ok.astype(bool)))

        return df.withColumn(place, self._place(*columns)).mapInArrow(run, df.schema)
