"""What tasks leave behind in the Python workers."""

from pathlib import Path

import numpy as np
import pyarrow as pa

from llm.common import in_arrow, map_batches


def test_a_worker_gives_memory_back_when_its_task_ends(spark):
    def fill(batches):
        import llm.common as kept_module

        for b in batches:
            many = [np.ones(2500) for _ in range(10_000)]  # 200 MB in pieces that the C library keeps
            kept_module._last = np.ones(2500)  # above them, so that the heap can't just shrink
            del many
            yield b

    def resident(batches):
        for b in batches:
            pages = int(Path("/proc/self/statm").read_text().split()[1])
            yield pa.RecordBatch.from_arrays([pa.array([pages * 4096 >> 20] * b.num_rows, pa.int64())], ["mb"])

    one = spark.range(0, 4, 1, 1)
    before = max(r.mb for r in one.mapInArrow(resident, "mb long").collect())
    assert in_arrow(one, fill, "id long").count() == 4
    assert max(r.mb for r in one.mapInArrow(resident, "mb long").collect()) < before + 120


def test_what_a_function_keeps_is_forgotten_after_the_last_batch(spark):
    kept = []

    def add(batch):
        kept.append(batch.num_rows)
        return batch

    def forget():
        if kept != [2, 2, 1]:
            raise ValueError(f"forgotten too early: {kept}")

    got = map_batches(spark.range(0, 5, 1, 1), add, "id long", 2, forget)
    assert sorted(r.id for r in got.collect()) == [0, 1, 2, 3, 4]
