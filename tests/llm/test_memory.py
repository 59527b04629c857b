"""What an executor and its Python workers hold at once."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from zonara.llm import common, packing


def test_python_gets_small_batches(spark):
    rows = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 2000).alias("text"))

    def most(batches):
        yield pa.RecordBatch.from_arrays([pa.array([max(b.nbytes for b in batches)])], ["most"])

    common.map_rows(rows, ["text"], "n long", lambda: lambda texts: [(len(t),) for t in texts]).count()
    assert rows.mapInArrow(most, "most long").head()[0] <= 5 << 20  # 30 MB in one batch before


def test_a_task_keeps_no_caches_unless_told():
    batch = pa.RecordBatch.from_arrays([pa.array(["a"])], ["text"])

    def run(batches):
        common.cached_state("held", dict)
        yield from batches

    list(common.tidy(run)([batch]))
    assert "held" in common._STATE
    list(common.tidy(run, keep=False)([batch]))
    assert not common._STATE


def test_packing_places_come_as_arrow(spark, monkeypatch):
    made, create = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: made.append(data) or create(self, data, *a, **k))
    docs = spark.createDataFrame([(k, "some words " * k) for k in range(5)], "doc_id long, text string")
    made.clear()
    from zonara.llm.queries import vocabulary

    out = packing.pack(docs, vocabulary("word_bpe_49k.json")).toPandas()
    assert sorted(out.doc_id.unique()) == list(range(5)) and np.all(out.length > 0)
    assert all(isinstance(x, pa.Table) for x in made if len(x))  # a list starts plain Python workers beside the Arrow ones
