"""What Python workers hold at once: the pipeline's stages share an executor's memory."""

import random
import tracemalloc

import corpus_pipeline
import numpy as np
import pyarrow as pa

from casebook.llm import packing, toxicity
from casebook.llm.queries import PACKING_TOKENIZER


def test_stages_get_batches_bounded_by_bytes(spark):
    """3,000 rows of 8 KB are 24 MB: one batch by Spark's 10,000 rows."""
    docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "repeat(cast(id as string), 2000) as text").selectExpr("doc_id", "substr(text || repeat('x', 8000), 1, 8000) as text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    own = lambda spark, docs, sf_dir: docs.mapInArrow(sizes, "n long, size long")
    key = corpus_pipeline.BATCH_SETTING
    spark.conf.unset(key)
    try:
        got = corpus_pipeline.in_small_batches(own)(spark, docs, "").collect()
        assert sum(r["n"] for r in got) == 3000 and max(r["size"] for r in got) < 5 << 20
        spark.conf.set(key, "1m")  # what the session says stays
        got = corpus_pipeline.in_small_batches(own)(spark, docs, "").collect()
        assert spark.conf.get(key) == "1m" and max(r["size"] for r in got) < 2 << 20
    finally:
        spark.conf.unset(key)
    assert all(hasattr(function, "__wrapped__") for _, function in corpus_pipeline.STAGES)


def test_training_rows_stay_in_their_table():
    sets = [[5, 9], [], [1, 2, 3]]
    table = pa.table({"features": pa.chunked_array([[np.array(s, "<i4").tobytes()] for s in sets], pa.binary()), "toxic": [1, 0, 1], "order": [3, -1, 2]})
    rows = toxicity.training_rows(table)
    assert [(c.tolist(), y) for c, y in rows] == [([], 0), ([1, 2, 3], 1), ([5, 9], 1)]
    assert not any(c.flags.owndata for c, _ in rows)


def test_packing_holds_one_small_block(monkeypatch):
    """16 MB of text in blocks: what numpy and Python hold at once stays far below it."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(5000)]
    texts = [" ".join(rng.choices(words, k=650)) for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    assert batch.nbytes > 16 << 20

    class Frame:  # hands over what the workers run
        sparkSession = sparkContext = property(lambda self: self)
        broadcast = staticmethod(lambda data: type("Held", (), {"value": data}))
        mapInArrow = staticmethod(lambda run, schema: run)

    monkeypatch.setattr(packing, "id_text", lambda df: df)
    run = packing.cut_pieces(Frame(), PACKING_TOKENIZER, block_bytes=corpus_pipeline.PACK_BLOCK_BYTES)
    tracemalloc.start()
    try:
        n = sum(out.num_rows for out in run([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == len(texts)
    assert peak < 60 << 20, peak
