import os
import tempfile

from pyspark.sql import functions as F

from cyclonespark.streaming.decks import _append_batch, start_deck_ingest

LINES = [
    "AL, 06, 2018083006,   , BEST,   0, 128N,  169W,  20, 1008, LO,   0,    ,    0,    0,    0,    0, 1010,  150,  50,   0,   0,   L,   0,    , 270,  10,     INVEST,",
    "AL, 06, 2018083012,   , BEST,   0, 128N,  179W,  25, 1007, LO,   0,    ,    0,    0,    0,    0, 1010,  150,  50,   0,   0,   L,   0,    , 270,  10,        SIX,",
    "AL, 06, 2018083012, 03, OFCL,  12, 129N,  184W,  25, 1007, LO,  34, NEQ,    0,    0,    0,    0, 1010,    0,  30,  35,   0,    ,   0, LAA, 282,  10,        SIX,",
]


def test_stream_ingest_available_now(spark):
    root = tempfile.mkdtemp(prefix="cyclonespark-stream-")
    folder, store, ckpt = (os.path.join(root, x) for x in ("in", "store", "ckpt"))
    os.makedirs(folder)
    with open(os.path.join(folder, "bal062018.dat"), "w") as fh:
        fh.write("\n".join(LINES) + "\n")
    q = start_deck_ingest(spark, folder, store, checkpoint=ckpt, available_now=True)
    q.awaitTermination(120)
    out = spark.read.parquet(store)
    assert out.count() == 3
    assert sorted(r.advisory for r in out.select("advisory").distinct().collect()) == ["BEST", "OFCL"]
    assert out.filter(F.col("advisory") == "OFCL").select("storm_id").first().storm_id == "AL062018"


def test_a_batch_tried_again_is_stored_once(spark):
    store = os.path.join(tempfile.mkdtemp(prefix="cyclonespark-stream-"), "store")
    batch = spark.createDataFrame([("bal062018.dat", i, line) for i, line in enumerate(LINES)], "path string, line_no long, line string")
    write = _append_batch(store)
    write(batch, 0)
    write(batch, 0)
    assert spark.read.parquet(store).count() == 3
    write(batch, 1)
    assert spark.read.parquet(store).count() == 6
