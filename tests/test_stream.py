"""Two files arriving through the stream give the batch answer."""

import os

from lexiflow.operators import sampling as R
from lexiflow.operators import score as S
from lexiflow.operators import train as TR
from lexiflow.functions import text as T
from lexiflow.session import cut_lineage
from lexiflow.sources import tables as TB
from lexiflow.streaming.score_stream import score_stream

from .conftest import SF001


def test_two_files_equal_batch(spark, tmp_out):
    lab = TB.labelled_lang(spark, SF001).withColumn("_train", R.split_flag("text"))
    model = cut_lineage(TR.train_counted(lab.where("_train"), 4))
    docs = TB.table(spark, SF001, "documents")
    src = os.path.join(tmp_out, "in")
    docs.where("doc_id % 2 = 0").coalesce(1).write.parquet(os.path.join(src, "a"))
    docs.where("doc_id % 2 = 1").coalesce(1).write.parquet(os.path.join(src, "b"))
    stream = (spark.readStream.schema(docs.schema).option("recursiveFileLookup", "true")
                   .option("maxFilesPerTrigger", 1).parquet(src))
    prep = lambda df: df.select("doc_id", "text", T.label_id("lang", TB.LANGS).alias("label_id"))
    out = os.path.join(tmp_out, "out")
    q = score_stream(stream, model, 4, out, os.path.join(tmp_out, "ckpt"), prepare=prep)
    q.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(out)
                     .select("doc_id", "label_id", "class_id", "mean_score").collect()))
    want = sorted(map(tuple, S.score(prep(docs), model, 4).collect()))
    assert got == want
    assert len(os.listdir(out)) >= 2      # one folder per micro-batch
