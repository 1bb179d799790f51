"""Tables shared by executors, and the session's shared folder."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from ordertide.session import run_folder

#: Rows that go to Python and back at once, where rows hold whole texts.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark):
    """What runs meanwhile moves ``BATCH_ROWS`` rows at once at most; Spark's own 10,000 texts are copied on each side of
    the pipe of every task."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def saved(df, name):
    """The rows written as Parquet under the shared folder and read again, which cuts the lineage."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_of(column, folds):
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(column).cast("string")) % folds


def known_labels(labels, label, folds=1, held=-1):
    """One label for each id (the largest of several), without the held-out fold and without nulls."""
    known = labels.select(F.col("doc_id").alias("l_id"), F.col(label).cast("int").alias("label"))
    known = known.where("l_id IS NOT NULL AND label IS NOT NULL").groupBy("l_id").agg(F.max("label").alias("label"))
    return known.where(fold_of("l_id", folds) != held)


def labelled_sample(docs, labels, label, most, folds=1, held=-1):
    """doc_id, text and label of at most ``most`` labelled ids, chosen by a hash of the id alone.

    The chosen labels are a bounded table, so the join broadcasts them and no text is shuffled.
    """
    known = known_labels(labels, label, folds, held).orderBy(F.xxhash64("l_id"), "l_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("l_id"))
    return rows.select("doc_id", "text", "label")
