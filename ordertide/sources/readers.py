"""Event readers: NDJSON, Parquet folders and the choice between two sources."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F


def _present(spark, rows, schema):
    """The rows, or an empty frame of the schema where their folder does not exist."""
    try:
        return rows()
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_ndjson(spark, path, schema):
    """Newline-delimited JSON; blank and unreadable lines are skipped, an absent folder is empty."""
    return _without_blank(_present(spark, lambda: spark.read.schema(schema).json(path), schema))


def stream_ndjson(spark, path, schema, **options):
    return _without_blank(spark.readStream.schema(schema).options(**options).json(path))


def _without_blank(rows):
    """An unreadable line gives a row of nulls."""
    return rows.filter(F.coalesce(*[F.col(name).cast("string") for name in rows.columns]).isNotNull())


def read_parquet_prefix(spark, path, schema=None, skip_corrupt=False, merge=False):
    """A Parquet folder with its partitions as columns, so that filters on them open few folders.

    With a schema no footer is read ahead and an absent or empty folder gives an empty frame.
    ``merge`` unites the columns of all files, which opens every footer. ``skip_corrupt`` leaves
    out files that cannot be read; Spark logs each of them.
    """
    reader = spark.read.option("mergeSchema", merge).option("ignoreCorruptFiles", skip_corrupt)
    reader = reader.option("pathGlobFilter", "*.parquet")
    if schema is not None:
        reader = reader.schema(schema)
    return _present(spark, lambda: reader.parquet(path), schema)


def stream_parquet(spark, path, schema, **options):
    return spark.readStream.schema(schema).options(**options).parquet(path)


def load_with_fallback(primary, secondary):
    """The primary frame unless it is absent or has no rows."""
    if primary is None or primary.isEmpty():
        return secondary
    return primary
