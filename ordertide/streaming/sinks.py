"""Parquet sinks for streaming queries."""


def start_parquet(stream, path, checkpoint, interval=None, name=None, partition_by=()):
    """Append a stream to a Parquet folder.

    With an interval the query runs on; without one it takes everything that is
    there now and stops.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def finish(query, timeout=None):
    """Wait for a bounded query; raises what the query raised."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not end in time")


def dropped_late_rows(query):
    """Rows that came behind the watermark, over the progress reports still kept."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
