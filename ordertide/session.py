"""Session helpers: shared run folders and a session for streaming work."""

import tempfile
import uuid

_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_folder(spark, name):
    """A new folder under the session's shared checkpoint folder.

    Only a local-mode session may leave ``spark.checkpoint.dir`` unset: its
    driver and executors share one machine, so a temporary folder serves.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="ordertide-")
    return f"{base.rstrip('/')}/ordertide/{name}-{uuid.uuid4().hex}"


def use_utc(spark):
    """Event times are UTC instants; windows and text forms follow the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def stream_session(spark, partitions=None):
    """A session with its own SQL settings for stateful queries.

    The number of state partitions is frozen in the checkpoint of a query, so it
    is set once here: one per core of the cluster unless given.
    """
    session = use_utc(spark.newSession())
    cores = spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(partitions or cores))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
    session.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return session


def check_stream_session(session):
    """State that outgrows memory needs the settings of ``stream_session``."""
    if session.conf.get("spark.sql.streaming.stateStore.providerClass", None) != _STATE_STORE:
        raise ValueError("read the topics with a session of stream_session()")
