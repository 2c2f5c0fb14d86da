from weir.streaming.batch_sinks import (
    BatchLog,
    FailOnce,
    FanOutSink,
    IdempotentFileSink,
    JdbcBatchSink,
    read_batch_log,
    read_batches,
    write_batch_partition,
)
from weir.streaming.progress import ProgressLog, read_progress, topic_lag
from weir.streaming.runner import await_all, check_event_time, console_debug, run_available, start_stream, supervise

__all__ = [
    "BatchLog",
    "FailOnce",
    "FanOutSink",
    "IdempotentFileSink",
    "JdbcBatchSink",
    "ProgressLog",
    "await_all",
    "check_event_time",
    "console_debug",
    "read_batch_log",
    "read_batches",
    "read_progress",
    "run_available",
    "start_stream",
    "supervise",
    "topic_lag",
    "write_batch_partition",
]
