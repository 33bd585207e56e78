from contrail.streaming.ingest import (  # noqa: F401
    ingest_batch, ingest_metrics, snapshot_stream, start_ingest,
)
from contrail.streaming.transitions import detect_transitions_stream  # noqa: F401
