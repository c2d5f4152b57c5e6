from ledgerlark.sources.files import merge_csv, read_csv, read_with_fallback  # noqa: F401
from ledgerlark.sources.messages import (  # noqa: F401
    publish, read_messages, sink_options, source_options, stream_messages, stream_sink, to_envelope,
    transaction_payload, with_ordinal,
)
from ledgerlark.sources.runs import append_run, read_runs  # noqa: F401
