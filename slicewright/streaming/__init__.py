"""Streaming: intentionally empty.

Every load of the warehouse slices is a batch job over full staging snapshots (the
source system runs them as scheduled procedures); there is no stream, watermark or
stateful operator to re-express.  Incremental runs are handled by the merge upsert
in :mod:`slicewright.operators.merge`, which is idempotent per run.
"""
