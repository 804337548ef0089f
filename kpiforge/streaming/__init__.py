"""Streaming: the reference has no streams; its per-file loads are offered as
a file-arrival stream (``file_loads``)."""
