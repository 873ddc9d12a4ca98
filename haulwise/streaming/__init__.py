"""Incremental ingestion of landed feeds with Structured Streaming.

The reference runs a daily batch over newly landed files. The Spark-native
form of "process each landed file exactly once" is a file-source stream with
a checkpoint and ``Trigger.AvailableNow``: every run picks up only files not
yet processed and hands them to the batch job through ``foreachBatch``.
"""
