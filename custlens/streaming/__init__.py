"""Streaming: intentionally empty.

The engine's source workload reads six closed files and has no watermark,
window, state or late-data logic, so there is nothing to express with
Structured Streaming.  Every operator of the library is a batch DataFrame
transformation; one of them can be applied inside ``foreachBatch`` by a
caller, but no streaming operator is offered on its own.
"""
