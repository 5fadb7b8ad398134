"""No operators: the workload is a daily batch without streams or state.

Landed files of a new day are picked up by the batch readers in
``tributary.sources`` and loaded idempotently by ``tributary.operators.star``.
"""
