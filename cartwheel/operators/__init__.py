"""DataFrame -> DataFrame operators of the warehouse (batch form).

Streaming forms of the stateful ones live in ``cartwheel.streaming``.
"""
