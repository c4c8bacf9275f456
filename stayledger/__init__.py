"""Hotel booking-pace analytics as Spark jobs.

Daily reservation snapshots go in; on-the-books detail, past-night history and
lead-time-bucketed pace / actual reports come out.  Everything is a function
``DataFrame -> DataFrame`` except ``sources``, ``sinks``, ``plans`` and
``streaming``, which touch storage.
"""

__version__ = "0.1.0"
