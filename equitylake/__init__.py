"""equitylake: a Spark-native warehouse for keyed daily market data.

Ten declared tables live as partitioned parquet under one root. They are read
with pushed-down filters, replaced whole, or upserted latest-wins so that only
the partitions a batch touches are rewritten. Landed vendor files (listing
profiles, nested price histories, statement CSVs) are normalised with built-in
column expressions; nothing here runs Python per row.
"""

from equitylake.session import get_session, scratch_dir
from equitylake.sources.store import Store

__all__ = ["Store", "get_session", "scratch_dir"]
