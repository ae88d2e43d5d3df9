"""State store settings of the stateful streams."""

from __future__ import annotations

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"


def require_rocksdb(spark) -> None:
    """``transformWithState`` needs the RocksDB state store; set it when the session has another.

    The provider is fixed in a query's checkpoint at its first batch, so this
    must run before the query starts.
    """
    if spark.conf.get(PROVIDER_CONF, None) != ROCKSDB:
        spark.conf.set(PROVIDER_CONF, ROCKSDB)
