"""Sources and sinks: driver / transaction readers, feature writer, test-table fixtures."""

from netfeat.sources.sinks import read_features, write_features
from netfeat.sources.tables import read_driver, read_transactions

__all__ = ["read_driver", "read_features", "read_transactions", "write_features"]
