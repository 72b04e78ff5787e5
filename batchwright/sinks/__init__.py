from .jdbc import JdbcStore
from .lake import APPEND, SCD, SNAPSHOT, Commit, LakeStore, Pending
from .partitioned import PartitionedStore

__all__ = ["APPEND", "SCD", "SNAPSHOT", "Commit", "JdbcStore", "LakeStore", "PartitionedStore", "Pending"]
