"""Change data capture and incremental marts on Spark."""

from tidemark.functions.names import NameBook, Names
from tidemark.operators.merge import MergeResult, mark_missing, mark_orphans, merge, merge_mart
from tidemark.plans.full_load import Cron, FrameSnapshot, FullLoadCron, FullLoads, full_load
from tidemark.plans.mart_library import GroupMart, RowMart
from tidemark.plans.mart_runner import Mart, MartContext, MartLoop, MartRunner
from tidemark.plans.outbox import Outbox
from tidemark.plans.state import Claims, InFlight, Lease, Registry
from tidemark.plans.store import Conflict, LostLease, Store
from tidemark.sources.metadata import parse as parse_metadata
from tidemark.sources.odata import ODataSnapshot
from tidemark.sources.transport import FolderTransport, HttpTransport
from tidemark.spec import TableSpec
from tidemark.streaming.feed import ChangeFeed
from tidemark.streaming.replicator import Cycle, PackageHeld, Replicator

__version__ = "0.2.0"
__all__ = [
    "ChangeFeed", "Claims", "Conflict", "Cron", "Cycle", "FolderTransport", "FrameSnapshot", "FullLoadCron", "FullLoads", "GroupMart", "HttpTransport", "InFlight", "Lease", "LostLease",
    "Mart", "MartContext", "MartLoop", "MartRunner", "MergeResult", "NameBook", "Names", "ODataSnapshot", "Outbox", "PackageHeld", "Registry", "Replicator", "RowMart", "Store", "TableSpec",
    "full_load", "mark_missing", "mark_orphans", "merge", "merge_mart", "parse_metadata",
]
