"""Tables in and out of files."""

from purchaseflow.sources.read import SOURCE_FORMATS, Source, read
from purchaseflow.sources.write import SINK_FORMATS, write

__all__ = ["SINK_FORMATS", "SOURCE_FORMATS", "Source", "read", "write"]
