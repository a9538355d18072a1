from shiftledger.sources.delimited import Intake, list_files, read_delimited
from shiftledger.sources.layers import Layers

__all__ = ["Intake", "Layers", "list_files", "read_delimited"]
