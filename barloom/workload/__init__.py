from barloom.workload import basics, checks, files, flows, missing, timeseries
from barloom.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "basics", "checks", "files", "flows", "missing", "timeseries"]
