from sitelens.sources.adapter import load_sources, raw_organizations, raw_traffic, read_table
from sitelens.sources.raw import read_organizations, read_traffic

__all__ = ["load_sources", "raw_organizations", "raw_traffic", "read_table",
           "read_organizations", "read_traffic"]
