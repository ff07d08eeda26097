"""The library run on the TPC-H-like test tables: role mapping, queries and oracle SQL."""
