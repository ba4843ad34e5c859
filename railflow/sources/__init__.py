"""Readers: station JSON, tar.gz archives of timetable XML, XML parsing,
and the analogs over the driver's TPC-H-style tables."""
