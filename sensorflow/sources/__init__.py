"""Readers (readers, files), writers (sinks), fixed schemas, rule tables (rules), in-plan
tables (tables) and the sensor-shaped stand-in views over the benchmark tables (demo)."""
