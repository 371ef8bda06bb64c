"""Sources and sinks: feed XML, landing files, the run log and keyed tables."""
