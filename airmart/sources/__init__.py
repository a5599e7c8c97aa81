"""Sources and sinks: landing JSON files and the reading adapter over the driver's tables."""
