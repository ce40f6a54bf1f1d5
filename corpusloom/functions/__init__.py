"""Part of the corpusloom engine."""
