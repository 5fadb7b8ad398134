"""Compositions: vocabulary, source recipes, the whole flow, reports, query catalogue."""
