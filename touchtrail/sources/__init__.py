"""Raw file readers, table store and the sources derived from the test tables."""
