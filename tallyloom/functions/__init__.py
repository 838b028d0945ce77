"""Column functions: each takes and returns ``Column`` objects, so that Catalyst sees one plan."""
