"""Sources: fixed-schema table reads, relational extracts, landing files."""
