"""No streaming operators: every input is a finite export (file tree, commit log, CSV)."""
