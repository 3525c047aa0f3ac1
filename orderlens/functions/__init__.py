"""Column-expression helpers: every function returns a `Column`, so everything stays
inside Catalyst and whole-stage codegen (no Python UDFs)."""
