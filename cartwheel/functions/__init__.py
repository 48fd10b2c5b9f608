"""Column-level helpers (pure ``Column -> Column`` builders, all JVM-side)."""
