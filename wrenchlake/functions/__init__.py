"""Column expressions; every one stays inside whole-stage codegen."""
