"""Column-level functions: formatting macros, null-strict helpers, typed transforms, nested builders."""
