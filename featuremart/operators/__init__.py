"""Feature and analytics operators built from DataFrame primitives."""
