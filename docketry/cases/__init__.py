"""Case records: one wide base row per case, content fields over it, states and payloads."""
