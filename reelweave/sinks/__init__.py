"""Writers: tables, exports, keyed messages, upserts."""
