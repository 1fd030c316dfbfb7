"""Sources: dated CSV snapshots, nested JSON, API payloads, HTML tables, published tables."""
