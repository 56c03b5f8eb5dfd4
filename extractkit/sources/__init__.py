"""Text and JSONL in and out."""
